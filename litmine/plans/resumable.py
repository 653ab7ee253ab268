"""Article XML to published outputs, in loads that skip what is done.

A manifest under the output folder says of every input what became of it. It is written last, so an
interrupted load is repeated, and read before anything is scanned, so inputs that are done are not opened.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from litmine.operators.articles import articles_from_parsed, malformed_records, parse_records
from litmine.operators.edges import edges_from_triples
from litmine.operators.resume import pending_inputs
from litmine.operators.sizing import broadcast_if_small
from litmine.operators.stats import load_stats, stats_triples
from litmine.plans.pubmed import triples_of
from litmine.session import fresh_path, written
from litmine.sources.articles_xml import read_article_records
from litmine.sources.sinks import exists, remove_sources, source_folder, write_edges, write_triples

MANIFEST = "source_file string, path string, size long, outcome string, n_articles long, n_rejects long, n_triples long, seconds double, run int"


def list_inputs(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``(source_file, path, size)`` of the files of a folder; their contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(F.col("_metadata.file_path").alias("source_file"), "path", F.col("_metadata.file_size").alias("size"))


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """The last entry of every input."""
    if not exists(spark, f"{out}/manifest"):
        return spark.createDataFrame([], MANIFEST)
    entries = spark.read.schema(MANIFEST).parquet(f"{out}/manifest")
    columns = [c for c in entries.columns if c != "source_file"]
    return entries.groupBy("source_file").agg(F.max_by(F.struct(*columns), "run").alias("last")).select("source_file", "last.*")


def pending(inputs: DataFrame, manifest: DataFrame) -> DataFrame:
    """Inputs that are new, have another size than when they were loaded, or gave nothing."""
    loaded = manifest.withColumnRenamed("size", "_size").select("source_file", "_size", "n_triples")
    same = loaded.join(inputs.select("source_file", "size"), "source_file").where("size = _size")
    return pending_inputs(inputs, same, "source_file", "n_triples")


def resume_articles(spark: SparkSession, path: str | list[str], out: str, vocab: DataFrame | None = None, glob: str | None = None) -> DataFrame:
    """Load the inputs that are pending, publish their statements, statistics and edges per source, and commit them.

    Returns the manifest. Counts of the whole load are observed while it is written; they must add up to the sources' own. A source
    that gives no statements or edges loses the folder of an earlier load. ``seconds`` is the load's measured time, shared out by size.
    """
    before = read_manifest(spark, out)
    todo = written(pending(list_inputs(spark, path, glob), before), "inputs")
    files = [r["path"] for r in todo.select("path").collect()]  # the reader's list of files
    if not files:
        return before
    begin = time.monotonic()
    parsed = written(parse_records(read_article_records(spark, files)), "parsed")
    seen, said = Observation("articles"), Observation("statements")
    target = fresh_path(spark, "articles")
    articles_from_parsed(parsed).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(target)
    articles = spark.read.parquet(target)
    stored = fresh_path(spark, "triples")
    triples_of(articles, vocab if vocab is None else written(vocab, "vocabulary")).observe(said, F.count(F.lit(1)).alias("n")).write.parquet(stored)
    triples = spark.read.parquet(stored)
    write_triples(triples, f"{out}/triples")
    edges = edges_from_triples(triples, by_file=True)
    write_edges(edges, f"{out}/edges")
    remove_sources(spark, f"{out}/triples", todo, triples)
    remove_sources(spark, f"{out}/edges", todo, edges)
    seconds = time.monotonic() - begin

    rejects = malformed_records(parsed).groupBy("source_file").agg(F.count(F.lit(1)).alias("n_rejects"))
    counts = written(load_stats(articles, triples), "stats")
    total = counts.agg(F.coalesce(F.sum("n_articles"), F.lit(0)), F.coalesce(F.sum("n_triples"), F.lit(0))).first()
    if tuple(total) != (seen.get["n"], said.get["n"]):
        raise RuntimeError(f"observed {seen.get['n']} articles and {said.get['n']} statements, the sources have {tuple(total)}")
    size = todo.agg(F.sum("size")).first()[0] or 1
    run = (before.agg(F.max("run")).first()[0] or 0) + 1
    entries = todo.join(broadcast_if_small(counts), "source_file", "left").join(broadcast_if_small(rejects), "source_file", "left")
    entries = entries.na.fill(0, ["n_articles", "n_triples", "n_rejects"]).select(
        "source_file", "path", "size", F.when(F.col("n_triples") > 0, "done").otherwise("empty").alias("outcome"),
        "n_articles", "n_rejects", "n_triples", F.round(F.col("size") / size * seconds, 3).alias("seconds"), F.lit(run).alias("run"),
    )
    entries = written(entries, "entries")
    write_triples(stats_triples(entries, F.col("seconds")), f"{out}/stats")
    entries.write.mode("append").parquet(f"{out}/manifest")
    return read_manifest(spark, out)
