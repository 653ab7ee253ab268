"""Loads that skip what is done, stale folders, and how many files a sink writes."""

from pathlib import Path

from pyspark.sql import functions as F

from litmine.plans.resumable import list_inputs, pending, read_manifest, resume_articles
from litmine.sources.sinks import clustered, write_triples
from test_round2 import article


def put(path, *articles):
    path.write_text("<PubmedArticleSet>" + "".join(articles) + "</PubmedArticleSet>")


def test_second_load_opens_only_what_is_new_or_changed(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    put(inbox / "a b.xml", article("1", "One"), article("2", "Two"))
    put(inbox / "none.xml")
    first = {Path(r.path).name: r for r in resume_articles(spark, str(inbox), out).collect()}
    assert (first["a b.xml"].outcome, first["a b.xml"].n_articles, first["none.xml"].outcome) == ("done", 2, "empty") and first["a b.xml"].seconds > 0
    stored = {f: f.stat().st_mtime_ns for f in Path(out, "triples").rglob("*.parquet")}
    put(inbox / "c.xml", article("3", "Three"), "<PubmedArticle><MedlineCitation></Broken></PubmedArticle>")
    todo = pending(list_inputs(spark, str(inbox)), read_manifest(spark, out))
    assert {Path(r.path).name for r in todo.collect()} == {"c.xml", "none.xml"}
    second = {Path(r.path).name: r for r in resume_articles(spark, str(inbox), out).collect()}
    assert {n: r.run for n, r in second.items()} == {"a b.xml": 1, "none.xml": 2, "c.xml": 2} and second["c.xml"].n_rejects == 1
    assert all(f.stat().st_mtime_ns == t for f, t in stored.items())
    assert spark.read.parquet(f"{out}/triples").count() == sum(r.n_triples for r in second.values())
    put(inbox / "c.xml", "")  # another size, and nothing in it: its statements go
    third = {Path(r.path).name: r for r in resume_articles(spark, str(inbox), out).collect()}
    assert third["c.xml"].outcome == "empty" and not [f for f in Path(out, "triples").iterdir() if f.name.startswith("source=c.xml")]
    assert spark.read.parquet(f"{out}/triples").count() == third["a b.xml"].n_triples
    put(inbox / "none.xml", article("9", "Nine"))
    resume_articles(spark, str(inbox), out)
    put(inbox / "c.xml", article("3", "Three"))
    last = resume_articles(spark, str(inbox), out)
    assert last.where("outcome = 'empty'").count() == 0 and resume_articles(spark, str(inbox), out).agg(F.max("run")).first()[0] == 5


def test_files_are_as_many_as_the_rows_need(spark, tmp_path):
    rows = spark.range(4000).repartition(8).select(
        F.concat(F.lit("file:/x/"), F.when(F.col("id") % 10 < 7, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 3)), F.lit(".xml")).alias("source_file"),
        F.col("id").cast("string").alias("object"))
    write_triples(rows, str(tmp_path / "t"))
    assert len(list((tmp_path / "t").rglob("*.parquet"))) == 4 and spark.read.parquet(str(tmp_path / "t")).count() == 4000
    pieces = clustered(rows.withColumnRenamed("source_file", "source"), rows_per_file=500)
    assert pieces.select("source", F.spark_partition_id()).distinct().count() <= 6 + 3 and pieces.count() == 4000


def test_deep_text_of_long_and_odd_records(spark):
    from litmine.sources.articles_xml import with_deep_text

    cases = {
        "<r><ArticleTitle>" + "a<em>b</em>&lt;" * 30000 + "</ArticleTitle>" + "<x>y</x>" * 30000 + "</r>": "<r><ArticleTitle>" + "ab&lt;" * 30000 + "</ArticleTitle>" + "<x>y</x>" * 30000 + "</r>",
        "<r><ArticleTitle/><AbstractText A='>'>x<![CDATA[" + "<&" * 20000 + "]]>y<![CDATA[]]></AbstractText></r>": "<r><ArticleTitle/><AbstractText A='>'>x" + "&lt;&amp;" * 20000 + "y</AbstractText></r>",
        "<r><ArticleTitle>never closed <b>x</b></r>": "<r><ArticleTitle>never closed x</r>", "": "", "no tags <5 & more": "no tags <5 & more",
        "<r>" + "&" * 300000 + "</r>": "<r>" + "&" * 300000 + "</r>", "<ArticleTitles><q>k</q></ArticleTitles>": "<ArticleTitles><q>k</q></ArticleTitles>",
    }
    got = spark.createDataFrame(list(enumerate(cases)), "k int, raw string").select("k", with_deep_text(F.col("raw")).alias("t")).collect()
    assert {r.k: r.t for r in got} == dict(enumerate(cases.values()))


def test_overlap_counts_match_the_pairs(spark):
    import random

    from litmine.operators.ranges import range_overlap_counts, range_overlaps

    r = random.Random(5)
    spans = [(a, a + r.choice([0, 1, 2, 50, 100000])) for a in (r.randrange(300000) for _ in range(300))] + [(5, 6), (5, 6), (7, 3)]
    ranges = spark.createDataFrame(spans, "from_row long, until_row long")
    pairs = {}
    for a, b in sorted({s for s in spans if s[0] < s[1]}):
        pairs[a, b] = sum(x < b and a < y and (x, y) != (a, b) for x, y in {s for s in spans if s[0] < s[1]})
    assert {(x.from_row, x.until_row): x.n_overlaps for x in range_overlap_counts(ranges).collect()} == pairs
    assert range_overlaps(ranges).count() == sum(pairs.values())
    nested = spark.range(100000).select(F.col("id").alias("from_row"), (F.lit(300000) - F.col("id")).alias("until_row"))
    found = range_overlap_counts(nested)
    assert found.agg(F.min("n_overlaps"), F.max("n_overlaps"), F.count("*")).first() == (99999, 99999, 100000)
    assert range_overlap_counts(ranges.where("false")).count() == 0


def test_edges_of_a_replayed_and_a_changed_file(spark, tmp_path):
    from litmine.operators.articles import articles_from_parsed, parse_records
    from litmine.streaming.ingest import edge_counts, ingest_edges, stream_article_records

    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()

    def edges_of(batch):
        articles = articles_from_parsed(parse_records(batch))
        return articles.select(F.col("iri").alias("article"), F.explode(F.split("title", " ")).alias("term"), "source_file")

    def run(progress):
        ingest_edges(stream_article_records(spark, str(inbox), "*.xml", max_files=1, keep_empty=True), edges_of, out, str(tmp_path / progress)).awaitTermination()
        return {x.term: x.n_articles for x in edge_counts(spark, out).collect()}

    put(inbox / "a.xml", article("1", "one two"), article("2", "two"))
    assert run("p") == {"one": 1, "two": 2}
    put(inbox / "b.xml", article("3", "two three three"))
    assert run("p") == {"one": 1, "two": 3, "three": 1} == run("p")
    put(inbox / "a.xml", article("1", "four"))
    put(inbox / "b.xml", "")
    assert run("again") == {"four": 1}
