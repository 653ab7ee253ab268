"""Texts are written and dealt by many tasks."""

from pathlib import Path

from litmine.operators.annotate import annotate
from litmine.operators.vocabulary import finish_vocabulary
from litmine.session import shared_dir
from pyspark.sql import functions as F
from spark_queries.fulltext_queries import metadata_csv
from tests.test_round3 import plan_of


def test_metadata_is_written_as_several_files(spark, tmp_path):
    spark.range(60).selectExpr(
        "59 - id AS doc_id", "concat('a \"b\", c', chr(10), 'line ', id) AS text", "'en' AS lang", "'web' AS source").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    known = set(Path(shared_dir(spark).removeprefix("file:")).glob("csv-*"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        rows = metadata_csv(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set(merge, before)
    (folder,) = set(Path(shared_dir(spark).removeprefix("file:")).glob("csv-*")) - known
    assert len(list(folder.glob("part-*"))) > 1
    assert sorted((r["doc_id"], r["row_index"]) for r in rows) == [(k, k) for k in range(60)]


def test_contexts_are_not_shuffled(spark):
    docs = spark.createDataFrame([(1, "red blood cell and blood"), (2, "a blood cell"), (3, None), (2, "")], "doc_id long, text string")
    vocab = finish_vocabulary(spark.createDataFrame([(f"t:{s}", s, "label") for s in ("blood", "blood cell")], "term_iri string, surface string, kind string"))
    found = annotate(docs.withColumn("kind", F.lit("text")), vocab, keys=["doc_id", "kind"], context=5)
    assert sorted((r["doc_id"], r["start"], r["before"], r["matched"], r["after"]) for r in found.collect()) == [
        (1, 4, "red ", "blood cell", " and "), (1, 19, " and ", "blood", ""), (2, 2, "a ", "blood cell", "")]
    moved = [line for line in plan_of(found).splitlines() if "Exchange hashpartitioning(_at" in line or "Exchange hashpartitioning(doc_id" in line]
    assert moved and all("REPARTITION_BY_NUM" in line for line in moved)
