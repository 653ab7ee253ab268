"""Buckets follow the texts, not the files that they are stored in."""

from litmine.llm import tables


def test_buckets_do_not_depend_on_compression(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 10_000)
    docs = spark.range(200).selectExpr("id AS doc_id", "repeat('the same words again ', 100) AS text")
    counts = []
    for codec in ("zstd", "none"):
        docs.write.option("compression", codec).parquet(f"{tmp_path}/{codec}")
        counts.append(tables.bucket_count(spark.read.parquet(f"{tmp_path}/{codec}")))
    assert counts == [42, 42]
    assert tables.bucket_count(spark.createDataFrame([(1, None)], "doc_id long, text string")) == 16
