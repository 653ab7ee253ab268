"""Reading inputs, sizing hash buckets, and packing texts for a shuffle."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET_BYTES = 13 << 20
NO_ID = (1 << 63) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def input_bytes(df: DataFrame, column: str = "text") -> int:
    """The measured bytes of a column. The size of its files depends on their compression, which says nothing about the memory it takes."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def bucket_count(df: DataFrame, column: str = "text") -> int:
    """Hash buckets for what is gathered from a text column: each stays within some tens of MB."""
    return max(16, min(1 << 20, -(-input_bytes(df, column) // BUCKET_BYTES)))


def id_or_last(column: str = "doc_id"):
    """A null id becomes the greatest number, so that it never comes first."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def id_or_null(column: str):
    return F.when(F.col(column) != NO_ID, F.col(column))


def packed_texts(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Each row's key columns and its text compressed, which makes a shuffle of texts small."""
    rows = docs.select(*keys, F.coalesce("text", F.lit("")).alias("text"))
    schema = rows.drop("text").withColumn("packed", F.lit(b"")).withColumn("size", F.lit(0).cast("long")).schema

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            blobs, sizes = [], []
            for text in texts:
                raw = text.as_buffer()
                blobs.append(codec.compress(raw, asbytes=True))
                sizes.append(raw.size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keys))] + [pa.array(blobs, pa.binary()), pa.array(sizes, pa.int64())],
                [*keys, "packed", "size"],
            )

    return rows.mapInArrow(pack, schema)


def unpacked(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows with their texts in a column ``text``, about ``limit`` bytes at a time."""
    codec = pa.Codec("zstd")
    blobs, sizes = batch.column(batch.schema.get_field_index("packed")), batch.column(batch.schema.get_field_index("size")).to_pylist()
    at = 0
    while at < batch.num_rows:
        to, total, texts = at, 0, []
        while to < batch.num_rows and (to == at or total + sizes[to] <= limit):
            texts.append(codec.decompress(blobs[to].as_buffer(), sizes[to], asbytes=True) if sizes[to] else b"")
            total += sizes[to]
            to += 1
        yield batch.slice(at, to - at).append_column("text", pa.array(texts, pa.binary()))
        at = to
