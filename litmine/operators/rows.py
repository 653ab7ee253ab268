"""Row numbers and row slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litmine.session import fresh_path, written


def split_sums(sizes: DataFrame, value: str = "_n", within: list[str] | None = None, largest: bool = False) -> DataFrame:
    """``sizes (_file, _block, ...)`` with ``_start``: the sum (or the largest) of ``value`` over all splits before, or those of the same ``within``.

    In two levels: splits are dealt out by ranges and summed within each; what is added up over the ranges is one
    number per range and group that lies in it.
    """
    keys, group = ["_file", "_block"], within or []
    dealt = sizes.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = written(dealt.withColumn("_range", F.shiftright("_at", 33)), "splits")
    add = F.max if largest else F.sum
    totals = placed.groupBy(*group, "_range").agg(add(value).alias("_total"))
    earlier = Window.partitionBy(*group, *([] if group else [F.lit(0)])).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*group, "_range", add("_total").over(earlier).alias("_carry"))
    before = Window.partitionBy(*group, "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("_inside", add(value).over(before)).join(carry, [*group, "_range"])
    zero = F.lit(None if largest else 0).cast("long")
    start = F.greatest("_inside", "_carry") if largest else F.coalesce("_inside", zero) + F.coalesce("_carry", zero)
    return local.withColumn("_start", start).drop("_at", "_range", "_inside", "_carry")


def with_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Number the rows of a file scan from 0, in file order.

    The scan is stored once, each row with its split and place; splits are counted from that copy, and their first numbers
    are joined back. The frame must come straight from a file scan (filters and projections may follow the scan, shuffles may not).
    """
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    tagged = written(df.select("*", *split, F.monotonically_increasing_id().alias("_local")), "tagged")
    sizes = tagged.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_local").alias("_first"))
    # Written first, so that its true size decides how it is joined.
    numbered = tagged.join(written(split_sums(sizes).drop("_n"), "starts"), ["_file", "_block"])
    return numbered.select(
        *[F.col(c) for c in df.columns], (F.col("_start") + F.col("_local") - F.col("_first")).alias(name)
    )


def persist_with_row_index(df: DataFrame, path: str | None = None, name: str = "row_index") -> DataFrame:
    """Number the rows once and keep the result as a table (by default in the shared folder)."""
    target = path or fresh_path(df.sparkSession, "row-index")
    with_row_index(df, name).write.parquet(target)
    return df.sparkSession.read.parquet(target)


def row_slice(df: DataFrame, from_row: int, until_row: int, index: str = "row_index") -> DataFrame:
    """Rows ``[from_row, until_row)``; empty if the range is inverted or past the end."""
    return df.where((F.col(index) >= from_row) & (F.col(index) < until_row))
