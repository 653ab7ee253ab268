"""Numbers of rows within groups of any size, from a range partitioning: no group is brought into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litmine.operators.sizing import broadcast_if_small
from litmine.session import written


def numbered(rows: DataFrame, group: list[str], order: list, label: str = "ordered") -> DataFrame:
    """``rows`` with ``place`` (0, 1, ... in ``order`` within the columns ``group``, none of them null) and ``total``.

    Rows are dealt out by ranges of (group, order) and sorted, so a group of any size lies in consecutive
    partitions. Each row is stored with its position; how many rows of its group lie in earlier partitions
    is summed from one row per group and partition. Rows that are equal in ``order`` are split between
    partitions too, as their position in the input is the last sort key.
    """
    keys = [*group, *order, F.col("_from")]
    dealt = rows.withColumn("_from", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = written(dealt.drop("_from").withColumn("_at", F.monotonically_increasing_id()), label)
    part = F.shiftright("_at", 33)
    pieces = at.groupBy(*group, part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of = Window.partitionBy(*group)
    before = F.coalesce(F.sum("_n").over(of.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = pieces.select(*group, "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(of).alias("total"))
    joined = at.withColumn("_part", part).join(broadcast_if_small(written(starts, "starts"), 16 << 20), [*group, "_part"])
    return joined.withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
