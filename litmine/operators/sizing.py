"""Join helpers that look at sizes before they choose."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 128 * 1024 * 1024
ROW_OVERHEAD = 64


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure a table (one aggregate, one row back) against a broadcast limit."""
    width = F.lit(ROW_OVERHEAD).cast("long")
    for name, kind in df.dtypes:
        size = F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
        if kind == "string":
            width = width + size
        elif kind.startswith(("array", "map", "struct")):
            width = width + size * 4  # a generous allowance over the printed form
        else:
            width = width + 8
    total = df.agg(F.sum(width)).first()[0]
    return (total or 0) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a table for broadcasting after measuring it; leave it to a shuffle otherwise."""
    return F.broadcast(df) if fits_broadcast(df, limit) else df
