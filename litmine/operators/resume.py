"""Skip inputs that are already done."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending_inputs(inputs: DataFrame, done: DataFrame, key: str, size: str | None = None) -> DataFrame:
    """Inputs without a completed output; with ``size``, an empty output does not count as done."""
    finished = done.where(F.col(size) > 0) if size else done
    return inputs.join(finished.select(key).distinct(), key, "left_anti")


def restrict_to_ids(inputs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Inputs whose id is in the id table."""
    return inputs.join(ids.select(key).distinct(), key, "left_semi")
