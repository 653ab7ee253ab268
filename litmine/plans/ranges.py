"""Completed result files to the jobs that are left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litmine.operators.ranges import bisect_ranges, range_gaps
from litmine.sources.ranges import read_completed_ranges

JOB_SIZE = 500


def remaining_jobs(
    spark: SparkSession, result_path: str, n_rows: int | DataFrame, job_size: int = JOB_SIZE, mode: str = "covered"
) -> DataFrame:
    """``(from_row, until_row)`` of every job still to run."""
    return bisect_ranges(range_gaps(read_completed_ranges(spark, result_path), n_rows, mode), job_size)
