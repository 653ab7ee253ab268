"""Completed row ranges, read from result file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Which files are results, and how their names give the range.
RESULT_NAME = r"^result_.*\.tsv$"
RANGE_NAME = r"^result_from_(\d+)_until_(\d+).tsv$"


def parse_result_names(files: DataFrame, name: str = "file_name") -> DataFrame:
    """``ranges(from_row, until_row)``; another ``result_*.tsv`` name is an error."""
    results = files.where(F.col(name).rlike(RESULT_NAME))
    checked = F.when(F.col(name).rlike(RANGE_NAME), F.col(name)).otherwise(
        F.raise_error(F.concat(F.lit("Unexpected result filename found: "), F.col(name)))
    )
    return results.select(
        F.regexp_extract(checked, RANGE_NAME, 1).cast("long").alias("from_row"),
        F.regexp_extract(checked, RANGE_NAME, 2).cast("long").alias("until_row"),
    )


def read_completed_ranges(spark: SparkSession, path: str) -> DataFrame:
    """Ranges of the result files in a folder; only names and sizes are listed, no content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "result_*.tsv").load(path)
    return parse_result_names(files.select(F.element_at(F.split("path", "/"), -1).alias("file_name")))
