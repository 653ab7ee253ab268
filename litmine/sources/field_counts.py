"""Field-count files: ``count <tab> path`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the shape of a line.
LINE = r"^(\d+)\t(.*)$"


def parse_count_line(line: Column) -> tuple[Column, Column]:
    """``(path, n)``; a malformed line is an error."""
    checked = F.when(line.rlike(LINE), line).otherwise(F.raise_error(F.concat(F.lit("Unable to parse line: "), line)))
    return F.regexp_extract(checked, LINE, 2), F.regexp_extract(checked, LINE, 1).cast("long")


def read_field_counts(spark: SparkSession, path: str | list[str], glob: str = "*.gz") -> DataFrame:
    """``field_counts(source_file, path, n)``."""
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
    name, count = parse_count_line(F.col("value"))
    return lines.select(F.col("_metadata.file_path").alias("source_file"), name.alias("path"), count.alias("n"))
