"""Article XML to field counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litmine.operators.profile import field_counts
from litmine.sources.articles_xml import read_chunks


def profile_files(spark: SparkSession, path: str | list[str], glob: str | None = "*.xml.gz", **options) -> DataFrame:
    """``field_counts(source_file, path, n)`` of all files of a folder."""
    return field_counts(read_chunks(spark, path, glob), **options)
