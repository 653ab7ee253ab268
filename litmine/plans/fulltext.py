"""Article metadata and full text to keyword-in-context rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from litmine.operators.kwic import CONTEXT, attach_fulltext, describe_rows, kwic_rows
from litmine.operators.rows import persist_with_row_index, row_slice
from litmine.session import spread
from litmine.sources.cord import read_fulltext, read_metadata


def annotate_fulltext(
    spark: SparkSession, metadata_path: str, fulltext_path: str, vocab: DataFrame | None,
    from_row: int = 0, until_row: int | None = None, context: int = CONTEXT,
) -> DataFrame:
    """Keyword-in-context rows of the metadata rows ``[from_row, until_row)``."""
    metadata = persist_with_row_index(read_metadata(spark, metadata_path))
    if from_row or until_row is not None:
        metadata = row_slice(metadata, from_row, until_row if until_row is not None else 2**62)
    described = describe_rows(spread(metadata))
    wanted = described.where("json_file != ''").select("json_file")
    return kwic_rows(attach_fulltext(described, read_fulltext(spark, fulltext_path, only=wanted)), vocab, context)
