"""Citation strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def citation_string(
    short_names: Column, title: Column, journal: Column, years: Column,
    volume: Column, issue: Column, pages: Column, pmid: Column,
) -> Column:
    """One line of citation; ``short_names`` and ``years`` are arrays."""
    stop = F.when(title.endswith("."), F.lit("")).otherwise(F.lit("."))
    in_brackets = F.when(issue == "", F.lit("")).otherwise(F.concat(F.lit("("), issue, F.lit(")")))
    return F.concat(
        F.array_join(short_names, ", "), F.lit(". "),
        title, stop, F.lit(" "),
        journal, F.lit(" ("), F.array_join(years.cast("array<string>"), ", "), F.lit(");"),
        volume, in_brackets, F.lit(":"), pages,
        F.lit(". PubMed PMID: "), pmid,
    )
