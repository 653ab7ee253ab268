"""Author names. Every argument is text where a missing part is empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _append(base: Column, part: Column) -> Column:
    return F.when(part == "", base).otherwise(F.concat(base, F.lit(" "), part))


def family_name(last: Column, suffix: Column) -> Column:
    return _append(last, suffix)


def full_name(collective: Column, given: Column, last: Column, suffix: Column) -> Column:
    """The group's name, or given and family name (a missing given name leaves its space)."""
    return F.when(collective != "", collective).otherwise(
        F.concat(given, F.lit(" "), family_name(last, suffix))
    )


def short_name(collective: Column, last: Column, initials: Column, suffix: Column) -> Column:
    """The name as citations print it."""
    return F.when(collective != "", collective).otherwise(_append(_append(last, initials), suffix))
