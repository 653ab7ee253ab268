"""Page ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how a page range is written.
PAGE_RANGE = r"\A(.+?)\s*-\s*(.+)\z"


def split_page_range(ranges: Column) -> Column:
    """``struct<start, end>`` if the array holds exactly one splittable range, else NULL.

    The end is not expanded: ``715-28`` ends at ``28``.
    """
    only = F.get(ranges, F.lit(0))
    return F.when(
        (F.size(ranges) == 1) & only.rlike(PAGE_RANGE),
        F.struct(
            F.regexp_extract(only, PAGE_RANGE, 1).alias("start"),
            F.regexp_extract(only, PAGE_RANGE, 2).alias("end"),
        ),
    )
