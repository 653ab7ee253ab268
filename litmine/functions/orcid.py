"""Author identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from litmine.functions.text import let

# The spellings of an ORCID that are accepted, and its prefix.
ORCID_NOISE = r"[\s+\-]"
ORCID_URL = r"^https?://(?:www.)?orcid.org/"
ORCID_PREFIX = "https://orcid.org/"
# A URI may hold neither control characters, spaces, quotes nor brackets; a
# percent sign needs two hex digits after it.
VALID_URI = r'\A(?:[^\x00-\x20\x7f"<>\\^`{|}\[\]%]|%[0-9A-Fa-f]{2})+\z'


def normalize_orcid(value: Column) -> Column:
    """``https://orcid.org/dddd-dddd-dddd-dddd``, or NULL if it is not one."""
    def finish(code: Column) -> Column:
        uri = F.concat(F.lit(ORCID_PREFIX), F.regexp_replace(code, r"(.{4})(?!$)", "$1-"))
        return F.when(F.length(code) == 16, let(uri, lambda u: F.when(u.rlike(VALID_URI), u)))

    return let(F.regexp_replace(F.regexp_replace(value, ORCID_NOISE, ""), ORCID_URL, ""), finish)


def orcid_list(identifiers: Column) -> Column:
    """All valid ORCIDs of an ``array<struct<_Source, _VALUE>>`` of identifiers."""
    marked = F.filter(identifiers, lambda i: i["_Source"] == "ORCID")
    found = F.filter(F.transform(marked, lambda i: normalize_orcid(i["_VALUE"])), lambda o: o.isNotNull())
    return F.coalesce(found, F.array().cast("array<string>"))


def first_orcid(orcids: Column) -> Column:
    """The ORCID that names the author, or NULL."""
    return F.get(orcids, F.lit(0))
