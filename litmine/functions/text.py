"""Text cleaning, escaping, tokenising and keyword-in-context slices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop words of the public Lucene analyzer.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
)
# Fixed value: the characters Lucene's query syntax reserves.
QUERY_SYNTAX = r'([\\+\-!():^\[\]"{}~*?|&/])'

# A word is a maximal run of letters and digits; the second pattern also
# yields the runs between words, so that its matches tile the text.
WORD = r"[\p{L}\p{N}]+"
RUN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def text_or_empty(value: Column) -> Column:
    """A missing field reads as the empty string, never NULL."""
    return F.coalesce(value.cast("string"), F.lit(""))


def collapse_whitespace(value: Column) -> Column:
    return F.regexp_replace(value, r"\s+", " ")


def escape_query_syntax(value: Column) -> Column:
    """Put a backslash before every reserved query character."""
    return F.regexp_replace(value, QUERY_SYNTAX, r"\\$1")


def _strip(value: Column) -> Column:
    """Strip every character up to U+0020 from both ends, as the JVM's trim does."""
    return F.regexp_replace(value, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def remove_stop_characters(value: Column) -> Column:
    """Clean a matched string: no stop words, no escapes, no outer punctuation."""
    pieces = F.transform(F.split(value, r"\b+"), _strip)
    kept = F.filter(pieces, lambda p: (p != "") & ~F.lower(p).isin(*STOP_WORDS))
    joined = F.array_join(F.transform(kept, lambda p: F.regexp_replace(p, r"\\(.)", "$1")), " ")
    bare = F.regexp_replace(F.regexp_replace(joined, r"^\W+", ""), r"\W+$", "")
    return _strip(F.regexp_replace(bare, r"\s+(\p{Punct})\s+", "$1"))


def kwic_before(text: Column, start: Column, width: int) -> Column:
    """Up to ``width`` characters before offset ``start`` (0-based)."""
    begin = F.greatest(start - width, F.lit(0))
    return F.substring(text, begin + 1, start - begin)


def kwic_after(text: Column, end: Column, width: int) -> Column:
    """Up to ``width`` characters from offset ``end`` (0-based, exclusive end of the match)."""
    return F.substring(text, end + 1, F.lit(width))


def word_array(text: Column) -> Column:
    """The lower-cased words of a text, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lower)


def normalize_surface(surface: Column) -> Column:
    """The join key of a vocabulary surface: its lower-cased words, one space apart."""
    return F.array_join(word_array(surface), " ")
