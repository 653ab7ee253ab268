"""Which fields an XML corpus uses, and how often.

Walking a tree of unknown depth has no built-in expression; it is the one
place where Python runs, over Arrow batches, and each batch is counted before
it leaves the worker.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.sources.articles_xml import CLOSING_TAG

# Fixed value: the attribute whose values are counted one by one.
EXPANDED_ATTRIBUTES = frozenset({"PubMedPubDate/PubStatus"})
ROOT = "PubmedArticleSet"
MALFORMED = "#malformed"
COUNT_SCHEMA = "source_file string, path string, n long"


def batch_counter(root: str, expanded: frozenset[str], whitespace: bool, closing_tag: str):
    """The function that counts one Arrow batch; self-contained, as it is sent to the workers."""

    def local(name: str) -> str:
        return name.rsplit("}", 1)[-1]

    class Place:
        """A path, and the places of what lies directly in it: elements, attributes, values of expanded attributes."""

        __slots__ = ("path", "below", "attributes", "values")

        def __init__(self, path: str):
            self.path, self.below, self.attributes, self.values = path, {}, {}, None

    def attribute(at: Place, tag: str, key: str) -> Place:
        found = at.attributes[key] = Place(f"{at.path}/{local(key)}")
        if f"{local(tag)}/{local(key)}" in expanded:
            found.values = {}
        return found

    def walk(text: str, top: Place) -> list[str]:
        """The path of every text run, and of every attribute below the root, as the parser comes by."""
        found, above, at, run = [], [], None, False

        def start(tag: str, attributes: list[str]) -> None:
            nonlocal at, run
            if run:
                found.append(at.path)
                run = False
            above.append(at)
            if at is None:  # the root
                at = top
                return
            here = at.below.get(tag)
            if here is None:
                here = at.below[tag] = Place(f"{at.path}.{local(tag)}")
            at = here
            if not attributes:
                return
            for i in range(0, len(attributes), 2):  # names and values in turn
                key = attributes[i]
                place = here.attributes.get(key) or attribute(here, tag, key)
                if place.values is None:
                    found.append(place.path)
                else:
                    value = attributes[i + 1]
                    found.append(place.values.get(value) or place.values.setdefault(value, f"{place.path}#{value}"))

        def end(tag: str) -> None:
            nonlocal at, run
            if run:
                found.append(at.path)
                run = False
            at = above.pop()

        def any_text(data: str) -> None:
            nonlocal run
            run = True

        def dark_text(data: str) -> None:
            nonlocal run
            run = run or not data.isspace()

        parser = expat.ParserCreate(namespace_separator="}")
        parser.buffer_text = parser.ordered_attributes = True
        parser.StartElementHandler, parser.EndElementHandler = start, end
        parser.CharacterDataHandler = any_text if whitespace else dark_text
        parser.Parse(text, True)
        return found

    def siblings(chunk: str) -> str:
        """What a chunk holds between the root's tags, wrapped so that it parses on its own."""
        if f"<{root}" in chunk:
            chunk = re.sub(rf"\A.*?<{root}(?:\s[^>]*)?>", "", chunk, count=1, flags=re.S)
        if f"</{root}" in chunk:
            chunk = re.sub(rf"</{root}\s*>.*\Z", "", chunk, flags=re.S)
        return f"<{root}>{chunk}</{root}>"

    def paths(chunk: str, top: Place) -> list[str] | None:
        for text in (chunk + closing_tag, chunk):
            try:
                return walk(siblings(text), top)
            except expat.ExpatError:
                continue
        return None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Places are made for well-formed records and others; paths are counted of the former only.
            seen: dict[str, tuple[Place, Counter[str]]] = {}
            for source, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if source not in seen:
                    seen[source] = Place(root), Counter()
                top, n = seen[source]
                found = paths(chunk or "", top)
                n.update((MALFORMED,) if found is None else found)
            rows = [(s, p, n) for s, (_, counted) in seen.items() for p, n in counted.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                names=["source_file", "path", "n"],
            )

    return count


def field_counts(
    chunks: DataFrame, root: str = ROOT, expanded: Iterable[str] = EXPANDED_ATTRIBUTES,
    count_whitespace_text: bool = True, closing_tag: str = CLOSING_TAG,
) -> DataFrame:
    """``field_counts(source_file, path, n)`` from ``(source_file, chunk)`` rows.

    A chunk is file text up to (not including) a record's closing tag, as
    ``read_chunks`` yields it; what follows the last record has none. Text
    counts under the path of the tag around it, attributes under
    ``parent.tag/attribute``. A chunk that cannot be parsed counts under
    ``#malformed``.
    """
    count = batch_counter(root, frozenset(expanded), count_whitespace_text, closing_tag)
    partial = chunks.select("source_file", "chunk").mapInArrow(count, COUNT_SCHEMA)
    return partial.groupBy("source_file", "path").agg(F.sum("n").alias("n"))


def sum_field_counts(counts: DataFrame) -> DataFrame:
    """Totals over all files, sorted by path."""
    return counts.groupBy("path").agg(F.sum("n").alias("n")).orderBy("path")
