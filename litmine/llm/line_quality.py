"""Quality rules: base counts of each document, and lines that too many documents of a host share.

Lines are normalised (words joined, A-Z lower-cased, digits as 0) and hashed. For each host
(``host`` column) the documents with a line are counted, equal texts once, and a line is
above the limit if more than ``min_docs`` documents and more than ``share`` of the host's documents have it.
Lines above the limit are taken out of the texts, and what is left is counted. Documents that keep less than ``left`` of
their words, or fewer than ``min_words``, are depleted.

Counts are pre-aggregated before the shuffle, so a line that a third of all documents hold is a
few rows. Texts meet the lines to take out of them compressed. Null texts have no words and fail the base rules. A null host is a host of its own.
Repeated rows all get the same result and count once. Ids are only carried. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.llm.tables import packed_texts, unpacked
from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEWLINE, REPEAT = 10, 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def normal(data: np.ndarray) -> np.ndarray:
    data = A.lower(data)
    return np.where((data >= 48) & (data <= 57), np.uint8(48), data)


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass
class Lines:
    """The lines with words of a chunk of texts: byte bounds, hashes of the normalised lines, and for text ``t`` the lines ``cut[t]:cut[t + 1]``."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    cut: np.ndarray


def find_lines(words: A.Words) -> Lines:
    data, bounds = words.data, words.bounds
    at = np.flatnonzero(data == NEWLINE)
    start, end = np.sort(np.concatenate((bounds[:-1], at + 1))), np.sort(np.concatenate((at, bounds[1:])))
    first, last = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
    full = last > first
    start, end, first, last = start[full], end[full], first[full], last[full]
    plain = A.span_hash(normal(data).astype(A.U64) + A.U64(1), words.start, words.end, A.BYTE_BASE)
    line = A.span_hash(plain, first, last, A.WORD_BASE)
    return Lines(start, end, line.view(np.int64), np.searchsorted(words.rows()[first], np.arange(len(bounds))))


def text_counts(words: A.Words, lines: Lines) -> list[np.ndarray]:
    """The base counts of each text."""
    data, bounds = words.data, words.bounds
    n = len(bounds) - 1
    per_word = _per_text((data & 0xC0) != 0x80, np.stack((words.start, words.end)).T.ravel()) if len(words.start) else np.zeros(0, np.int64)
    chars = np.zeros(n, np.int64)
    rows = words.rows()
    np.add.at(chars, rows, per_word[::2])
    raw = A.span_hash(data.astype(A.U64) + A.U64(1), lines.start, lines.end, A.BYTE_BASE)
    distinct = np.array([len(np.unique(raw[a:e])) for a, e in zip(lines.cut[:-1], lines.cut[1:])], np.int64)

    grams = A.gram_hash(words.hashes(), REPEAT)
    here = np.flatnonzero(words.room(REPEAT))
    key = A.mix(grams[here] ^ A.mix(rows[here].astype(A.U64) + A.U64(1)))
    order = np.argsort(key)
    _, length = A.runs(key[order])
    again = here[order[np.repeat(length > 1, length)]]
    edge = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + REPEAT, -1)
    covered = np.cumsum(edge)[:-1] > 0
    return [words.counts, chars, _per_text(SYMBOLS[data], bounds), np.diff(lines.cut) - distinct, _per_text(covered, words.first)]


def without_lines(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    """A text without the lines at ``start`` to ``end`` (ascending) and their line ends."""
    if not len(start):
        return text
    raw = np.frombuffer(text, np.uint8)
    keep = np.ones(len(raw), bool)
    for a, e in zip(start, end):
        keep[a : e + 1] = False
    left = raw[keep].tobytes()
    return left[:-1] if end[-1] == len(raw) and left.endswith(b"\n") else left


def _lines_of(docs: DataFrame) -> DataFrame:
    """``key, host, body, lines``: the distinct lines of each row of ``docs`` as hashes."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                lines = find_lines(A.find_words(data, bounds))
                found = [np.unique(lines.hash[a:e]) for a, e in zip(lines.cut[:-1], lines.cut[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(3)] + [pa.array(found, pa.list_(pa.int64()))], ["key", "host", "body", "lines"])

    return docs.select("key", "host", "body", "text").mapInArrow(scan, f"key long, host {dict(docs.dtypes)['host']}, body long, lines array<bigint>")


def _cleaned(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``doc_id``, the base counts, ``removed_words`` and ``cleaned``, the text without the lines that ``removed(key, gone)`` has for it."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (small for packed in batches for small in unpacked(packed)):
            for part, data, bounds in A.chunks(batch):
                words = A.find_words(data, bounds)
                lines = find_lines(words)
                counts = text_counts(words, lines)
                gone, missing, texts = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("gone", "missing", "text"))
                left = words.counts.copy()
                for t in (t for t, hashes in enumerate(gone) if hashes):
                    a, e = lines.cut[t], lines.cut[t + 1]
                    out = np.isin(lines.hash[a:e], gone[t])
                    texts[t] = without_lines(texts[t], lines.start[a:e][out] - bounds[t], lines.end[a:e][out] - bounds[t])
                    left[t] = A.find_words(np.frombuffer(texts[t], np.uint8), np.array([0, len(texts[t])])).counts[0]
                raw = pa.array([None if none else text for none, text in zip(missing, texts)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0)] + [pa.array(c, pa.int64()) for c in (*counts, words.counts - left)]
                    + [pa.Array.from_buffers(pa.string(), len(raw), raw.buffers())], ["doc_id", *COUNTS, "removed_words", "cleaned"])

    packed = packed_texts(docs.withColumn("missing", F.isnull("text")), ["doc_id", "key", "missing"])
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in (*COUNTS, "removed_words")) + ", cleaned string"
    return packed.join(removed, "key", "left").select("doc_id", "missing", "packed", "size", "gone").mapInArrow(scan, schema)


def line_quality(
    docs: DataFrame, host: str = "source", min_docs: int = 20, share: float = 0.05, left: float = 0.3, min_words: int = 10
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, the base counts, ``removed_words``, ``base_failed``, ``kept`` and ``cleaned``, the text without frequent lines."""
    rows = docs.select("doc_id", F.col(host).alias("host"), "text").withColumns(
        {"key": F.xxhash64("doc_id", "host", "text"), "body": F.xxhash64("text")}
    )
    features = written(_lines_of(rows), "features")
    each = features.select("key", "host", "body", F.explode("lines").alias("line"))
    found = each.select("host", "line", "body").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    hosts = features.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    found = written(found.where(F.col("docs") > min_docs), "lines")
    hosts = broadcast_if_small(written(hosts, "hosts").withColumnRenamed("host", "at"))
    above = written(
        found.join(hosts, F.col("host").eqNullSafe(F.col("at"))).where(F.col("docs") > share * F.col("of")).select("host", "line"), "above"
    )
    over = broadcast_if_small(above.select(F.col("host").alias("at"), F.col("line").alias("of")))
    hit = each.join(over, F.col("host").eqNullSafe(F.col("at")) & (F.col("line") == F.col("of")), "left_semi")
    judged = _cleaned(rows, hit.groupBy("key").agg(F.collect_set("line").alias("gone")))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    remain = F.col("n_words") - F.col("removed_words")
    return judged.select(
        "doc_id", *COUNTS, "removed_words", failed.alias("base_failed"),
        (~failed & (remain >= min_words) & (remain >= left * F.col("n_words"))).alias("kept"), "cleaned",
    )
