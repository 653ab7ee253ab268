"""Words of Arrow string columns as numpy arrays, and hashes of spans and word windows.

A word is a run of bytes outside 0x20 and 0x09-0x0D, which in UTF-8 is the pattern
``[^\\x20\\x09-\\x0D]+``. Everything is computed for a chunk of whole texts at once;
a chunk holds about ``CHUNK_BYTES``, or one text if that is longer.

Span hashes are polynomial prefix sums modulo 2**64, finished by a mixing step. The base
is odd, so a span can be shifted to position zero by the inverse power.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole number (a public finaliser with its usual constants)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse modulo 2**64."""
    known = _powers.get(base)
    if known is None or len(known[0]) < n:
        size = max(n, 1 << 16)
        size = 1 << (size - 1).bit_length()
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, U64)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        known = _powers[base] = (pair[0], pair[1])
    return known


class Spans:
    """Hashes of spans of ``values``: equal spans give equal hashes. The sums are made once for any number of calls."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        up, self.down = powers(base, len(values) + 1)
        self.total = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=self.total[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(U64))


def span_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """A hash of ``values[start:end]`` for every pair of bounds; equal spans give equal hashes."""
    return Spans(values, base).hash(start, end)


@dataclass
class Words:
    """The words of a chunk of texts: byte bounds, and for text ``t`` the words ``first[t]:first[t + 1]``."""

    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return span_hash(self.data.astype(U64) + U64(1), self.start, self.end, BYTE_BASE)

    def room(self, n: int) -> np.ndarray:
        """Of every word: whether ``n`` words from it on lie in its text."""
        return np.arange(len(self.start)) + n <= np.repeat(self.first[1:], self.counts)

    def spaced(self, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The words (or those kept) with one space after each, as bytes, and where each ends without its space."""
        start, end = (self.start, self.end) if kept is None else (self.start[kept], self.end[kept])
        stop = np.cumsum(end - start + 1)
        out = np.full(stop[-1] if len(stop) else 0, 32, np.uint8)
        letter = np.ones(len(out), bool)
        letter[stop - 1] = False
        edge = np.zeros(len(self.data) + 1, np.int8)
        edge[start] = 1
        edge[end] -= 1
        out[letter] = self.data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
        return out, stop - 1


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of a string or binary column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def find_words(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray | None = None) -> Words:
    """Runs of bytes that are ``inside`` (by default no white space), never across two texts."""
    inside = ~SPACE[data] if inside is None else inside
    before, after = np.empty_like(inside), np.empty_like(inside)
    if len(inside):
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        cuts = bounds[1:-1]
        before[cuts[cuts < len(data)]] = False
        after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    return Words(data, bounds, start, np.flatnonzero(inside & ~after) + 1, np.searchsorted(start, bounds))


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def lower_latin(data: np.ndarray) -> np.ndarray:
    """A-Z and the letters U+00C0 to U+00DE of UTF-8 in lower case."""
    data = lower(data)
    if len(data) > 1:
        wide = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data = data.copy()
        data[1:][wide] += np.uint8(0x20)
    return data


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch with about ``limit`` bytes of text, with those bytes and their bounds."""
    data, bounds = texts_of(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
        to = min(to, batch.num_rows)
        yield batch.slice(at, to - at), data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def gram_hash(word_hash: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` words of a chunk, also of those across two texts (see ``Words.room``)."""
    if len(word_hash) < n:
        return np.zeros(0, U64)
    start = np.arange(len(word_hash) - n + 1)
    return span_hash(word_hash, start, start + n, WORD_BASE)


def sliding_min(values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of ``n`` values the smallest one and its leftmost position."""
    size = len(values) - n + 1
    if size <= 0:
        return np.zeros(0, values.dtype), np.zeros(0, np.int64)
    least, span = values, 1
    while span * 2 <= n:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:size], least[n - span : n - span + size])
    at = np.zeros(size, np.int64)
    for k in range(n - 1, -1, -1):
        np.copyto(at, np.arange(k, k + size), where=values[k : k + size] == least)
    return least, at


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal neighbours."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return start, np.diff(np.append(start, len(values)))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Equal ranges of the hash space; sorted hashes have sorted buckets."""
    return (((h >> U64(32)) * U64(buckets)) >> U64(32)).astype(np.int64)


def pack_ids(ids: np.ndarray) -> bytes:
    """Integers as bytes: offsets from the least one if they span fewer than 2**32, else a dictionary and places."""
    ids = ids.astype(np.int64)
    if not len(ids):
        return b""
    least, most = int(ids.min()), int(ids.max())
    if most - least < 1 << 32:
        return b"o" + np.int64(least).tobytes() + (ids - least).astype(np.uint32).tobytes()
    known, place = np.unique(ids, return_inverse=True)
    kind = np.uint16 if len(known) <= 1 << 16 else np.uint32
    return (b"s" if kind is np.uint16 else b"d") + np.int64(len(known)).tobytes() + known.tobytes() + place.astype(kind).tobytes()


def unpack_ids(packed: bytes) -> np.ndarray:
    if not packed:
        return np.zeros(0, np.int64)
    number = int(np.frombuffer(packed, np.int64, 1, 1)[0])
    if packed[:1] == b"o":
        return np.frombuffer(packed, np.uint32, -1, 9).astype(np.int64) + number
    known = np.frombuffer(packed, np.int64, number, 9)
    return known[np.frombuffer(packed, np.uint16 if packed[:1] == b"s" else np.uint32, -1, 9 + 8 * number)]
