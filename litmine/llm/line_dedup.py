"""Near-duplicate lines by a segment-partition edit join.

Lines are cut at newlines and trimmed of ASCII white space; empty ones are no lines. Two lines of at least ``min_chars`` code points
match if their edit distance is at most ``tau``; if the shorter one has fewer, but at least ``short_chars``, if it is at most ``tau // 2``; below that
only if equal. Classes are the connected components
of matches. The first occurrence of a class (smallest document id, then line) stays, the others are removed.

A line of length n is cut into tau + 1 segments, and a matching line has one of them as a substring at nearly the same
place. Each line is indexed by (length, segment number, segment) and probes the indexes of its own and up to tau
smaller lengths with the substrings that a match can't do without, given what the other segments may have
shifted. Keys meet in hash buckets; a line that a task holds often sends its keys once, and only keys
that two different lines share go on. Pairs whose lengths or parities of letter pairs are too far apart are no candidates. Those left are verified by a banded bit-parallel edit distance, against one line of a
key first (``components.cluster``), so a large group of variants is not paired with itself.

Lines around ``min_chars`` have keys of both kinds. Lines are known by 64-bit hashes; where two have the same hash, the tried pair has one text. Null texts have
no lines. Rows with the same id are versions of one document: their lines at one place count as one occurrence, and stay or go
together. A null id comes last. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.llm.components import cluster
from litmine.llm.tables import NO_ID, bucket_count, id_or_last, id_or_null, packed_texts, unpacked
from litmine.session import written

FLUSH, SEEN, KEYED_BYTES = 1 << 17, 1 << 18, 1 << 18
EXCHANGE = "bucket int, lines binary, sizes binary, marks binary, k binary, line binary"


def _common(p: str, t: str) -> int:
    """The length of the common beginning, by halving."""
    low, high = 0, min(len(p), len(t))
    while low < high:
        at = (low + high + 1) // 2
        low, high = (at, high) if p[low:at] == t[low:at] else (low, at - 1)
    return low


def banded_distance(p: str, t: str, tau: int) -> int:
    """The edit distance if it is at most ``tau``, else ``tau + 1``.

    Bit-parallel over a band of 2 tau + 1 diagonals: bit b of a column j stands for row j - tau + b. The value is
    followed down the lowest diagonal of the band and then along the last row.
    """
    start = _common(p, t)
    p, t = p[start:], t[start:]
    end = _common(p[::-1], t[::-1])
    p, t = p[: len(p) - end], t[: len(t) - end]
    if len(p) > len(t):
        p, t = t, p
    m, n = len(p), len(t)
    if n - m > tau:
        return tau + 1
    if m == 0:
        return n
    if m <= tau:  # no band to speak of
        row = list(range(m + 1))
        for j, c in enumerate(t, 1):
            last, row[0] = row[0], j
            for i in range(1, m + 1):
                last, row[i] = row[i], min(last + (p[i - 1] != c), row[i] + 1, row[i - 1] + 1)
        return min(row[m], tau + 1)
    where: dict[str, int] = {}
    for i, c in enumerate(p, 1):
        where[c] = where.get(c, 0) | 1 << i
    width = 2 * tau + 1
    mask, low = (1 << width) - 1, 1 << (width - 1)
    up, down, value = ((1 << tau) - 1) << (tau + 1), 0, tau
    for j, c in enumerate(t, 1):
        up, down = up >> 1 | low, down >> 1
        rows = where.get(c, 0)
        equal = (rows >> (j - tau) if j >= tau else rows << (tau - j)) & mask
        same = ((((equal & up) + up) ^ up) | equal | down) & mask
        right, left = (down | ~(same | up)) & mask, same & up
        if j <= m - tau:
            value += not same & low
        else:
            bit = 1 << (m - j + tau)
            value += bool(right & bit) - bool(left & bit)
        if value > 2 * tau + n - m:  # it falls by at most one for each of the columns left along the last row
            return tau + 1
        right, left = (right << 1 | 1) & mask, left << 1 & mask
        up, down = (left | ~(same | right)) & mask, same & right
    return min(value, tau + 1)


def segments(length: int, tau: int) -> list[tuple[int, int]]:
    """Start and length of the tau + 1 segments of a line, the longer ones last."""
    size, longer = divmod(length, tau + 1)
    out, at = [], 0
    for i in range(tau + 1):
        n = size + (i >= tau + 1 - longer)
        out.append((at, n))
        at += n
    return out


def probes(length: int, tau: int) -> tuple[list, list]:
    """Of a line of this length what to index and what else to look up: (length, segment, start, size)."""
    own = [(length, i, s, n) for i, (s, n) in enumerate(segments(length, tau))]
    seen, look = set(own), []
    for other in range(length - tau, length + 1):
        shift = length - other
        for i, (s, n) in enumerate(segments(other, tau)):
            first = max(0, s - i, s + shift - (tau - i))
            last = min(length - n, s + i, s + shift + (tau - i))
            look += [(other, i, at, n) for at in range(first, last + 1) if (other, i, at, n) not in seen]
    return own, look


def find_lines(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each line with a word: its text, number in it, and trimmed byte bounds."""
    words = A.find_words(data, bounds)
    at = np.flatnonzero(data == 10)
    start, end = np.sort(np.concatenate((bounds[:-1], at + 1))), np.sort(np.concatenate((at, bounds[1:])))
    first, last = np.searchsorted(words.start, start), np.searchsorted(words.start, end)
    full = np.flatnonzero(last > first)
    row = words.rows()[first[full]]
    number = full - row - np.searchsorted(at, bounds[row], "left")
    return row, number, words.start[first[full]], words.end[last[full] - 1]


def _points(data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """A number for each code point that starts at ``heads``: its bytes in base 256, which is one-to-one."""
    points = data[heads].astype(A.U64)
    rest = np.flatnonzero((data & 0xC0) == 0x80)
    if len(rest) and len(heads):
        of = np.maximum(np.searchsorted(heads, rest, "right") - 1, 0)
        np.add.at(points, of, data[rest].astype(A.U64) << (A.U64(8) * np.clip(rest - heads[of], 1, 3).astype(A.U64)))
    return points


def _parities(data: np.ndarray, heads: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each line 64 parities of how many of its pairs of neighbouring code points fall into each of 64 classes.

    An edit takes away at most two pairs and adds at most two, so it changes at most four parities.
    """
    points = _points(data, heads)
    pairs = (points[:-1] * A.U64(A.WORD_BASE) + points[1:]) * A.U64(A.BYTE_BASE) >> A.U64(58)
    total = np.zeros(len(pairs) + 1, A.U64)
    np.bitwise_xor.accumulate(A.U64(1) << pairs, out=total[1:])
    return (total[last - 1] ^ total[first]).view(np.int64)


class Plans:
    """What to index and to look up for lines of each length, one length after another in flat arrays.

    A line has keys for each distance that it can be matched by.
    """

    def __init__(self, tau: int, min_chars: int, short_chars: int):
        self.tau, self.min_chars = tau, min_chars
        self.floor = min(short_chars, min_chars) if tau > 1 else min_chars
        self.rows: list[tuple] = []
        self.known: dict[int, tuple[int, int]] = {}
        self.flat = np.zeros((0, 4), np.int64)

    def plan(self, n: int) -> None:
        tiers = ([(self.tau, 0)] if n >= self.min_chars else []) + ([(self.tau // 2, 32)] if n < self.min_chars + self.tau // 2 and self.floor < self.min_chars else [])
        found = [[], []]
        for t, salt in tiers:
            for out, keys in zip(found, probes(n, t)):
                out += [(s, size, length * 64 + i + salt) for length, i, s, size in keys]
        self.known[n] = len(self.rows), sum(map(len, found))
        self.rows += [(*row, lead) for lead, rows in zip((1, 0), found) for row in rows]

    def of(self, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The line of every key and the key's row ``(start, size, salt, lead)``."""
        lengths, place = np.unique(sizes, return_inverse=True)
        lengths = lengths.tolist()
        new = [n for n in lengths if n >= self.floor and n not in self.known]
        for n in new:
            self.plan(n)
        if new:
            self.flat = np.array(self.rows, np.int64)
        start, count = (np.array([self.known.get(n, (0, 0))[i] for n in lengths], np.int64)[place] for i in (0, 1))
        line = np.repeat(np.arange(len(sizes)), count)
        return line, self.flat[np.arange(len(line)) + np.repeat(start - np.cumsum(count) + count, count)]


def _keys_of(data: np.ndarray, spans: A.Spans, start: np.ndarray, end: np.ndarray, plans: Plans):
    """Index and probe keys of the lines given by byte bounds: key, line number, whether it indexes; and the lines' sizes and parities."""
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # where code points start
    first, last = np.searchsorted(heads, start), np.searchsorted(heads, end)
    sizes = last - first
    line, rows = plans.of(sizes)
    marks = _parities(data, heads, first, last)
    heads = np.append(heads, len(data))
    at = first[line] + rows[:, 0]
    h = spans.hash(heads[at], heads[at + rows[:, 1]])
    h = A.mix(h ^ A.mix(rows[:, 2].astype(A.U64)))
    return h, line, rows[:, 3].astype(bool), sizes, marks


def _candidates(docs: DataFrame, tau: int, min_chars: int, short_chars: int, buckets: int) -> DataFrame:
    """Rows ``k, id, size, missed, score, lead`` of the keys that different lines share; ``missed`` holds the line's parities."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans = Plans(tau, min_chars, short_chars)
        seen: set[int] = set()  # an equal line has equal keys, so only its first occurrence of late needs any
        held: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            key, line, size, mark, lead = (np.concatenate(x) for x in zip(*held))
            held.clear()
            known, place = np.unique(line, return_inverse=True)
            of, marks = np.zeros((2, len(known)), np.int64)
            of[place], marks[place] = size, mark
            order = np.lexsort((place, key))
            key, place, lead = key[order], place[order], lead[order]
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])))  # an equal line sends its keys once
            key, tag = key[new], (place[new] * 2 + lead[new]).astype(np.uint32)
            bucket = A.bucket_of(key, buckets)
            out = []
            for s, n in zip(*A.runs(bucket)):
                used, at = np.unique(tag[s : s + n] >> 1, return_inverse=True)
                own = (at * 2 + (tag[s : s + n] & 1)).astype(np.uint32)
                out.append((int(bucket[s]), *(x[used].tobytes() for x in (known, of, marks)), key[s : s + n].tobytes(), own.tobytes()))
            types = [pa.int32()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["bucket", "lines", "sizes", "marks", "k", "line"])

        for batch in batches:
            for _, data, bounds in A.chunks(batch, limit=KEYED_BYTES):
                _, _, start, end = find_lines(data, bounds)
                if not len(start):
                    continue
                spans = A.Spans(data.astype(A.U64) + A.U64(1), A.BYTE_BASE)
                names = spans.hash(start, end).view(np.int64)
                new, place = np.unique(names, return_index=True)
                fresh = np.array([h not in seen for h in new.tolist()])
                seen.update(new[fresh].tolist())
                if len(seen) > SEEN:
                    seen.clear()
                of = np.sort(place[fresh])
                if not len(of):
                    continue
                names = names[of]
                key, line, lead, sizes, marks = _keys_of(data, spans, start[of], end[of], plans)
                if len(key):
                    held.append((key, names[line], sizes[line], marks[line], lead))
                    total += len(key)
                if total >= FLUSH:
                    yield flush()
                    total = 0
        if held:
            yield flush()

    schema = pa.schema([(c, pa.int64()) for c in ("k", "id", "size", "missed", "score")] + [("lead", pa.bool_())])

    def meet(table: pa.Table) -> pa.Table:
        key, line, size, mark, lead = [], [], [], [], []
        for r in table.to_pylist():
            tag = np.frombuffer(r["line"], np.uint32)
            key.append(np.frombuffer(r["k"], A.U64))
            line.append(np.frombuffer(r["lines"], np.int64)[tag >> 1])
            size.append(np.frombuffer(r["sizes"], np.int64)[tag >> 1])
            mark.append(np.frombuffer(r["marks"], np.int64)[tag >> 1])
            lead.append((tag & 1).astype(bool))
        key, line, size, mark, lead = (np.concatenate(x) for x in (key, line, size, mark, lead))
        order = np.lexsort((line, key))
        key, line, size, mark, lead = (x[order] for x in (key, line, size, mark, lead))
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (line[1:] != line[:-1])))
        key, line, size, mark, lead = (x[new] for x in (key, line, size, mark, lead))
        start, length = A.runs(key)
        shared = (length > 1) & (np.add.reduceat(lead.astype(np.int64), start) > 0)
        keep = np.repeat(shared, length)
        none = np.zeros(int(keep.sum()), np.int64)
        return pa.table([key[keep].view(np.int64), line[keep], size[keep], mark[keep], none, lead[keep]], schema=schema)

    return docs.select("text").mapInArrow(scan, EXCHANGE).groupBy("bucket").applyInArrow(
        meet, "k long, id long, size long, missed long, score long, lead boolean"
    )


def _occurrences(docs: DataFrame) -> DataFrame:
    """Rows ``doc, number, line``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                row, number, start, end = find_lines(data, bounds)
                line = A.span_hash(data.astype(A.U64) + A.U64(1), start, end, A.BYTE_BASE).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(number), pa.array(line)], ["doc", "number", "line"])

    return docs.mapInArrow(scan, "doc long, number long, line long")


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows ``line, text`` for ``wanted (doc, lines)``; each line of it once."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in unpacked(batch):
                data, bounds = A.texts_of(part.column(part.num_columns - 1))
                row, _, start, end = find_lines(data, bounds)
                line = A.span_hash(data.astype(A.U64) + A.U64(1), start, end, A.BYTE_BASE).view(np.int64)
                lists = [set(x) for x in part.column(3).to_pylist()]
                keep = [i for i, (r, h) in enumerate(zip(row.tolist(), line.tolist())) if h in lists[r]]
                texts = [data[start[i] : end[i]].tobytes() for i in keep]
                yield pa.RecordBatch.from_arrays([pa.array(line[keep]), pa.array(texts, pa.binary())], ["line", "text"])

    return packed_texts(docs, ["doc"]).join(wanted, "doc").mapInArrow(scan, "line long, text binary").dropDuplicates(["line"])


def line_dedup(docs: DataFrame, tau: int = 2, min_chars: int = 40, short_chars: int = 20) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_lines, n_removed, removed`` (line numbers from 0), ``copied_from`` (ids of the
    documents whose lines stay for them) and ``kept``, the text without those lines."""
    if min_chars <= tau:
        raise ValueError("min_chars must be greater than tau")
    if short_chars <= tau // 2:
        raise ValueError("short_chars must be greater than tau // 2")
    rows = docs.select(id_or_last().alias("doc"), "text")
    found = written(_occurrences(rows), "lines")
    keys = written(_candidates(rows, tau, min_chars, short_chars, bucket_count(docs)), "keys")
    homes = keys.select(F.col("id").alias("line")).distinct().join(found.groupBy("line").agg(F.min("doc").alias("doc")), "line")
    lines = written(_texts(rows, homes.groupBy("doc").agg(F.collect_list("line").alias("lines"))), "texts")

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [batch.column(i).cast(pa.string()).to_pylist() for i in (2, 3)]
            kept = batch.select([0, 1]).filter(pa.array([banded_distance(p, t, tau) <= (tau if min(len(p), len(t)) >= min_chars else tau // 2) for p, t in zip(*texts)], pa.bool_()))
            if kept.num_rows:
                yield kept

    def verify(pairs: DataFrame) -> DataFrame:
        at = {s: lines.select(F.col("line").alias(s), F.col("text").alias(f"t{s}")) for s in "ab"}
        return pairs.join(at["b"], "b").join(at["a"], "a").select("a", "b", "ta", "tb").mapInArrow(match, "a long, b long")


    def near(n, mark, m, other):
        most = F.when(F.least(n, m) >= min_chars, tau).otherwise(tau // 2)
        return (F.abs(n - m) <= most) & (F.bit_count(mark.bitwiseXOR(other)) <= 4 * most)

    labels = cluster(keys, verify, near)
    classed = found.join(labels.withColumnRenamed("id", "line"), "line", "left").withColumn("label", F.coalesce("label", "line"))
    classed = written(classed.select("doc", "number", "label"), "classes")
    spots = classed.groupBy("label").agg(F.min(F.struct("doc", "number")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    spots = written(spots.select("label", F.col("first.doc").alias("home"), F.col("first.number").alias("line")), "firsts")
    gone = classed.join(spots, "label").where("NOT (doc = home AND number = line)").select("doc", "number", "home").distinct()
    gone = gone.groupBy("doc").agg(F.sort_array(F.collect_set("number")).alias("removed"), F.sort_array(F.collect_set("home")).alias("copied_from"))
    joined = packed_texts(rows, ["doc"]).join(gone, "doc", "left")
    schema = "doc long, n_lines long, n_removed long, removed array<bigint>, copied_from array<bigint>, kept binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in unpacked(batch):
                data, bounds = A.texts_of(part.column(part.num_columns - 1))
                row, number, _, _ = find_lines(data, bounds)
                counts = np.bincount(row, minlength=part.num_rows)
                have: list[set] = [set() for _ in range(part.num_rows)]
                for r, n in zip(row.tolist(), number.tolist()):
                    have[r].add(n)
                out = []
                for t, removed in enumerate(part.column(3).to_pylist()):
                    text = data[bounds[t] : bounds[t + 1]].tobytes()
                    drop = {n for n in removed or [] if n in have[t]}
                    kept = b"\n".join(x for i, x in enumerate(text.split(b"\n")) if i not in drop) if drop else text
                    out.append((sorted(drop), kept))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array([len(r) for r, _ in out], pa.int64()), pa.array([r for r, _ in out], pa.list_(pa.int64())),
                     pa.array([c or [] for c in part.column(4).to_pylist()], pa.list_(pa.int64())), pa.array([k for _, k in out], pa.binary())],
                    ["doc", "n_lines", "n_removed", "removed", "copied_from", "kept"],
                )

    result = joined.mapInArrow(cut, schema)
    return result.select(
        id_or_null("doc").alias("doc_id"), "n_lines", "n_removed", "removed",
        F.transform("copied_from", lambda i: F.when(i != NO_ID, i)).alias("copied_from"), F.col("kept").cast("string").alias("kept")
    )
