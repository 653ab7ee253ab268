"""Removal of repeated passages: matching statistics of documents against suffix automata of reference shards.

A word (``[^\\x20\\x09-\\x0D]+``) is removed if a window of ``window`` consecutive words of one
document covers it whose word sequence also starts earlier: in a document with a smaller id,
or earlier in the same one. Windows are judged on the input.

The corpus is its own reference, so its automata have no size bound and are not broadcast.
They are cut into shards by content, and documents' passages are routed to them:

1. The anchor of a window is its run of ``gram`` words with the smallest hash, leftmost on ties.
   Equal windows have equal anchors at equal places. Neighbouring windows mostly share theirs,
   so there is about one anchor in seven words. Anchors that occur twice in the corpus are found in
   hash buckets; what occurs more than ``OFTEN`` times among some MB of text is known there and
   reaches its bucket once.
2. The passage of such an anchor (all words of its windows, at most ``2 * window - gram``) goes to the
   anchor's shard, of passages with equal words in a task only the first. An anchor known in this
   way, or with more than ``SHARD`` occurrences, is split further: one shard for each of its windows.
3. A shard streams its passages in document order through a suffix automaton over words. The
   matching statistic at a word is the length of the longest suffix so far that the automaton
   contains; where it reaches ``window``, the window ending there has started earlier.
   Passages with a window that is new are then added. A shard's automaton holds at most
   ``SHARD`` passages.
4. A passage that is the first with its words carries its new windows back to its document;
   every other window of a repeated anchor has an earlier copy. Documents meet these marks by id.

Words are compared in the shards as they are, so the result doesn't rest on hashes: a hash
that two anchors share only makes a shard larger.

Null texts have no words. Rows with the same id count as one document's versions: a window at the same
place of two such rows starts at the same point, so neither is earlier. A null id comes last.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.llm.tables import bucket_count, id_or_last, id_or_null, packed_texts, unpacked

FLUSH = 1 << 18
SHARD = 512
OFTEN = 8
GRAM = 8


class SuffixAutomaton:
    """All substrings of the word sequences added, each kept apart from the next by a unique mark."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.length, self.last, self.added = [-1], [0], 0, 0

    def _extend(self, word) -> None:
        now = len(self.next)
        self.next.append({})
        self.link.append(0)
        self.length.append(self.length[self.last] + 1)
        p = self.last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = now
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            if self.length[p] + 1 == self.length[q]:
                self.link[now] = q
            else:
                copy = len(self.next)
                self.next.append(dict(self.next[q]))
                self.link.append(self.link[q])
                self.length.append(self.length[p] + 1)
                while p >= 0 and self.next[p].get(word) == q:
                    self.next[p][word] = copy
                    p = self.link[p]
                self.link[q] = self.link[now] = copy
        self.last = now

    def add(self, words: list) -> None:
        for word in words:
            self._extend(word)
        self._extend(self.added)  # a number, never a word
        self.added += 1

    def matching_statistics(self, words: list) -> list[int]:
        """At each word, how long the longest suffix of the words up to it is that the automaton contains."""
        at, size, out = 0, 0, []
        for word in words:
            while at and word not in self.next[at]:
                at = self.link[at]
                size = self.length[at]
            if word in self.next[at]:
                at = self.next[at][word]
                size += 1
            out.append(size)
        return out


def _anchors(words: A.Words, hashes: np.ndarray, window: int, gram: int):
    """Windows of a chunk: the word each starts at, and the word its anchor starts at; and all gram hashes."""
    grams = A.gram_hash(hashes, gram)
    _, at = A.sliding_min(grams, window - gram + 1)
    start = np.flatnonzero(words.room(window))
    return start, at[start] if len(at) else np.zeros(0, np.int64), grams


def _repeated_anchors(docs: DataFrame, window: int, gram: int, buckets: int) -> DataFrame:
    """Per document the hashes of its anchors that occur more than once, and of those that do so very often."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            h, ids = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(h, kind="stable")
            h, ids = h[order], ids[order]
            start, length = A.runs(h)
            many = length > OFTEN
            seen = np.repeat(many, length)
            out = []
            if seen.any():  # known here already; a bucket gets one entry, from which it learns the same
                out.append((int(h[0] >> A.U64(33)) % buckets, h[seen].tobytes(), A.pack_ids(ids[seen]), b"", True))
            lone = np.flatnonzero(~seen)
            pick = np.sort(np.concatenate((lone, start[many])))
            count = np.where(seen[pick], SHARD + 1, 1).astype(np.uint32)
            bucket = A.bucket_of(h[pick], buckets)
            for s, n in zip(*A.runs(bucket)):
                part = pick[s : s + n]
                out.append((int(bucket[s]), h[part].tobytes(), A.pack_ids(ids[part]), count[s : s + n].tobytes(), False))
            held.clear()
            names = ["bucket", "h", "ids", "count", "known"]
            types = [pa.int32()] + [pa.binary()] * 3 + [pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

        total = 0
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                words = A.find_words(data, bounds)
                start, at, grams = _anchors(words, words.hashes(), window, gram)
                if not len(at):
                    continue
                at, first = np.unique(at, return_index=True)
                ids = part.column(0).to_numpy()
                held.append((grams[at], ids[words.rows()[start[first]]]))
                total += len(at)
                if total >= FLUSH:
                    yield flush()
                    total = 0
        if held:
            yield flush()

    schema = pa.schema([("id", pa.int64()), ("h", pa.int64()), ("often", pa.bool_())])

    def count(table: pa.Table) -> pa.Table:
        entries, out = [], []
        for r in table.to_pylist():
            h, ids = np.frombuffer(r["h"], A.U64), A.unpack_ids(r["ids"])
            if r["known"]:
                out.append((ids, h, np.ones(len(h), bool)))
            else:
                entries.append((h, ids, np.frombuffer(r["count"], np.uint32).astype(np.int64)))
        if entries:
            h, ids, n = (np.concatenate(x) for x in zip(*entries))
            order = np.argsort(h, kind="stable")
            h, ids, n = h[order], ids[order], n[order]
            start, length = A.runs(h)
            total = np.repeat(np.add.reduceat(n, start), length)
            again = total > 1
            out.append((ids[again], h[again], total[again] > SHARD))
        columns = [np.concatenate(x) for x in zip(*out)]
        return pa.table([pa.array(columns[0]), pa.array(columns[1].view(np.int64)), pa.array(columns[2])], schema=schema)

    found = docs.mapInArrow(scan, "bucket int, h binary, ids binary, count binary, known boolean")
    each = found.groupBy("bucket").applyInArrow(count, "id long, h long, often boolean")
    return each.groupBy("id").agg(F.collect_set("h").alias("anchors"), F.collect_set(F.when(F.col("often"), F.col("h"))).alias("often"))


def _candidates(words: A.Words, window: int, gram: int, anchors: list, often: list):
    """Per text its windows whose anchor is repeated: (window start, anchor start, anchor hash, is often), in order."""
    start, at, grams = _anchors(words, words.hashes(), window, gram)
    row = words.rows()[start]
    of = grams[at].view(np.int64)
    cut = np.searchsorted(row, np.arange(len(words.first)))
    for t in range(len(words.first) - 1):
        part = slice(cut[t], cut[t + 1])
        if not anchors[t] or cut[t] == cut[t + 1]:
            yield t, np.zeros((0,), np.int64), np.zeros((0,), np.int64), np.zeros((0,), np.int64), np.zeros((0,), bool)
            continue
        known = np.isin(of[part], np.array(anchors[t], np.int64))
        hot = np.isin(of[part][known], np.array(often[t] or [], np.int64))
        yield t, start[part][known], at[part][known], of[part][known], hot


def _passages(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Rows ``shard, id, at, lead, text``: the passage around an anchor at word ``at``, ``lead`` words of it before."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "id", "at", "lead", "text"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        seen: dict = {}
        size = 0

        def flush() -> pa.RecordBatch:
            rows = [(shard, *where, lead, text) for (shard, lead, text), where in seen.items()]
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for part in unpacked(batch):
                data, bounds = A.texts_of(part.column(part.num_columns - 1))
                words = A.find_words(data, bounds)
                hashes = words.hashes()
                windows = A.gram_hash(hashes, window).view(np.int64)
                joined, stop = words.spaced()
                heads = np.concatenate(([0], stop + 1)).tolist()
                ids, anchors, often = (part.column(i).to_pylist() for i in (0, 3, 4))
                for t, start, at, of, hot in _candidates(words, window, gram, anchors, often):
                    if not len(start):
                        continue
                    base = int(words.first[t])
                    cuts = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | hot[1:])))
                    for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(start)]):
                        # a hot anchor's windows are one passage each; others share one
                        first, last = int(start[i]), int(start[j - 1])
                        shard = int(of[i]) ^ int(windows[first]) if hot[i] else int(of[i])
                        text = joined[heads[first] : heads[last + window] - 1].tobytes()
                        key, where = (shard, int(at[i]) - first, text), (ids[t], int(at[i]) - base)
                        if key not in seen or where < seen[key]:
                            if key not in seen:
                                size += len(text) + 200
                            seen[key] = where
                    if size > 32 << 20:
                        yield flush()
                        size = 0
        if seen:
            yield flush()

    return docs.mapInArrow(cut, "shard long, id long, at long, lead int, text binary")


def _first_marks(passages: DataFrame, window: int) -> DataFrame:
    """Rows ``id, at, first, new``: of each passage that is the first with its words, which of its windows are new.

    ``first`` is the word that the passage's first window starts at, ``new`` has bit i for the i-th window.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, automaton, known = None, SuffixAutomaton(), set()
        for batch in batches:
            out = []
            for s, i, at, lead, text in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if s != shard:
                    shard, automaton, known = s, SuffixAutomaton(), set()
                if (lead, text) in known:
                    continue
                known.add((lead, text))
                words = text.split(b" ")
                new = 0
                for k, size in enumerate(automaton.matching_statistics(words)[window - 1 :]):
                    if size < window:
                        new |= 1 << k
                if new:
                    automaton.add(words)
                    out.append((i, at, at - lead, new))
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["id", "at", "first", "new"])

    dealt = passages.repartition("shard").sortWithinPartitions("shard", "id", "at")
    return dealt.mapInArrow(stream, "id long, at long, first long, new long")


def substring_dedup(docs: DataFrame, window: int = 20, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_removed``, ``spans`` (word bounds removed), ``kept`` text.

    Kept words are joined by one space. ``window`` must be at most 63 words longer than ``gram``.
    """
    texts = docs.select(id_or_last().alias("id"), "text")
    anchors = _repeated_anchors(texts, window, gram, bucket_count(docs))
    packed = packed_texts(texts, ["id"])
    marks = _first_marks(_passages(packed.join(anchors, "id"), window, gram), window)
    marks = marks.groupBy("id").agg(F.collect_list(F.struct("at", "first", "new")).alias("marks"))
    joined = packed.join(anchors, "id", "left").join(marks, "id", "left")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in unpacked(batch):
                data, bounds = A.texts_of(part.column(part.num_columns - 1))
                words = A.find_words(data, bounds)
                ids, anchors_of, often, marks_of = (part.column(i).to_pylist() for i in (0, 3, 4, 5))
                gone = np.zeros(len(words.start) + 1, np.int64)
                for t, start, at, _, _ in _candidates(words, window, gram, anchors_of, often):
                    if not len(start):
                        continue
                    base, new = int(words.first[t]), []
                    for m in marks_of[t] or []:
                        bits, k = m["new"], m["first"]
                        while bits:
                            if bits & 1:
                                new.append((k << 32) + m["at"])
                            bits >>= 1
                            k += 1
                    old = start[~np.isin((start - base << 32) + (at - base), np.array(new, np.int64))]
                    gone[old] += 1
                    gone[old + window] -= 1
                covered = np.cumsum(gone[:-1]) > 0
                joined, stop = words.spaced(~covered)
                left = np.concatenate(([0], np.cumsum(~covered)))[words.first]
                heads = np.concatenate(([0], stop + 1))[left]
                kept = [joined[a : max(a, e - 1)].tobytes() for a, e in zip(heads[:-1], heads[1:])]
                removed, spans = words.counts - np.diff(left), [[] for _ in kept]
                for t in np.flatnonzero(removed).tolist():
                    part_of = covered[words.first[t] : words.first[t + 1]]
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], part_of, [False])).astype(np.int8)))
                    spans[t] = [{"start": int(x), "end": int(y)} for x, y in zip(edges[::2], edges[1::2])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(words.counts), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    ["id", "n_words", "n_removed", "spans", "kept"],
                )

    result = joined.mapInArrow(judge, "id long, n_words long, n_removed long, spans array<struct<start: bigint, end: bigint>>, kept binary")
    return result.select(id_or_null("id").alias("doc_id"), "n_words", "n_removed", "spans", F.col("kept").cast("string").alias("kept"))

