"""Similarity join of documents' word n-gram sets: size-aware, light sets by subsets, heavy sets by lists.

The set of a document is its distinct windows of ``gram`` words (A-Z lower-cased, words
``[^\\x20\\x09-\\x0D]+``); with fewer words the whole sequence is the only element; without
words the set is empty. Two sets are linked if 100 * intersection >= ``percent`` * union.

1. Elements are counted over the whole corpus in hash buckets. A set that has a partner
   shares at least ``percent`` of its elements with it, so documents with fewer elements
   that occur elsewhere drop out. Elements that a task has seen twice are known to repeat
   there and reach the bucket once, so a frequent element costs one entry a task.
2. Equal sets form a class with one representative.
3. Elements of the representatives get their document frequency; rare ones come first in
   the common order, and those seen once are only counted.
4. Light sets (size up to the boundary) enumerate all subsets of two elements of a prefix that
   is long enough for two linked sets to share two elements of it. Heavy sets scan the inverted
   lists of a prefix that is long enough for one. The boundary is the size at which the
   rows of both come to the least cost.
5. Candidates are verified with whole sets, against a central member of each group first
   (``components.cluster``); components come out exactly, up to equal 64-bit element hashes.

Null texts and texts without words have n_shingles 0 and are their own component. Repeated rows
are kept, each with the same result. Rows with an id in common and different texts are
documents of their own. A null id is never a component's id unless it has no other.
Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.llm.components import cluster
from litmine.llm.tables import bucket_count, id_or_last, id_or_null
from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

FLUSH = 1 << 20
HOT_IN_FLUSH, HOT = 64, 65535
LIST_COST = 4
PARTS = "part int, " + ", ".join(f"{c} binary" for c in "abcdefg")
EXCHANGE = "bucket int, kind int, keys binary, a binary, b binary, c binary, d binary, e binary"


def _rows(values: list[tuple]) -> pa.RecordBatch:
    names = ["bucket", "kind", "keys", "a", "b", "c", "d", "e"]
    types = [pa.int32(), pa.int32()] + [pa.binary()] * 6
    columns = list(zip(*values)) if values else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _dealt(columns: list[np.ndarray], parts: int, lists: list[np.ndarray] = ()) -> pa.Table:
    """Rows of keyed numbers as one row per part of the keys; ``lists`` hold ``columns[2]`` elements for each row."""
    part = A.bucket_of(A.mix(columns[0].view(A.U64)), parts)
    order = np.argsort(part, kind="stable")
    ends = np.concatenate(([0], np.cumsum(columns[2]))) if lists else None
    rows = []
    for s, n in zip(*A.runs(part[order])):
        of = order[s : s + n]
        held = [c[of].tobytes() for c in columns]
        if lists:
            of = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in of])
            held += [x[of].tobytes() for x in lists]
        rows.append((int(part[order[s]]), *held, *[b""] * (7 - len(held))))
    names = ["part", *"abcdefg"]
    values = list(zip(*rows)) if rows else [()] * 8
    return pa.table([pa.array(v, pa.int32() if i == 0 else pa.binary()) for i, v in enumerate(values)], names=names)


def _joined(table: pa.Table, kinds: list) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(table.column(x).to_pylist()), k) for x, k in zip("abcdefg", kinds)]


def shingle_sets(data: np.ndarray, bounds: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct element hashes of each text of a chunk, one after another, and how many each has."""
    words = A.find_words(A.lower(data), bounds)
    hashes = words.hashes()
    grams, sets = A.gram_hash(hashes, gram), []
    for t in range(len(bounds) - 1):
        a, e = words.first[t], words.first[t + 1]
        if e - a >= gram:
            sets.append(np.unique(grams[a : e - gram + 1]))
        elif e > a:
            sets.append(A.mix(A.span_hash(hashes[a:e], np.array([0]), np.array([e - a]), A.WORD_BASE) + A.U64(e - a)))
        else:
            sets.append(np.zeros(0, A.U64))
    return (np.concatenate(sets) if sets else np.zeros(0, A.U64)), np.array([len(s) for s in sets], np.int64)


def _flushes(batches, gram: int, columns: tuple[str, ...]):
    """Arrays of the elements, sizes and named long columns of some whole texts at a time."""
    held: list[tuple] = []
    total = 0
    for batch in batches:
        for part, data, bounds in A.chunks(batch):
            elements, sizes = shingle_sets(data, bounds, gram)
            named = [part.column(part.schema.get_field_index(c)).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns]
            held.append((elements, sizes, *named))
            total += len(elements) + len(sizes)
            if total >= FLUSH:
                yield [np.concatenate(x) for x in zip(*held)]
                held, total = [], 0
    if held:
        yield [np.concatenate(x) for x in zip(*held)]


def _summaries(docs: DataFrame, gram: int, buckets: int) -> DataFrame:
    """Per row: ``key, doc, n, set_a, set_b`` and how many of its elements occur in other rows too."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for elements, sizes, keys, ids in _flushes(batches, gram, ("key", "doc")):
            row = np.repeat(np.arange(len(sizes)), sizes)
            full = np.flatnonzero(sizes > 0)
            at = (np.cumsum(sizes) - sizes)[full]
            set_a, set_b = np.zeros(len(sizes), A.U64), np.zeros(len(sizes), A.U64)
            if len(full):
                set_a[full], set_b[full] = np.add.reduceat(elements, at), np.add.reduceat(A.mix(elements + A.U64(1)), at)
            order = np.argsort(elements)
            elements, row = elements[order], row[order]
            start, length = A.runs(elements)
            known = np.bincount(row[np.repeat(length > 1, length)], minlength=len(sizes))
            holder = np.where(length == 1, row[start], len(sizes)).astype(np.uint32) if len(start) else np.zeros(0, np.uint32)
            once = elements[start]
            bucket = A.bucket_of(once, buckets)
            out = [(int(abs(int(keys[0])) % buckets), 1, keys.tobytes(), sizes.tobytes(), known.astype(np.int64).tobytes(),
                    set_a.tobytes(), set_b.tobytes(), ids.tobytes())]
            low = (once & A.U64(0xFFFFFFFF)).astype(np.uint32)
            for s, n in zip(*A.runs(bucket)):
                out.append((int(bucket[s]), 0, keys.tobytes(), low[s : s + n].tobytes(), holder[s : s + n].tobytes(), b"", b"", b""))
            yield _rows(out)

    def count(table: pa.Table) -> pa.Table:
        lows, holders, parts = [], [], []
        for r in table.to_pylist():
            keys = np.frombuffer(r["keys"], np.int64)
            if r["kind"]:
                n, known, set_a, set_b, ids = (np.frombuffer(r[x], np.int64) for x in "abcde")
                parts.append((keys, ids, n, known, set_a, set_b, np.ones(len(keys), np.int64)))
                continue
            lows.append(np.frombuffer(r["a"], np.uint32))
            place = np.frombuffer(r["b"], np.uint32)
            holders.append((np.append(keys, 0)[place], place < len(keys)))
        if lows:
            low = np.concatenate(lows)
            holder, named = (np.concatenate(x) for x in zip(*holders))
            order = np.argsort(low, kind="stable")
            _, length = A.runs(low[order])
            repeated = order[np.repeat(length > 1, length)]
            found, times = np.unique(holder[repeated][named[repeated]], return_counts=True)
            none = np.zeros(len(found), np.int64)
            parts.append((found, none, none, times, none, none, none))
        return _dealt([np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 7, buckets)

    result = "key long, doc long, n long, known long, set_a long, set_b long, copies long"
    schema = pa.schema([(c.split()[0], pa.int64()) for c in result.split(", ")])

    def gather(table: pa.Table) -> pa.Table:
        key, doc, n, known, set_a, set_b, copies = _joined(table, [np.int64] * 7)
        order = np.lexsort((-copies, key))  # a row's summary before its further counts
        start, length = A.runs(key[order])
        if not len(start):
            return schema.empty_table()
        head = order[start]
        sums = [np.add.reduceat(x[order], start) for x in (known, copies)]
        return pa.table([key[head], doc[head], n[head], sums[0], set_a[head], set_b[head], sums[1]], schema=schema)

    counted = docs.mapInArrow(scan, EXCHANGE).groupBy("bucket").applyInArrow(count, PARTS)
    return counted.groupBy("part").applyInArrow(gather, result)


def _ordered_sets(docs: DataFrame, gram: int, percent: int, buckets: int) -> DataFrame:
    """Per representative that can have a partner: ``key, n, hashes`` of the elements seen in others, rare ones first.

    ``one`` and ``two`` are how many of them form the prefix for one and for two common elements.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for elements, sizes, keys in _flushes(batches, gram, ("key",)):
            row = np.repeat(np.arange(len(sizes)), sizes).astype(np.uint32)
            order = np.argsort(elements)
            elements, row = elements[order], row[order]
            start, length = A.runs(elements)
            hot = length >= HOT_IN_FLUSH
            in_hot = np.repeat(hot, length)
            head = (keys.tobytes(), sizes.tobytes())
            out = []
            if hot.any():  # known at once; the bucket gets one entry without a holder
                out.append((int(abs(int(keys[0])) % buckets), 1, *head, elements[in_hot].tobytes(), row[in_hot].tobytes(), b"", b""))
            entries = np.concatenate((elements[~in_hot], elements[start[hot]]))
            holder = np.concatenate((row[~in_hot], np.full(int(hot.sum()), len(sizes), np.uint32)))
            order = np.argsort(entries, kind="stable")
            entries, holder = entries[order], holder[order]
            bucket = A.bucket_of(entries, buckets)
            for s, n in zip(*A.runs(bucket)):
                out.append((int(bucket[s]), 0, *head, entries[s : s + n].tobytes(), holder[s : s + n].tobytes(), b"", b""))
            yield _rows(out)

    def count(table: pa.Table) -> pa.Table:
        h, k, n, named, known = [], [], [], [], []
        for r in table.to_pylist():
            keys, sizes = np.frombuffer(r["keys"], np.int64), np.frombuffer(r["a"], np.int64)
            place = np.frombuffer(r["c"], np.uint32)
            h.append(np.frombuffer(r["b"], A.U64))
            k.append(np.append(keys, 0)[place])
            n.append(np.append(sizes, 0)[place])
            named.append(place < len(keys))
            known.append(np.full(len(place), bool(r["kind"])))
        h, k, n, named, known = (np.concatenate(x) for x in (h, k, n, named, known))
        df = np.full(len(h), HOT, np.int64)
        idx = np.flatnonzero(~known)
        idx = idx[np.argsort(h[idx], kind="stable")]
        start, length = A.runs(h[idx])
        if len(start):
            some_hot = np.add.reduceat((~named[idx]).astype(np.int64), start) > 0
            df[idx] = np.repeat(np.where(some_hot, HOT, np.minimum(length, HOT - 1)), length)
        keep = np.flatnonzero(named & (df > 1))
        keep = keep[np.argsort(k[keep], kind="stable")]
        start, length = A.runs(k[keep])
        return _dealt([k[keep][start], n[keep][start], length], buckets, [h[keep], df[keep].astype(np.uint16)])

    result = "key long, n long, hashes binary, one long, two long, unseen long"
    schema = pa.schema([(c.split()[0], pa.binary() if "binary" in c else pa.int64()) for c in result.split(", ")])

    def gather(table: pa.Table) -> pa.Table:
        key, n, length, h, df = _joined(table, [np.int64] * 3 + [A.U64, np.uint16])
        owner, place = np.unique(key, return_inverse=True)
        size = np.zeros(len(owner), np.int64)
        size[place] = n
        element = np.repeat(place, length)
        order = np.lexsort((-df.astype(np.int64), h, element))
        h, df, element = h[order], df[order], element[order]
        new = np.flatnonzero(np.concatenate(([True], (element[1:] != element[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, bool))
        h, df, element = h[new], df[new], element[new]  # the rows of a repeated document bring its elements again
        order = np.lexsort((h, df, element))
        h, cut = h[order], np.searchsorted(element[order], np.arange(len(owner) + 1))
        seen = np.diff(cut)
        spare = size - -(-percent * size // 100) - (size - seen)  # elements that may be missing, without those seen once
        keep = np.flatnonzero(spare >= 0)
        return pa.table([
            owner[keep], size[keep], pa.array([h[cut[i] : cut[i + 1]].tobytes() for i in keep], pa.binary()),
            np.minimum(seen, spare + 1)[keep], np.minimum(seen, spare + 2)[keep], (size - seen)[keep],
        ], schema=schema)

    return docs.mapInArrow(scan, EXCHANGE).groupBy("bucket").applyInArrow(count, PARTS).groupBy("part").applyInArrow(gather, result)


def boundary(sets: DataFrame, percent: int) -> int:
    """The largest light size: subsets of light sets and lists of heavy ones together cost least.

    Sizes are put in classes of an eighth of a power of two, so a bounded table comes back. Light
    sets need list rows only if a heavy set may be near enough in size.
    """
    step = F.floor(8 * F.log2(F.col("n").cast("double")))
    costs = sets.groupBy(step.alias("c")).agg(
        F.max("n").alias("n"), F.sum(F.col("two") * (F.col("two") - 1) / 2 + 1).alias("subsets"), F.sum("one").alias("lists")
    ).collect()
    costs.sort(key=lambda r: r["c"])
    best, size = math.inf, 0
    for limit in [0, *(r["n"] for r in costs)]:
        subsets = sum(r["subsets"] for r in costs if r["n"] <= limit)
        lists = sum(r["lists"] for r in costs if r["n"] > limit * percent / 100) if any(r["n"] > limit for r in costs) else 0
        if subsets + LIST_COST * lists < best:
            best, size = subsets + LIST_COST * lists, limit
    return size


def _keys(sets: DataFrame, light: int, percent: int) -> DataFrame:
    """Rows ``k, id, size, missed, score, lead``: subsets of light sets, list entries of heavy ones and of those near in size.

    If the key is the first that two sets share, each has at least ``missed`` elements that the other lacks.
    """
    schema = "k long, id long, size long, missed long, score long, lead boolean"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, missed, rows, lead = [], [], [], []
            columns = (batch.column(i).to_pylist() for i in range(6))
            for i, (_, n, raw, one, two, unseen) in enumerate(zip(*columns)):
                h = np.frombuffer(raw, A.U64)
                if n <= light:
                    if two >= 2:
                        x, y = np.triu_indices(two, 1)
                        pair = np.sort(np.stack((h[x], h[y])), axis=0)
                        keys, before = A.mix(pair[0] * A.U64(A.BYTE_BASE) + A.mix(pair[1])), y - 1
                    else:  # a set of one element
                        keys, before = A.mix(h[:two] + A.U64(2)), np.zeros(two, np.int64)
                    k.append(keys)
                    missed.append(before + unseen)
                    rows.append(np.full(len(keys), i))
                    lead.append(np.ones(len(keys), bool))
                if n > light * percent / 100:
                    k.append(h[:one])
                    missed.append(np.arange(one) + unseen)
                    rows.append(np.full(one, i))
                    lead.append(np.full(one, n > light))
            if k:
                rows = np.concatenate(rows)
                key, size, unseen = (pa.array(batch.column(i).to_numpy()[rows]) for i in (0, 1, 5))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(k).view(np.int64)), key, size, pa.array(np.concatenate(missed)), unseen, pa.array(np.concatenate(lead))],
                    ["k", "id", "size", "missed", "score", "lead"],
                )

    return sets.select("key", "n", "hashes", "one", "two", "unseen").mapInArrow(emit, schema)


def _verifier(sets: DataFrame, percent: int):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, n, m = (batch.column(i) for i in range(2, 6))
            keep = []
            for p, q, s, t in zip(x.to_pylist(), y.to_pylist(), n.to_pylist(), m.to_pylist()):
                both = np.concatenate((np.frombuffer(p, A.U64), np.frombuffer(q, A.U64)))
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (s + t - common))
            kept = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            if kept.num_rows:
                yield kept

    def verify(pairs: DataFrame) -> DataFrame:
        at = {s: sets.select(F.col("key").alias(s), F.col("hashes").alias(f"h{s}"), F.col("n").alias(f"n{s}")) for s in "ab"}
        return pairs.join(at["b"], "b").join(at["a"], "a").select("a", "b", "ha", "hb", "na", "nb").mapInArrow(linked, "a long, b long")

    return verify


def _labelled(docs: DataFrame, gram: int, percent: int) -> DataFrame:
    """Per distinct row ``key, doc, n, copies``, and ``component`` and ``keeper``: the id and key of its component's first row."""
    rows = docs.select("text", id_or_last().alias("doc"), row_key().alias("key"))
    buckets = bucket_count(docs)
    summary = written(_summaries(rows, gram, buckets), "sets")
    whole = written(
        summary.where("n > 0").groupBy("set_a", "set_b", "n")
        .agg(F.min(F.struct("doc", "key")).alias("first"), F.max("known").alias("known")).withColumn("key", F.col("first.key")), "classes",
    )
    chosen = whole.where(F.col("known") * 100 >= F.col("n") * percent).select("key")
    sets = written(_ordered_sets(rows.join(broadcast_if_small(chosen), "key"), gram, percent, buckets), "ordered")
    light = boundary(sets, percent)

    def near(n, missed, m, lacking):  # can the sets still have enough in common?
        return F.least(n - missed, m - lacking) * (100 + percent) >= (n + m) * percent

    labels = cluster(_keys(sets, light, percent), _verifier(sets, percent), near)
    grouped = whole.join(labels.withColumnRenamed("id", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))
    first = grouped.groupBy("label").agg(F.min("first").alias("of"))
    named = written(
        grouped.join(first, "label").select("set_a", "set_b", "n", F.col("of.doc").alias("component"), F.col("of.key").alias("keeper")), "classes"
    )
    joined = summary.join(named, ["set_a", "set_b", "n"], "left")
    return joined.withColumns({"component": F.coalesce("component", "doc"), "keeper": F.coalesce("keeper", "key")})


def row_key():
    return F.xxhash64(id_or_last(), "text")


def jaccard_components(docs: DataFrame, gram: int = 4, percent: int = 85) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``; see the module for the rules."""
    found = _labelled(docs, gram, percent).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return found.select(id_or_null("doc").alias("doc_id"), F.col("n").alias("n_shingles"), id_or_null("component").alias("component_id"))


def one_of_each(docs: DataFrame, gram: int = 4, percent: int = 85) -> DataFrame:
    """The first row of ``docs`` (smallest id) of every component, with all columns; equal rows stay once."""
    found = written(_labelled(docs, gram, percent).select("key", "keeper", "copies"), "labels")
    keyed = docs.withColumn("_key", row_key())
    gone = broadcast_if_small(found.where("key != keeper").select(F.col("key").alias("_key")), 16 << 20)
    kept = keyed.join(gone, "_key", "left_anti")
    repeated = written(found.where("key = keeper AND copies > 1").select(F.col("key").alias("_key")), "repeated")
    if not repeated.isEmpty():
        again = broadcast_if_small(repeated, 16 << 20)
        kept = kept.join(again, "_key", "left_anti").unionByName(kept.join(again, "_key", "left_semi").dropDuplicates(["_key"]))
    return kept.drop("_key")
