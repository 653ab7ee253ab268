"""Near-duplicates by min-max hashing: both ends of every permutation are kept, banded, and confirmed on whole sets.

The set of a document is its distinct windows of ``gram`` words (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``); with
fewer words the whole sequence is the only element; without words the set is empty. Two sets are linked if
100 * intersection >= ``percent`` * union.

1. One scan hashes each element once per permutation and keeps the least and the greatest value, so half the evaluations of plain
   min-hashing give a signature of the same length. The greatest is the least under the reversed order, so each value of a
   signature agrees with probability J on its own, and the two ends of a permutation agree together no more often than two independent
   values: estimates have lower variance. A band holds ``ROWS`` values of one end, of different permutations; so it agrees with
   probability J ** ROWS exactly. The bands of both ends of the same permutations fail together no more often than independent ones:
   with 30 groups of 4 permutations a pair at J = 0.8 is missed with probability below (1 - 0.8 ** 4) ** 60 = 2e-14.
2. Equal sets are one class, known by 64 bits of its elements' sums; copies need no bands of their own.
3. Bands that another class has too are found in hash buckets whose number grows with the input. A band that repeats
   within a task is known there and reaches its bucket once, so a frequent band costs one entry a task.
4. A second scan makes the whole sets of the documents that share a band. What of a set no other of them has can't be common to two, so a set
   with too little left has no link, and many pairs are ruled out by what both have left.
5. Classes that share a band are tried against a central member first, on whole sets, and only pairs whose ends are in different components
   go on. Two sets that were compared with the same central one are known by what they lack of it and have beyond it; a sketch of
   ``SKETCH`` x 64 bits of that bounds what they can have in common, and a pair for which it is too little is ruled out unseen.
   So a large group of copies, each with changes of its own, is not paired with itself. Components come out exactly for the pairs that share a band.

Null texts and texts without words have n_shingles 0 and are their own component. Repeated rows are kept, each with the same
result. Rows with an id in common and different texts are documents of their own. A null id is never a
component's id unless it has no other. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.llm.components import connected
from litmine.llm.jaccard_join import _ordered_sets, shingle_sets
from litmine.llm.tables import bucket_count, id_or_last, id_or_null
from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

ROWS, GROUPS, SKETCH = 4, 30, 8
SLICE = 1 << 15  # elements whose values are held at a time
SMALL = 16 << 20
FLUSH = 1 << 12  # classes whose bands are compared within a task


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed odd factors and offsets, one for each permutation of the 64-bit hashes."""
    seed = A.mix(np.arange(1, 2 * n + 1, dtype=A.U64) * A.U64(A.WORD_BASE))
    return seed[:n] | A.U64(1), seed[n:]


def signatures(elements: np.ndarray, sizes: np.ndarray, rows: int = ROWS, groups: int = GROUPS) -> np.ndarray:
    """Band hashes of each non-empty set, ``2 * groups`` per set: first those of the least values, then of the greatest."""
    factor, offset = permutations(rows * groups)
    out = np.zeros((len(sizes), 2 * groups), A.U64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE, "right")))
        some = elements[ends[at] - sizes[at] : ends[to - 1]]
        start = ends[at:to] - sizes[at:to] - (ends[at] - sizes[at])
        for g in range(groups):
            least, most = np.zeros(to - at, A.U64), np.zeros(to - at, A.U64)
            for p in range(g * rows, (g + 1) * rows):
                value = some * factor[p] + offset[p]
                value ^= value >> A.U64(29)
                value *= A.U64(0xBF58476D1CE4E5B9)  # one-to-one in 64 bits, so a permutation of the hashes
                least = A.mix(least * A.U64(A.BYTE_BASE) + np.minimum.reduceat(value, start))
                most = A.mix(most * A.U64(A.BYTE_BASE) + np.maximum.reduceat(value, start))
            out[at:to, g] = A.mix(least + A.U64(2 * g))
            out[at:to, groups + g] = A.mix(most + A.U64(2 * g + 1))
        at = to
    return out


SIGNED = "key long, doc long, set long, n long, bands binary"


def _signed(rows: DataFrame, gram: int) -> DataFrame:
    """``rows (text, doc, key)`` with the 64-bit name of each set, its size and its bands (none if it is empty)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                elements, sizes = shingle_sets(data, bounds, gram)
                full = np.flatnonzero(sizes)
                names, bands = np.zeros(len(sizes), A.U64), [None] * len(sizes)
                if len(full):
                    at = (np.cumsum(sizes) - sizes)[full]
                    names[full] = A.mix(np.add.reduceat(A.mix(elements + A.U64(1)), at) + A.mix(sizes[full].astype(A.U64)))
                    for k, row in zip(full, signatures(elements, sizes[full])):
                        bands[k] = row.tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column(part.schema.get_field_index("key")), part.column(part.schema.get_field_index("doc")),
                    pa.array(names.view(np.int64)), pa.array(sizes), pa.array(bands, pa.binary()),
                ], ["key", "doc", "set", "n", "bands"])

    return rows.mapInArrow(sign, SIGNED)


ENTRIES = "bucket int, known boolean, sets binary, sizes binary, bands binary, holders binary, times binary"


def _shared_bands(signed: DataFrame, buckets: int) -> DataFrame:
    """``k, id, score`` of every class and every band of it that another class has."""
    names = ["bucket", "known", "sets", "sizes", "bands", "holders", "times"]
    types = [pa.int32(), pa.bool_()] + [pa.binary()] * 5

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for part in (batch.slice(at, FLUSH) for batch in batches for at in range(0, batch.num_rows, FLUSH)):
            held.append(part)
            count += part.num_rows
            if count >= FLUSH:
                yield from flush(held)
                held, count = [], 0
        if held:
            yield from flush(held)

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held).combine_chunks()
        sets, first = np.unique(table.column("set").to_numpy().view(A.U64), return_index=True)
        sizes = table.column("n").to_numpy()[first]
        raw = table.column("bands").combine_chunks().take(pa.array(first))
        k = np.frombuffer(b"".join(raw.to_pylist()), A.U64)
        holder = np.repeat(np.arange(len(sets), dtype=np.uint32), len(k) // len(sets))
        order = np.argsort(k, kind="stable")
        k, holder = k[order], holder[order]
        start, length = A.runs(k)
        again = np.repeat(length > 1, length)
        head = (sets.tobytes(), sizes.tobytes())
        out = []
        if again.any():  # known at once; the bucket gets one entry without a holder
            out.append((int(sets[0] % A.U64(buckets)), True, *head, k[again].tobytes(), holder[again].tobytes(), np.minimum(np.repeat(length, length)[again], 255).astype(np.uint8).tobytes()))
        k, holder = k[start], np.where(length > 1, len(sets), holder[start]).astype(np.uint32)
        bucket = A.bucket_of(k, buckets)
        for s, n in zip(*A.runs(bucket)):
            of = slice(s, s + n)
            used, place = np.unique(holder[of], return_inverse=True)  # only the classes that come here travel along
            named = used[used < len(sets)]
            out.append((int(bucket[s]), False, sets[named].tobytes(), sizes[named].tobytes(), k[of].tobytes(), place.astype(np.uint16).tobytes(), np.minimum(length[of], 255).astype(np.uint8).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    result = ["k", "id", "size", "times"]

    def shared(table: pa.Table) -> pa.Table:
        found, open_ = [], []
        for r in table.to_pylist():
            sets, sizes = np.frombuffer(r["sets"], np.int64), np.frombuffer(r["sizes"], np.int64)
            k, times = np.frombuffer(r["bands"], np.int64), np.frombuffer(r["times"], np.uint8).astype(np.int64)
            place = np.frombuffer(r["holders"], np.uint32 if r["known"] else np.uint16)
            if r["known"]:
                found.append((k, sets[place], sizes[place], times))
            else:
                open_.append((k, np.append(sets, 0)[place], np.append(sizes, 0)[place], times, place < len(sets)))
        if open_:
            k, sets, sizes, times, named = (np.concatenate(x) for x in zip(*open_))
            order = np.lexsort((sets, ~named, k))
            k, sets, sizes, times, named = (x[order] for x in (k, sets, sizes, times, named))
            new = np.concatenate(([True], (k[1:] != k[:-1]) | (sets[1:] != sets[:-1]) | ~named[1:] | ~named[:-1]))  # copies in other tasks count once
            k, sets, sizes, times, named = (x[new] for x in (k, sets, sizes, times, named))
            start, length = A.runs(k)
            total = np.repeat(np.add.reduceat(times, start), length)
            keep = named & (total > 1)
            found.append((k[keep], sets[keep], sizes[keep], total[keep]))
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(c) for c in columns], names=result)

    dealt = signed.where("n > 0").select("set", "n", "bands").mapInArrow(entries, ENTRIES).groupBy("bucket").applyInArrow(shared, ", ".join(f"{c} long" for c in result))
    once = written(dealt.groupBy("k", "id").agg(F.max("size").alias("size"), F.max("times").alias("times")), "bands")
    central = once.groupBy("id").agg((-F.sum("times")).alias("score"))  # the more others meet a class, the sooner it is tried against them
    return once.select("k", "id").join(broadcast_if_small(central, SMALL), "id")


def sketch_of(differences: np.ndarray) -> list[int]:
    """``SKETCH`` words of 64 bits, one bit set for each hash."""
    bit = (A.mix(differences + A.U64(3)) >> A.U64(32)).astype(np.int64) % (64 * SKETCH)
    held = np.zeros(64 * SKETCH, np.uint8)
    held[bit] = 1
    return np.packbits(held).view(np.int64).tolist()


COMPARED = "a long, b long, na long, nb long, common long, left_b long, " + ", ".join(f"d{i} long" for i in range(SKETCH))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs (a, b)`` with the sizes of both sets, how much they have in common, and a sketch of what only one of them has.

    Elements that no other candidate has are in no set here, so they are in no difference that two could share.
    """
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            common, left, sketches = [], [], []
            for x, y in zip(*([np.frombuffer(v.as_buffer(), A.U64) for v in batch.column(i)] for i in (4, 5))):
                both = np.sort(np.concatenate((x, y)))
                twice = np.concatenate((both[1:] == both[:-1], [False])) if len(both) else np.zeros(0, bool)
                once = ~(twice | np.concatenate(([False], twice[:-1]))) if len(both) else twice
                common.append(int(twice.sum()))
                left.append(len(y))
                sketches.append(sketch_of(both[once]))
            columns = [pa.array(c, pa.int64()) for c in (common, left, *zip(*sketches))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *columns], [c.split()[0] for c in COMPARED.split(", ")])

    at = {s: sets.select(F.col("key").alias(s), F.col("n").alias(f"n{s}"), F.col("hashes").alias(f"h{s}")) for s in "ab"}
    return pairs.join(at["b"], "b").join(at["a"], "a").select("a", "b", "na", "nb", "ha", "hb").mapInArrow(compare, COMPARED)


def _clusters(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Components ``id, label`` of the classes that have a link, among ``keys (k, id, n, left, score)``; ``left`` elements of ``n`` occur in others."""
    def enough(common, n, m):
        return common * (100 + percent) >= (n + m) * percent

    linked = enough(F.col("common"), F.col("na"), F.col("nb"))
    shared = keys.groupBy("k").agg(F.count(F.lit(1)).alias("members"), F.min(F.struct("score", "id", "n", "left")).alias("p")).where("members > 1")
    pivots = written(shared.select("k", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.left").alias("pivot_left")), "pivots")
    members = written(keys.join(pivots, "k"), "members")
    star = members.where((F.col("id") != F.col("pivot")) & enough(F.least("left", "pivot_left"), F.col("n"), F.col("pivot_n")))
    star = written(star.groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("times")), "star")
    first = star.groupBy("id").agg(F.max(F.struct("times", "pivot")).alias("p")).select(F.col("id").alias("a"), F.col("p.pivot").alias("b"))
    known = written(_compared(written(first, "tried"), sets), "compared")
    links = known.where(linked).select("a", "b")
    labels = connected(links)

    center = known.select(F.col("a").alias("id"), F.col("b").alias("center"), F.col("left_b").alias("center_left"), "common", *[f"d{i}" for i in range(SKETCH)])
    itself = known.select(F.col("b").alias("id"), F.col("b").alias("center"), F.col("left_b").alias("center_left"), F.col("left_b").alias("common"), *[F.lit(0).cast("long").alias(f"d{i}") for i in range(SKETCH)])
    seen = center.unionByName(itself.join(center.select("id"), "id", "left_anti").distinct())  # a pivot that was compared with another stays with that
    marked = members.select("k", "id", "n", "left").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    open_keys = marked.groupBy("k").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("k")
    rest = written(marked.join(open_keys, "k", "left_semi").join(seen, "id", "left"), "open")

    def side(s: str) -> DataFrame:
        return rest.select("k", *[F.col(c).alias(f"{s}_{c}") for c in rest.columns if c != "k"])

    x, y = (lambda c: F.col(f"x_{c}")), (lambda c: F.col(f"y_{c}"))
    lacking = lambda s: s("center_left") - s("common")
    beyond = lambda s: s("left") - s("common")
    # what of one's differences falls where the other has none can't be shared
    unshared = lambda s, t: sum(F.bit_count(s(f"d{i}").bitwiseAND(F.bitwise_not(t(f"d{i}")))) for i in range(SKETCH))
    alike = F.least(*[lacking(s) + beyond(s) - unshared(s, t) for s, t in ((x, y), (y, x))])
    most = F.when(x("center") == y("center"), F.least(x("center_left") - lacking(x) - lacking(y) + alike, x("left"), y("left"))).otherwise(F.least(x("left"), y("left")))
    pairs = side("x").join(side("y"), "k").where((x("id") < y("id")) & (x("label") != y("label")) & enough(most, x("n"), y("n")))
    third = written(pairs.select(x("id").alias("a"), y("id").alias("b")).distinct(), "tried")
    if third.isEmpty():
        return labels
    return connected(links.unionByName(written(_compared(third, sets), "compared").where(linked).select("a", "b")))


def minmax_components(docs: DataFrame, gram: int = 2, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept`` (the first of its component)."""
    rows = docs.select("text", id_or_last().alias("doc"), F.xxhash64(id_or_last(), "text").alias("key"))
    signed = written(_signed(rows, gram), "signed")
    keys = written(_shared_bands(signed, bucket_count(docs)), "shared")
    first = signed.where("n > 0").groupBy("set").agg(F.min(F.struct("doc", "key")).alias("first"))
    classes = written(first.select(F.col("set").alias("id"), "first.doc", "first.key"), "classes")
    chosen = classes.join(keys.select("id").distinct(), "id", "left_semi").select("key", "id")
    texts = rows.select("key", "text").join(broadcast_if_small(chosen, SMALL), "key").select(F.col("id").alias("key"), "text")
    sets = written(_ordered_sets(texts, gram, percent, bucket_count(docs)), "sets")
    left = sets.select(F.col("key").alias("id"), "n", (F.col("n") - F.col("unseen")).alias("left"))
    keys = written(keys.select("k", "id", "score").join(broadcast_if_small(left, SMALL), "id"), "candidates")
    labels = _clusters(keys, sets, percent)
    grouped = classes.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = grouped.groupBy("label").agg(F.min("doc").alias("component"))
    named = written(grouped.join(least, "label").select(F.col("id").alias("set"), "component"), "components")
    found = signed.where("n > 0").join(named, "set").select("doc", "n", "component").unionByName(signed.where("n = 0").select("doc", "n", F.col("doc").alias("component")))
    return found.select(
        id_or_null("doc").alias("doc_id"), F.col("n").alias("n_shingles"), id_or_null("component").alias("component_id"), (F.col("doc") == F.col("component")).alias("kept")
    )
