"""Trie of conversation prefixes, with subtree totals by time-forward processing.

A conversation ``c`` is rebuilt from the first ``h`` turns of conversation ``c - c % 100`` and its own turns after its
first ``h`` (``h`` = crc32 of its decimal id modulo 6). Each distinct sequence of first ``d`` rebuilt turns is a node of
depth ``d``.

1. Turns are hashed at once, so texts don't move. Turns are numbered per conversation by ranges (``ordered.numbered``), so a conversation
   of any length is split.
2. The name of a prefix is the exclusive-or of 128-bit hashes of its (position, turn) pairs. It is summed in blocks of ``LEVELS``
   positions, then over blocks. A node's parent has its name without its own last term.
3. Nodes fall into classes by the power of ``WEIGHT`` that their number of conversations reaches. Weights only fall from parent to child,
   so the nodes of a class form subtrees. Cut at every ``LEVELS`` levels, these are the shards: at most ``WEIGHT`` nodes a level
   and ``LEVELS`` levels each. A node has as many children as it may; those of lighter classes lie in shards of their own.
4. Within the shards of a task the nodes come in reverse level order, sorted externally by Spark. Each takes what its children have sent from
   a priority queue that is ordered like the nodes and spills sorted runs, and sends its total to its parent.
5. Across shard roots: the lightest class first; the totals of its shards' roots are summed by parent, which is a node of a heavier
   class, and wait there for that class's turn. Shards that hang on one of the same class (long conversations) are summed by
   doubling jumps before their nodes are processed.
6. The members that end in a node are hashed in ascending order from a range partitioning: ids of a node that lies in several partitions or is
   large follow in blocks of 1 MB, and are streamed through the digest.

Turns are ordered by turn, null first, then role, then a hash of the text; repeated turns count as often as they are there. Null role or text is empty.
Rows without a conv_id belong to no conversation. Without conversations there is no node and no row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from litmine.llm.ordered import numbered
from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

WEIGHT, LEVELS = 4096, 1024
QUEUE_ROWS = 1 << 18
BLOCK_BYTES = 1 << 20
SMALL = 16 << 20
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


class SpillingQueue:
    """Messages ``(key..., values...)`` by key; beyond ``limit`` of them those held are sorted and spilled.

    A spilled run is an unnamed file of this task alone and goes with it; a task that is run again makes its own.
    """

    def __init__(self, key: int, limit: int = QUEUE_ROWS):
        self.key, self.limit = key, limit
        self.heap: list[tuple] = []
        self.heads: list[tuple] = []  # the next message of each run, the run's number, its rest
        self.runs = 0

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.limit:
            self.spill()

    def spill(self) -> None:
        run = tempfile.TemporaryFile()
        run.write(np.array(sorted(self.heap), np.int64).tobytes())
        run.seek(0)
        width, self.heap = len(self.heap[0]), []
        self.runs += 1
        self.advance(self.read(run, width), self.runs)

    @staticmethod
    def read(run, width: int, rows: int = 1 << 12) -> Iterator[tuple]:
        with run:
            while part := run.read(8 * width * rows):
                yield from map(tuple, np.frombuffer(part, np.int64).reshape(-1, width).tolist())

    def advance(self, rest: Iterator[tuple], number: int) -> None:
        following = next(rest, None)
        if following is not None:
            heapq.heappush(self.heads, (following, number, rest))

    def take(self, key: tuple) -> Iterator[tuple]:
        """The values of all messages for ``key``, if it comes next."""
        while self.heap and self.heap[0][: self.key] == key:
            yield heapq.heappop(self.heap)[self.key :]
        while self.heads and self.heads[0][0][: self.key] == key:
            message, number, rest = heapq.heappop(self.heads)
            self.advance(rest, number)
            yield message[self.key :]


def rebuilt(conversations: DataFrame, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``convs (conv_id, size)`` and, per rebuilt turn, ``conv_id, depth, size, h1, h2, p1, p2, chars``: names of the prefix and of its parent."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.length(text).cast("long").alias("chars"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
    )
    skipped = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("skip")
    base = (F.col("conv_id") - F.col("conv_id") % 100).alias("base")
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("t1"), F.col("t2")]
    turns = written(numbered(written(said, "turns"), ["conv_id"], order).select("conv_id", base, skipped, "place", "total", "chars", "t1", "t2"), "turns")
    starts = turns.where("conv_id % 100 = 0 AND place < 5").select(F.col("conv_id").alias("base"), "place", F.col("total").alias("base_total"), "chars", "t1", "t2")
    bases = starts.where("place = 0").select("base", "base_total")
    have = F.least("skip", F.coalesce("base_total", F.lit(0))).cast("long")
    size = (F.greatest(F.col("total") - F.col("skip"), F.lit(0)) + have).cast("long").alias("size")
    firsts = turns.where("place = 0").select("conv_id", "base", "skip", "total").join(broadcast_if_small(bases, SMALL), "base", "left")
    convs = written(firsts.select("conv_id", size), "conversations")
    taken = firsts.drop("base_total").join(starts, "base").where("place < skip").select("conv_id", (F.col("place") + 1).alias("depth"), size, "chars", "t1", "t2")
    own = turns.where("place >= skip").join(broadcast_if_small(bases, SMALL), "base", "left")
    own = own.select("conv_id", (F.col("place") - F.col("skip") + have + 1).alias("depth"), size, "chars", "t1", "t2")
    terms = taken.unionByName(own).select(
        "conv_id", "depth", "size", "chars", F.expr(f"(depth - 1) div {levels}").alias("block"),
        F.xxhash64("t1", "t2", "depth", F.lit(1)).alias("x1"), F.xxhash64("t2", "t1", "depth", F.lit(2)).alias("x2"),
    )
    far = Window.unboundedPreceding
    along = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(far, 0)
    within = written(terms.withColumns({"y1": F.bit_xor("x1").over(along), "y2": F.bit_xor("x2").over(along)}), "prefixes")
    blocks = within.where(F.col("size") > levels).groupBy("conv_id", "block").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(far, -1)
    ahead = blocks.select("conv_id", "block", F.bit_xor("x1").over(earlier).alias("o1"), F.bit_xor("x2").over(earlier).alias("o2")).where("o1 IS NOT NULL")
    joined = within.join(broadcast_if_small(written(ahead, "blocks"), SMALL), ["conv_id", "block"], "left")
    named = joined.withColumns({f"h{i}": F.col(f"y{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0).cast("long"))) for i in "12"})
    parent = [F.col(f"h{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i in "12"]
    return convs, written(named.select("conv_id", "depth", "size", "h1", "h2", *parent, "chars"), "prefixes")


def _nodes(convs: DataFrame, prefixes: DataFrame, weight: int) -> DataFrame:
    """A row per node: its names, ``conv_id, depth, n, chars, n_children``, its parent's id and its weight class ``w`` and that of its parent."""
    found = prefixes.groupBy("h1", "h2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), *(F.max(c).alias(c) for c in ("depth", "p1", "p2", "chars"))
    )
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).where("n > 0")
    root = root.select("*", zero.alias("h1"), zero.alias("h2"), zero.alias("depth"), none.alias("p1"), none.alias("p2"), zero.alias("chars"))
    nodes = written(found.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, ["h1", "h2"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")
    over = nodes.where("n_children > 0").select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n").alias("above"))
    powers = [weight**i for i in range(1, 64) if weight**i < 1 << 63]

    def heft(c: str):
        return sum((F.col(c) >= p).cast("int") for p in powers)

    return nodes.join(over, ["p1", "p2"], "left").withColumns({"w": heft("n"), "above": heft("above")})


def _sharded(nodes: DataFrame, prefixes: DataFrame, levels: int) -> DataFrame:
    """``nodes`` with ``s1, s2``, the name of their shard's root, and whether they are it (``top``)."""
    top = (F.col("depth") == 0) | (F.col("w") != F.col("above")) | ((F.col("depth") - 1) % levels == 0)
    marked = written(nodes.withColumn("top", top), "marked")
    path = prefixes.select("conv_id", "h1", "h2").withColumnRenamed("conv_id", "of").join(marked.where("depth > 0"), ["h1", "h2"])
    along = Window.partitionBy("of", F.expr(f"(depth - 1) div {levels}")).orderBy("depth")  # the first of a block is a shard's root
    last = {f"s{i}": F.last(F.when(F.col("top"), F.col(f"h{i}")), ignorenulls=True).over(along) for i in "12"}
    owned = path.withColumns(last).where("of = conv_id").drop("of")
    root = marked.where("depth = 0").withColumns({"s1": F.col("h1"), "s2": F.col("h2")})
    return written(owned.unionByName(root), "sharded")


def _summed(messages: DataFrame) -> DataFrame:
    return messages.groupBy("h1", "h2").agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))


def _received(rows: DataFrame, messages: DataFrame) -> DataFrame:
    """``rows`` with what was sent to them added to their own."""
    joined = rows.join(_summed(messages), ["h1", "h2"], "left")
    more = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0).cast("long")) for c in ("leaves", "saved")}
    return joined.withColumns(more).drop("more_leaves", "more_saved")


def _from_chained_shards(rows: DataFrame) -> DataFrame | None:
    """What the roots of shards that hang on a shard of the same class will send: ``h1, h2, leaves, saved`` by receiver."""
    links = rows.where("top AND w = above").select("s1", "s2", "p1", "p2")
    if links.isEmpty():
        return None
    at = rows.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("s1").alias("a1"), F.col("s2").alias("a2"))
    jumps = written(links.join(at, ["p1", "p2"]).select("s1", "s2", "a1", "a2"), "jumps")
    sums = written(rows.groupBy("s1", "s2").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "shard_sums")
    while not jumps.isEmpty():  # sums hold all shards nearer than 2 ** i below, jumps go up 2 ** i shards
        sent = sums.join(jumps, ["s1", "s2"]).select(F.col("a1").alias("h1"), F.col("a2").alias("h2"), "leaves", "saved")
        named = sums.withColumnsRenamed({"s1": "h1", "s2": "h2"})
        sums = written(_received(named, sent).withColumnsRenamed({"h1": "s1", "h2": "s2"}), "shard_sums")
        further = jumps.select(F.col("s1").alias("a1"), F.col("s2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        jumps = written(jumps.join(further, ["a1", "a2"]).select("s1", "s2", F.col("b1").alias("a1"), F.col("b2").alias("a2")), "jumps")
    return links.join(sums, ["s1", "s2"]).select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), "leaves", "saved")


CARRIED = ("h1", "h2", "p1", "p2", "conv_id", "depth", "parent_conv_id", "n", "n_children", "w", "above")


def _forwarded(rows: DataFrame, queue_rows: int) -> DataFrame:
    """``rows`` with their subtrees' totals: each shard in reverse level order, totals sent to the parent's place in that order."""
    names = [*CARRIED, "top", "leaves", "saved"]
    rows = rows.select(*names, "s1", "s2")

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(3, queue_rows)
        for batch in batches:
            h1, h2, p1, p2, depth, top, leaves, saved = (batch.column(names.index(c)).to_pylist() for c in ("h1", "h2", "p1", "p2", "depth", "top", "leaves", "saved"))
            for k in range(len(h1)):
                for more_leaves, more_saved in queue.take((-depth[k], h1[k], h2[k])):
                    leaves[k] += more_leaves
                    saved[k] += more_saved
                if not top[k]:
                    queue.push((1 - depth[k], p1[k], p2[k], leaves[k], saved[k]))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(names) - 2)), pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names)

    ordered = rows.repartition("s1", "s2").sortWithinPartitions(F.desc("depth"), "h1", "h2").drop("s1", "s2")
    return ordered.mapInArrow(forward, ordered.schema)


def _totals(sharded: DataFrame, queue_rows: int) -> DataFrame:
    """Class by class, from light to heavy."""
    start = sharded.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n") - 1) * F.col("chars")})
    done, messages = None, None
    for (w,) in sorted(map(tuple, sharded.select("w").distinct().collect())):  # a few powers of the weight
        rows = start.where(F.col("w") == w)
        rows = rows if messages is None else _received(rows, messages)
        rows = written(rows, "class")
        chained = _from_chained_shards(rows)
        rows = written(_forwarded(rows if chained is None else _received(rows, chained), queue_rows), "totals")
        sent = rows.where("top AND w != above").select(F.col("p1").alias("h1"), F.col("p2").alias("h2"), "leaves", "saved")
        messages = sent if messages is None else messages.unionByName(sent)
        done = rows if done is None else done.unionByName(rows)
    return done


def _digests(ends: DataFrame) -> DataFrame:
    """``ends (h1, h2, conv_id)`` to ``h1, h2, ends_sha256`` of the ids of each node in ascending order."""
    schema = "h1 long, h2 long, part int, piece long, ids binary, ends_sha256 string"

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, out = TaskContext.get().partitionId(), 0, []
        now, held, size, whole = None, [], 0, False  # the first node of a partition may have begun before it

        def piece(digest: bool):
            nonlocal number, held, size
            number += 1
            ids = ",".join(held).encode()
            out.append((*now, part, number, None if digest else ids, hashlib.sha256(ids).hexdigest() if digest else None))
            held, size = [], 0

        def batch_of():
            columns = list(zip(*out)) if out else [()] * 6
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.string()))],
                                              ["h1", "h2", "part", "piece", "ids", "ends_sha256"])

        first = True
        for batch in batches:
            for h1, h2, conv in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (h1, h2) != now:
                    if now is not None:
                        piece(whole and not first)
                        first = False
                    now, whole = (h1, h2), True
                text = str(conv)
                held.append(text)
                size += len(text) + 1
                if size >= BLOCK_BYTES:
                    piece(False)
                    whole = False
            yield batch_of()
        if now is not None:
            piece(False)
            yield batch_of()

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, empty = None, hashlib.sha256(), True
        for batch in batches:
            rows = []
            for h1, h2, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (h1, h2) != now:
                    if now is not None:
                        rows.append((*now, state.hexdigest()))
                    now, state, empty = (h1, h2), hashlib.sha256(), True
                if ids:
                    state.update(ids if empty else b"," + ids)
                    empty = False
            yield result(rows)
        if now is not None:
            yield result([(*now, state.hexdigest())])

    def result(rows):
        columns = list(zip(*rows)) if rows else [()] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["h1", "h2", "ends_sha256"])

    keys = ["h1", "h2", "conv_id"]
    cut = written(ends.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(pieces, schema), "pieces")
    open_ = cut.where("ids IS NOT NULL").repartition("h1", "h2").sortWithinPartitions("h1", "h2", "part", "piece").select("h1", "h2", "ids")
    return cut.where("ids IS NULL").select("h1", "h2", "ends_sha256").unionByName(open_.mapInArrow(stream, "h1 long, h2 long, ends_sha256 string"))


def conversation_trie(conversations: DataFrame, weight: int = WEIGHT, levels: int = LEVELS, queue_rows: int = QUEUE_ROWS) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``; see the module for the rules."""
    convs, prefixes = rebuilt(conversations, levels)
    totals = _totals(_sharded(_nodes(convs, prefixes, weight), prefixes, levels), queue_rows)
    if totals is None:  # no conversation at all
        totals = _nodes(convs, prefixes, weight).withColumns({"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")})
    zero = F.lit(0).cast("long")
    ends = prefixes.where("depth = size").select("h1", "h2", "conv_id").unionByName(convs.where("size = 0").select(zero.alias("h1"), zero.alias("h2"), "conv_id"))
    return totals.join(_digests(written(ends, "ends")), ["h1", "h2"], "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"),
    )
