"""Merkle manifest of a dataset: incremental witnesses over distributed blocks.

A leaf is the digest of a document's fields. The leaves of a source, by ascending doc_id, form a tree whose
runs of ``ARITY`` consecutive nodes become a node, level by level (a last run may be shorter); the sources' roots, ordered
by source, form the last tree. What a document needs to prove that it belongs to the root is its witness:
per level its place in its run and the digests of the run's other nodes.

Nothing is built over a whole source in one task:

1. Leaves are numbered within their source (``ordered.numbered``) and cut into aligned blocks of ``ARITY ** levels``.
2. A block is appended leaf by leaf (``Appender``). An appended node opens a subtree with an empty witness. When a run is
   complete, each of its subtrees gets its siblings attached, which extends the witnesses of all leaves below it at once, and the
   run's digest is appended one level up. A block stores what is attached to each subtree, 1.5 digests a leaf.
3. The blocks' roots are numbered already, and are appended to blocks of blocks in the same way, until each source has
   one root; the sources' roots are further appends of a tree of their own.
4. From the top down each block's witness extends those of its members. A leaf is folded again where it ends.

Nulls: any field may be null (`-` in the digest, which no value can give). Null ids come first in a source, equal ids in the
order of their leaves, the null source first. Repeated rows are leaves of their own. Without rows there is no tree and no
row. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm.ordered import numbered
from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

ARITY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32


def H(*digests: bytes) -> bytes:
    """The digest of digests as hex text, one after another."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def field_digest(columns: list) -> F.Column:
    """Lowercase hex sha256 of the columns' values, each with its byte count; a null is `-`."""
    def framed(c):
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(framed, columns)), 256)


class Appender:
    """One aligned block: nodes are appended in order, witnesses are attached to the subtrees that are open.

    ``attached[l][i]`` is what the ``i``-th subtree of height ``l`` has learnt: a byte with its place in its run and
    the number of siblings, then their digests. It is empty until the run is complete.
    """

    def __init__(self, levels: int):
        self.open: list[list[bytes]] = [[] for _ in range(levels + 1)]
        self.attached: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def append(self, node: bytes, level: int = 0) -> None:
        self.open[level].append(node)
        self.attached[level].append(b"")
        if len(self.open[level]) == ARITY and level + 1 < len(self.open):
            self.complete(level)

    def complete(self, level: int) -> None:
        """A run ends: its subtrees get their siblings, its digest is appended one level up."""
        run, self.open[level] = self.open[level], []
        known = self.attached[level]
        for i in range(len(run)):
            others = run[:i] + run[i + 1 :]
            known[len(known) - len(run) + i] = bytes([i * ARITY + len(others)]) + b"".join(others)
        self.append(H(*run), level + 1)

    def finish(self, whole: bool) -> bytes:
        """The root. A block that is its ``whole`` tree ends at the first level with a single node, another one at full height."""
        top = len(self.open) - 1
        for level in range(top):
            if whole and len(self.attached[level]) == 1 and self.open[level]:
                self.attached = self.attached[: level + 1]
                return self.open[level][0]
            if self.open[level]:
                self.complete(level)
        return self.open[top][0]

    def packed(self) -> list[bytes]:
        """Per level all that is attached, each piece at a fixed stride."""
        stride = 1 + (ARITY - 1) * DIGEST
        return [b"".join(x.ljust(stride, b"\0") for x in level) for level in self.attached[:-1]]


def witness_of(packed: list[bytes], place: int) -> bytes:
    """The witness of the ``place``-th node appended to a block."""
    stride, out = 1 + (ARITY - 1) * DIGEST, []
    for level in packed:
        piece = level[place * stride : (place + 1) * stride]
        out.append(piece[: 1 + piece[0] % ARITY * DIGEST])
        place //= ARITY
    return b"".join(out)


def steps(witness: bytes) -> Iterator[tuple[int, list[bytes]]]:
    """Per level the node's place in its run and its siblings."""
    at = 0
    while at < len(witness):
        place, n = divmod(witness[at], ARITY)
        yield place, [witness[at + 1 + k * DIGEST : at + 1 + (k + 1) * DIGEST] for k in range(n)]
        at += 1 + n * DIGEST


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for place, siblings in steps(witness):
        leaf = H(*siblings[:place], leaf, *siblings[place:])
    return leaf


def proof_digest(witness: bytes) -> str:
    """Lowercase hex sha256 of all siblings, level by level, as hex text."""
    return hashlib.sha256(b"".join(d for _, siblings in steps(witness) for d in siblings).hex().encode()).hexdigest()


BLOCKS = "tree string, block long, whole boolean, root binary, members binary, attached array<binary>"


def _blocks(nodes: DataFrame, levels: int) -> DataFrame:
    """``nodes (tree, place, total, node, item)`` as blocks; ``members`` are the Arrow rows of their items in order."""
    size = ARITY**levels

    def append_all(table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        appender = Appender(levels)
        for node in table.column("node").to_pylist():
            appender.append(node)
        whole = table.column("total")[0].as_py() <= size
        root = appender.finish(whole)
        items = table.select(["node", "item"])
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, items.schema) as stream:
            stream.write_table(items)
        row = [table.column("tree")[0].as_py(), table.column("block")[0].as_py(), whole, root, out.getvalue().to_pybytes(), appender.packed()]
        return pa.table([[v] for v in row], schema=pa.schema([
            ("tree", pa.string()), ("block", pa.int64()), ("whole", pa.bool_()), ("root", pa.binary()), ("members", pa.binary()), ("attached", pa.list_(pa.binary()))]))

    return nodes.withColumn("block", F.expr(f"place div {size}")).groupBy("tree", "block").applyInArrow(append_all, BLOCKS)


def _extended(blocks: DataFrame, above: DataFrame, levels: int, item: str) -> DataFrame:
    """A row per member of ``blocks``: ``tree, place, node, item, witness, subroot, root``.

    ``above (tree, place, witness, subroot, root)`` is each block's witness. Its subroot and root may be null where the block is the top.
    """
    size = ARITY**levels
    packed = blocks.select("tree", "block", "members", "attached")
    joined = packed.join(broadcast_if_small(above.withColumnRenamed("place", "block"), 16 << 20), ["tree", "block"])
    schema = f"tree string, place long, node binary, item {item}, witness binary, subroot binary, root binary"

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                items = pa.ipc.open_stream(r["members"]).read_all().combine_chunks()
                n = items.num_rows
                own = [witness_of(r["attached"], i) + r["witness"] for i in range(n)]
                constant = lambda v: pa.array([v] * n, pa.binary())
                yield from pa.table([
                    pa.array([r["tree"]] * n, pa.string()), pa.array(range(r["block"] * size, r["block"] * size + n), pa.int64()), items.column(0), items.column(1),
                    pa.array(own, pa.binary()), constant(r["subroot"]), constant(r["root"]),
                ], names=["tree", "place", "node", "item", "witness", "subroot", "root"]).to_batches()

    return joined.select("tree", "block", "members", "attached", "witness", "subroot", "root").mapInArrow(extend, schema)


def _tiers(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Blocks of the nodes, blocks of their roots, and so on until every tree has one root."""
    tiers = []
    while True:
        tiers.append(written(_blocks(nodes, levels), "blocks"))
        rest = tiers[-1].where(~F.col("whole"))
        if rest.isEmpty():
            return tiers
        counts = rest.groupBy("tree").agg(F.count(F.lit(1)).alias("total"))
        nodes = rest.join(broadcast_if_small(counts), "tree").select("tree", F.col("block").alias("place"), "total", F.col("root").alias("node"), F.lit(None).cast("int").alias("item"))


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """``tree, root`` of every tree."""
    whole = [t.where("whole").select("tree", "root") for t in tiers]
    return whole[0] if len(whole) == 1 else whole[0].unionByName(_roots(tiers[1:]))


def _witnesses(tiers: list[DataFrame], tops: DataFrame, levels: int, item: str) -> DataFrame:
    """Members of the first tier with whole witnesses; ``tops (tree, witness, subroot, root)`` goes on above the trees' roots."""
    placed = tops.withColumn("place", F.lit(0).cast("long"))
    above = None
    for t in reversed(range(len(tiers))):
        own = placed.join(tiers[t].where("whole").select("tree"), "tree").select("tree", "place", "witness", "subroot", "root")
        above = own if above is None else own.unionByName(above)
        found = _extended(tiers[t], above, levels, item if t == 0 else "int")
        above = found if t == 0 else written(found.select("tree", "place", "witness", "subroot", "root"), "witnesses")
    return above


def merkle_manifest(docs: DataFrame, levels: int = 6) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, leaf, tampered, witness, subroot, root`` (digests as bytes).

    ``tampered`` is the leaf of the document without the newlines of its text where 2 divides the crc32 of its id, else null.
    ``witness`` goes from the leaf to ``root``; see ``steps``, ``folded`` and ``proof_digest``.
    """
    text, unlined = F.col("text"), F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False)) & text.contains("\n")
    fields = [F.col(f) for f in FIELDS]
    leaves = docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),  # a name for the null source that sorts first
        F.unhex(field_digest(fields)).alias("node"), F.when(even, F.unhex(field_digest([*fields[:-1], unlined]))).alias("tampered"),
    )
    item = F.struct(F.col("doc_id").cast("long").alias("doc_id"), "tampered").alias("item")
    placed = numbered(written(leaves, "leaves"), ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("node")])
    tiers = _tiers(placed.select("tree", "place", "total", "node", item), levels)
    subroots = written(_roots(tiers).withColumn("all", F.lit("")), "subroots")
    sources = numbered(subroots, ["all"], [F.col("tree")])
    over = _tiers(sources.select(F.col("all").alias("tree"), "place", "total", F.col("root").alias("node"), F.col("tree").alias("item")), levels)
    none = F.lit(None).cast("binary")
    root = _roots(over).select("tree", F.lit(b"").alias("witness"), none.alias("subroot"), "root")
    tops = _witnesses(over, root, levels, "string").select(F.col("item").alias("tree"), "witness", F.col("node").alias("subroot"), "root")
    found = _witnesses(tiers, written(tops, "tops"), levels, "struct<doc_id: long, tampered: binary>")
    source = F.when(F.col("tree") != "", F.substring("tree", 2, (1 << 31) - 1)).alias("source")
    return found.select("item.doc_id", source, F.col("node").alias("leaf"), "item.tampered", "witness", "subroot", "root")


def audited(manifest: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: each document, tampered where so marked, folded to a root."""
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, leaf, tampered, witness, subroot, root = (batch.column(i).to_pylist() for i in range(6))
            ends = [folded(t or x, w) for x, t, w in zip(leaf, tampered, witness)]
            text = [[d.hex() for d in c] for c in (leaf, subroot, root)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *(pa.array(c, pa.string()) for c in text), pa.array(map(proof_digest, witness), pa.string()),
                pa.array([e.hex() for e in ends], pa.string()), pa.array([e == r for e, r in zip(ends, root)], pa.bool_()),
            ], ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return manifest.select("doc_id", "leaf", "tampered", "witness", "subroot", "root").mapInArrow(fold, schema)
