"""Training-order materialisation: token sequences in a keyed random order, in shards of fixed stride.

1. Texts become token ids (byte-level BPE of a public vocabulary file; ``encode`` is a parameter). Documents of an
   input partition are laid end to end, each closed by ``end``, and cut into sequences of ``length`` ids; the last
   one is filled up with ``end``. Sequences are stored once, compressed by the ``BLOCK``, so texts are tokenised once.
2. A sequence's number is its place in its partition plus the sequences of the partitions before.
3. Its global slot is a keyed permutation of the numbers below N: a balanced Feistel network over the smallest
   even number of bits that holds N, walked on until the value lies below N. Nothing is shuffled to find it.
4. Slots ``[s * per_shard, (s + 1) * per_shard)`` go to shard s, which one task holds and writes in order of slots. A record is the
   slot (8 bytes), the ids (2 bytes each, little-endian) and a newline byte, so that record k of shard s lies at
   ``k * stride``, and a reader goes on at any slot by one seek.

Spark's own text writer commits the shards, so a lost executor repeats single shards. The order is a function of
key, input rows and their partitions. Tables that pass through one task have a row per input partition.
Null and empty texts are a lone ``end``. Repeated rows are written as often. A null id is carried as null.
Other columns are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

ROUNDS = 6
BLOCK, DEALT = 1024, 8192
#: Fixed value: the public pattern that splits text before merges of byte-level BPE rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def rank_file_encoder(path: str = VOCABULARY) -> Callable[[], Callable[[str], np.ndarray]]:
    """A function for tasks that makes an encoder of a rank file; the file is read here and shipped with the task."""
    with open(path, "rb") as lines:
        raw = lines.read()

    def make() -> Callable[[str], np.ndarray]:
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, raw.splitlines())}
        encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda text: encoding.encode_to_numpy(text, disallowed_special=())

    return make


def feistel(numbers: np.ndarray, n: int, key: int, backward: bool = False) -> np.ndarray:
    """The slots of sequence numbers below ``n``, or the numbers of slots."""
    half = max(1, -(-(max(n - 1, 1)).bit_length() // 2))
    mask = A.U64((1 << half) - 1)
    keys = A.mix(np.arange(1, ROUNDS + 1, dtype=A.U64) * A.U64(A.BYTE_BASE) + A.U64(key % (1 << 64)))
    out = numbers.astype(A.U64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> A.U64(half), out[todo] & mask
        for k in reversed(keys) if backward else keys:
            if backward:
                left, right = right ^ (A.mix(left + k) & mask), left
            else:
                left, right = right, left ^ (A.mix(right + k) & mask)
        out[todo] = (left << A.U64(half)) | right
        todo[todo] = out[todo] >= A.U64(n)
    return out.astype(np.int64)


def token_sequences(docs: DataFrame, make_encoder: Callable, length: int, end: int) -> DataFrame:
    """Rows ``part, at, n, ids, doc_ids, n_tokens``: blocks of ``n`` sequences of each partition in order, from number ``at`` on."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, codec = make_encoder(), pa.Codec("zstd", compression_level=3)
        part = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        owners: list = []
        count = at = 0
        rows: list[tuple] = []

        def block() -> pa.RecordBatch:
            blob = codec.compress(b"".join(r[0] for r in rows), asbytes=True)
            values = (part, at - len(rows), len(rows), blob, [r[1] for r in rows], [r[2] for r in rows])
            types = [pa.int64()] * 3 + [pa.binary(), pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64())]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], ["part", "at", "n", "ids", "doc_ids", "n_tokens"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(np.append(encode(text or "").astype(np.uint16), np.uint16(end)))
                owners.append(doc_id)
                count += len(held[-1])
                if count < length:
                    continue
                tokens, names = np.concatenate(held), owners
                for start in range(0, count - length + 1, length):
                    rows.append((tokens[start : start + length].tobytes(), names, length))
                    at += 1
                    names = [doc_id]
                    if len(rows) == BLOCK:
                        yield block()
                rest = tokens[count // length * length :]
                held, owners, count = ([rest], [doc_id], len(rest)) if len(rest) else ([], [], 0)
        if count:
            tokens = np.concatenate([*held, np.full(length - count, end, np.uint16)])
            rows.append((tokens.tobytes(), owners, count))
            at += 1
        if rows:
            yield block()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "part long, at long, n long, ids binary, doc_ids array<array<bigint>>, n_tokens array<bigint>"
    )


def write_shards(
    docs: DataFrame, path: str, make_encoder: Callable | None = None, length: int = 1024, end: int = 50256, per_shard: int = 4096, key: int = 1
) -> DataFrame:
    """Write ``docs (doc_id, text)`` as shards under ``path``; the index of it: ``sequence, slot, shard, offset, doc_ids, n_tokens, crc``."""
    stored = written(token_sequences(docs, make_encoder or rank_file_encoder(), length, end), "sequences")
    counts = stored.groupBy("part").agg(F.sum("n").alias("n"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = written(counts.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base")), "bases")
    total = bases.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    based = stored.join(broadcast_if_small(bases.select("part", "base")), "part").select(
        (F.col("base") + F.col("at")).alias("first"), "n", "ids", "doc_ids", "n_tokens"
    )

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Per block the slots, the bytes of each sequence, and the block's row."""
        codec = pa.Codec("zstd")
        for batch in batches:
            for first, n, ids, doc_ids, n_tokens in zip(*batch.columns):
                first, n = first.as_py(), n.as_py()
                raw = codec.decompress(ids.as_buffer(), 2 * length * n, asbytes=True)
                numbers = np.arange(first, first + n)
                yield numbers, feistel(numbers, total, key), [raw[i : i + 2 * length] for i in range(0, len(raw), 2 * length)], doc_ids, n_tokens

    def to_deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What goes from here to a shard as one compressed row for every ``DEALT`` sequences read."""
        codec = pa.Codec("zstd", compression_level=3)
        slots: list[np.ndarray] = []
        held: list[bytes] = []

        def flush() -> pa.RecordBatch:
            slot = np.concatenate(slots)
            order = np.argsort(slot)
            slot, out = slot[order], []
            for s, n in zip(*A.runs(slot // per_shard)):
                blob = b"".join(held[i] for i in order[s : s + n])
                out.append((int(slot[s] // per_shard), slot[s : s + n].tobytes(), codec.compress(blob, asbytes=True)))
            slots.clear()
            held.clear()
            types = [pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["shard", "slots", "ids"])

        for _, slot, raw, _, _ in sequences(batches):
            slots.append(slot)
            held += raw
            if len(held) >= DEALT:
                yield flush()
        if held:
            yield flush()

    def to_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for numbers, slot, raw, doc_ids, n_tokens in sequences(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers), pa.array(slot), pa.array((slot // per_shard).astype(np.int32)), doc_ids.values, n_tokens.values,
                 pa.array([zlib.crc32(r) for r in raw], pa.int64())],
                ["sequence", "slot", "shard", "doc_ids", "n_tokens", "crc"],
            )

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd")
        parts = [(np.frombuffer(r["slots"], np.int64), r["ids"]) for batch in batches for r in batch.to_pylist()]
        if not parts:
            return
        slots = np.concatenate([slot for slot, _ in parts])  # of one shard
        table = np.concatenate([
            np.frombuffer(codec.decompress(ids, 2 * length * len(slot), asbytes=True), np.uint8).reshape(-1, 2 * length) for slot, ids in parts
        ])
        order = np.argsort(slots)
        for start in range(0, len(order), 512):
            raw = [slots[i].tobytes() + table[i].tobytes() for i in order[start : start + 512]]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary())], ["value"])

    shards = max(1, -(-total // per_shard))
    dealt = based.mapInArrow(to_deal, "shard int, slots binary, ids binary").repartitionById(shards, "shard").select("slots", "ids")
    dealt.mapInArrow(records, "value binary").select(F.col("value").cast("string")).write.text(path, lineSep="\n")
    stride = 8 + 2 * length + 1
    index = based.mapInArrow(to_index, "sequence long, slot long, shard int, doc_ids array<bigint>, n_tokens long, crc long")
    return index.select("sequence", "slot", "shard", ((F.col("slot") % per_shard) * stride).alias("offset"), "doc_ids", "n_tokens", "crc")


def read_shards(spark, path: str, length: int = 1024, from_slot: int = 0) -> DataFrame:
    """Rows ``slot, ids, crc`` of the records from a slot on; shards are files of whole records."""
    files = spark.read.format("binaryFile").load(path).select("content")
    stride = 8 + 2 * length + 1

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for content in batch.column(0):
                table = np.frombuffer(content.as_buffer(), np.uint8).reshape(-1, stride)
                slots = table[:, :8].copy().view(np.int64).ravel()
                for start in range(0, len(table), 512):
                    at = slice(start, start + 512)
                    raw = [row.tobytes() for row in table[at, 8:-1]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slots[at]), pa.array(raw, pa.binary()), pa.array([zlib.crc32(r) for r in raw], pa.int64())], ["slot", "ids", "crc"]
                    )

    return files.mapInArrow(records, "slot long, ids binary, crc long").where(F.col("slot") >= from_slot)
