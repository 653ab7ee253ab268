"""Benchmark decontamination by templates: re-parameterised questions share a template, with consistent slots.

Tokens are runs of letters and digits, in lower case. A token that starts with a digit becomes a number slot, a
capitalised one that doesn't start a sentence a name slot, and a unit after a number a unit slot. Names or numbers with only
white space between them are one slot, whose value is all of them. Windows of
``window`` template tokens (all tokens of shorter items), at least half of them no slots, are hashed and
joined with those of the benchmark. An item's windows with more slots are found in three other ways: by their literal tokens; by template
and the signs between the tokens, if these tell enough (half of the tokens plain or followed by an operator, three plain tokens or kinds of
operators); and as part of windows three times as long with ``window // 2`` plain tokens. Matched windows of an item on one diagonal (document place
less item place) cover tokens of the item, and diagonals that are at most ``window`` tokens apart from the next one, as inserted or missing words make them, are added
up; a covered slot counts only while the values of item and document map one to one, so a name that stands for two others is no match. A document is
contaminated by an item if the best such group of diagonals covers at least ``share`` of the item's tokens, or ``enough`` of them.

The benchmark is read in blocks of at most ``block_bytes``, measured, and each block is broadcast;
documents are never shuffled. Null or empty texts match nothing, also as items. Repeated rows
are judged alike. All columns of ``docs`` stay; a column ``matches`` is replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm import arrays as A

NUMBER, NAME, UNIT = 1, 2, 3
TEMPLATE, LITERAL, SIGNED, LONG = range(4)  # ways in which windows are compared
UNITS = (
    "mm cm m km in ft yd mi mg g kg t lb oz ml cl l gal s sec min h hr ms day days week weeks month months year years hour hours minute "
    "minutes second seconds meter meters metre metres kilometer kilometers mile miles inch inches foot feet gram grams kilogram kilograms "
    "pound pounds liter liters litre litres percent dollar dollars cent cents euro euros degree degrees mph kmh w kw v a hz"
).split()
STOP = np.zeros(256, bool)
STOP[list(b".!?\n")] = True
OPERATOR = np.zeros(256, bool)
OPERATOR[list(b"+-*/=<>^%()[]{}~&!")] = True
MATCH = "struct<item_id: bigint, matched: bigint, tokens: bigint, changed_slots: bigint>"


class Template:
    """The template tokens of a chunk of texts: hash and kind of each, and the bytes behind it."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        digit = A.DIGIT[data]
        inside = A.LETTER[data] | digit
        if len(data) > 2:  # a point or comma between digits
            inside[1:-1] |= ((data[1:-1] == 46) | (data[1:-1] == 44)) & digit[:-2] & digit[2:]
        self.words = words = A.find_words(data, bounds, inside)
        self.low = A.lower_latin(data)
        plain = A.span_hash(self.low.astype(A.U64) + A.U64(1), words.start, words.end, A.BYTE_BASE)
        self.kind = kind = np.zeros(len(plain), np.int8)
        if len(plain):
            head = words.start
            upper = (self.low != data)
            second = np.minimum(head + 1, len(data) - 1)
            capital = upper[head] | (upper[second] & (data[head] == 0xC3))
            after = np.minimum(np.where(data[head] == 0xC3, head + 2, head + 1), len(data) - 1)
            shout = (after < words.end) & (upper[after] | ((data[after] == 0xC3) & upper[np.minimum(after + 1, len(data) - 1)]))
            stops = np.concatenate(([0], np.cumsum(STOP[data])))
            starts = np.ones(len(plain), bool)
            starts[1:] = stops[head[1:]] > stops[words.end[:-1]]
            starts[words.first[:-1][words.counts > 0]] = True
            kind[capital & ~shout & ~starts] = NAME
            number = digit[head]
            kind[number] = NUMBER
            unit = np.isin(plain, UNIT_HASHES)
            unit[0] = False
            unit[1:] &= number[:-1] & ~starts[1:]
            kind[unit] = UNIT
            more = np.zeros(len(plain), bool)  # a name or number that goes on
            more[1:] = (kind[1:] == kind[:-1]) & ((kind[1:] == NAME) | (kind[1:] == NUMBER))
            ink, lines = (np.concatenate(([0], np.cumsum(x))) for x in (~A.SPACE[data], data == 10))
            more[1:] &= (ink[head[1:]] == ink[words.end[:-1]]) & (lines[head[1:]] == lines[words.end[:-1]])
            more[words.first[:-1][words.counts > 0]] = False
            if more.any():
                self.kind = kind = kind[~more]
                start, end = head[~more], words.end[np.concatenate((~more[1:], [True]))]
                self.words = words = A.Words(data, bounds, start, end, np.searchsorted(start, bounds))
                plain = A.span_hash(self.low.astype(A.U64) + A.U64(1), start, end, A.BYTE_BASE)
        self.data, self.literal = data, plain
        self.hashes = np.where(kind > 0, A.mix(kind.astype(A.U64)), plain)
        self.plain = np.concatenate(([0], np.cumsum(kind == 0)))

    def signs(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each token but the last: a hash of what is between it and the next one besides white space, and whether an operator is."""
        end, start = self.words.end[:-1], self.words.start[1:]
        ink = ~A.SPACE[self.data]
        place, ops = (np.concatenate(([0], np.cumsum(x))) for x in (ink, OPERATOR[self.data]))
        between = A.span_hash(self.data[ink].astype(A.U64) + A.U64(1), place[end], place[start], A.BYTE_BASE)
        return between, ops[start] > ops[end]

    def windows(self, n: int, way: int) -> tuple[np.ndarray, np.ndarray]:
        """Where windows of ``n`` tokens start, and their hashes; by template only those with enough plain ones."""
        at = np.flatnonzero(self.words.room(n))
        if way == TEMPLATE:
            at = at[2 * (self.plain[at + n] - self.plain[at]) >= n]
        if not len(at):
            return at, np.zeros(0, A.U64)
        if way == SIGNED:
            between, _ = self.signs()
            pairs = A.gram_hash(A.mix(self.hashes[:-1] ^ A.mix(between)), n - 1)
            return at, A.mix(pairs[at] ^ A.mix(self.hashes[at + n - 1]))
        return at, A.gram_hash(self.literal if way == LITERAL else self.hashes, n)[at]

    def dense(self, at: np.ndarray, n: int) -> np.ndarray:
        """Whether windows have more than half slots."""
        return 2 * (self.plain[at + n] - self.plain[at]) < n

    def telling(self, at: np.ndarray, n: int) -> np.ndarray:
        """Whether windows that have many slots can be known by their plain tokens and operators."""
        between, operator = self.signs()
        ops = np.concatenate(([0], np.cumsum(operator)))
        plain = self.plain[at + n] - self.plain[at]
        kinds = np.array([len(set(between[a : a + n - 1][operator[a : a + n - 1]].tolist())) for a in at.tolist()], np.int64)
        return (2 * (plain + ops[at + n - 1] - ops[at]) >= n) & (plain + kinds >= 3)

    def value(self, i: int) -> bytes:
        return self.low[self.words.start[i] : self.words.end[i]].tobytes()


def _hashes_of(tokens: list[str]) -> np.ndarray:
    raw = [t.encode() for t in tokens]
    end = np.cumsum([len(r) for r in raw])
    return A.span_hash(np.frombuffer(b"".join(raw), np.uint8).astype(A.U64) + A.U64(1), end - [len(r) for r in raw], end, A.BYTE_BASE)


UNIT_HASHES = _hashes_of(UNITS)


class TemplateIndex:
    """The windows of benchmark items by length and hash."""

    def __init__(self, items: list[tuple[int, str]], window: int) -> None:
        self.window = window
        self.ids = [i for i, _ in items]
        raw = [t.encode() for _, t in items]
        self.template = Template(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))
        self.first = self.template.words.first
        counts = self.template.words.counts
        row = self.template.words.rows()
        self.by_way = {}
        size = counts[row]
        for way in (TEMPLATE, LITERAL, SIGNED, LONG):
            longest = 3 * window if way == LONG else window
            for n in sorted({min(longest, int(c)) for c in counts if c > (window if way == LONG else way == SIGNED)}):
                at, h = self.template.windows(n, way)
                keep = np.minimum(longest, size[at]) == n
                if way in (LITERAL, SIGNED):
                    keep &= self.template.dense(at, n)
                elif way == LONG:  # with a dense window inside
                    first = np.flatnonzero(self.template.words.room(window))
                    inner = np.zeros(len(row) + 1, np.int64)
                    inner[first[self.template.dense(first, window)] + 1] = 1
                    inner = np.cumsum(inner)
                    plain = self.template.plain[at + n] - self.template.plain[at]
                    keep &= (inner[at + n - window + 1] > inner[at]) & (2 * plain >= window)
                at, h = at[keep], h[keep]
                if way == SIGNED and len(at):
                    keep = self.template.telling(at, n)
                    at, h = at[keep], h[keep]
                order = np.argsort(h, kind="stable")
                if len(order):
                    self.by_way[way, n] = h[order], at[order], row[at[order]]

    def consistent(self, doc: Template, diagonals: dict[int, set[int]]) -> tuple[int, int]:
        """How many tokens of an item the diagonals cover with slots that map one to one, and how many slots have another value.

        A token is looked at on the longest diagonal that covers it first.
        """
        to, back, changed, seen = {}, {}, set(), set()
        for shift in sorted(diagonals, key=lambda s: (-len(diagonals[s]), s)):
            for q in sorted(diagonals[shift] - seen):
                if self.template.kind[q]:
                    kind, old, new = int(self.template.kind[q]), self.template.value(q), doc.value(q + shift)
                    if to.setdefault((kind, old), new) != new or back.setdefault((kind, new), old) != old:
                        continue
                    if old != new:
                        changed.add((kind, old))
                seen.add(q)
        return len(seen), len(changed)

    def matches(self, data: np.ndarray, bounds: np.ndarray, share: float, enough: int) -> list[list[dict]]:
        """For each text of a chunk the items that contaminate it."""
        doc = Template(data, bounds)
        row = doc.words.rows()
        covered: dict[tuple[int, int], dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for (way, n), (keys, at, item) in self.by_way.items():
            place, h = doc.windows(n, way)
            low, high = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
            for k in np.flatnonzero(high > low).tolist():
                p = int(place[k])
                for j in range(low[k], high[k]):
                    covered[int(row[p]), int(item[j])][p - int(at[j])].update(range(int(at[j]), int(at[j]) + n))
        found: list[dict[int, dict]] = [{} for _ in range(len(bounds) - 1)]
        for (t, i), diagonals in covered.items():
            size = int(self.first[i + 1] - self.first[i])
            shifts = sorted(diagonals)
            cuts = [0, *(k for k in range(1, len(shifts)) if shifts[k] - shifts[k - 1] > self.window), len(shifts)]
            for a, e in zip(cuts[:-1], cuts[1:]):
                # the single diagonals count too: added up, their slots could hinder each other
                for group in [shifts[a:e], *([s] for s in shifts[a:e] if e - a > 1)]:
                    if sum(len(diagonals[s]) for s in group) < min(share * size, enough):
                        continue
                    matched, changed = self.consistent(doc, {s: diagonals[s] for s in group})
                    if matched >= min(share * size, enough) and matched > found[t].get(i, {"matched": 0})["matched"]:
                        found[t][i] = {"item_id": self.ids[i], "matched": matched, "tokens": size, "changed_slots": changed}
        return [[f[i] for i in sorted(f)] for f in found]


def template_matches(
    docs: DataFrame, benchmark: DataFrame, window: int = 8, share: float = 0.5, block_bytes: int = 16 << 20, enough: int = 40
) -> DataFrame:
    """``docs`` with ``matches``: the items of ``benchmark (item_id, text)`` that contaminate each row."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-2 * size // block_bytes)) if size > block_bytes else 1
    docs = docs.drop("matches").withColumn("matches", F.lit(None).cast(f"array<{MATCH}>"))
    schema, place = docs.schema, len(docs.columns) - 1
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("item_id", "matched", "tokens", "changed_slots")]))
    for block in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        held = docs.sparkSession.sparkContext.broadcast(sorted((r[0], r[1]) for r in part.toLocalIterator()))

        def scan(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = TemplateIndex(held.value, window)
            for batch in batches:
                for rows, data, bounds in A.chunks(batch):
                    new = index.matches(data, bounds, share, enough)
                    old = rows.column(place).to_pylist()
                    yield rows.set_column(place, "matches", pa.array([(o or []) + n for o, n in zip(old, new)], kind))

        docs = docs.mapInArrow(scan, schema)
    return docs


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that no item contaminates."""
    return template_matches(docs, benchmark, **options).where(F.size("matches") == 0).drop("matches")
