"""Toxicity from the nearest labelled examples by exact TF-IDF cosine, found with block-max inverted lists.

Examples are a bounded sample of the labelled rows given: of each class the ``max_examples`` with the smallest
hash of their id. Terms are runs of letters and digits in lower case, and the beginnings of ``STEMS`` code points of longer ones, so
that inflected forms have a stem in common. A term counts by how far it tells the classes of the sample apart: its presence in toxic
examples exceeds that in others by z standard errors, and its axis is stretched by what z has beyond ``MARGIN``. The terms of greatest z
span the space, as far down as at most a share of ``CHANCE`` of them would be expected by chance (Benjamini and Hochberg), whatever
the size of the sample; there is no limit to their number. A last axis, ``COMMON``, is the same for all texts: texts in which little speaks
for a class are near to each other, and one chance term doesn't make a direction. Document frequencies are counted over all documents.
Weights are (1 + log tf) * idf * stretch, vectors have length one.

The inverted lists of the examples are cut into blocks of ``BLOCK`` examples; a block's list of a term keeps its
greatest weight. A query visits blocks in the order of their upper bounds and leaves out those that can no longer reach
its k-th best cosine, so the neighbours are exact. All examples at the k-th cosine are neighbours. The
neighbours vote by 1 / (distance + ``EPSILON``), and by the number of labelled rows that an example of its class stands for.
The share of toxic votes is calibrated by isotonic regression on the examples themselves, each left out of its own vote.

Texts are whole; ids, language and source are no inputs. Null and empty texts have the common axis only and get the score of such
documents. Without examples of both classes every score is the share of toxic rows, or 0.
Repeated rows score alike; of repeated labels of an id the greater holds, of repeated texts of a labelled id the least. Other columns are only dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.llm import arrays as A
from litmine.session import written

BLOCK, EPSILON = 64, 0.05
STEMS = (4, 5, 6)
MARGIN, LEAST_EXAMPLES, COMMON, CHANCE = 2.0, 3, 3.0, 0.25
FILTER_BITS = 20


def terms_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of every word, and then of the beginnings of longer ones."""
    data = A.lower_latin(data)
    words = A.find_words(data, bounds, A.LETTER[data] | A.DIGIT[data])
    heads = np.flatnonzero((data & 0xC0) != 0x80)  # where code points start
    first, last = np.searchsorted(heads, words.start), np.searchsorted(heads, words.end)
    row, start, end, salt = [words.rows()], [words.start], [words.end], [np.zeros(len(words.start), np.int64)]
    for n in STEMS:
        longer = np.flatnonzero(last - first > n)
        row.append(row[0][longer])
        start.append(words.start[longer])
        end.append(heads[first[longer] + n])
        salt.append(np.full(len(longer), n))
    row, start, end, salt = (np.concatenate(x) for x in (row, start, end, salt))
    return row, A.span_hash(data.astype(A.U64) + A.U64(1), start, end, A.BYTE_BASE) + salt.astype(A.U64) * A.U64(A.WORD_BASE)


def filter_of(vocabulary: np.ndarray) -> np.ndarray:
    """Which low bits of a hash occur in the vocabulary: most other terms end here."""
    held = np.zeros(1 << FILTER_BITS, bool)
    held[(vocabulary & A.U64((1 << FILTER_BITS) - 1)).astype(np.int64)] = True
    return held


def counted(data: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray, held: np.ndarray):
    """Per (text, term of the sorted vocabulary) found: text, term and how often. ``held`` is the vocabulary's filter."""
    row, hashes = terms_of(data, bounds)
    if not len(vocabulary) or not len(hashes):
        none = np.zeros(0, np.int64)
        return none, none, none
    some = held[(hashes & A.U64((1 << FILTER_BITS) - 1)).astype(np.int64)]
    row, hashes = row[some], hashes[some]
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[place] == hashes)
    pairs, times = np.unique(row[hit] * len(vocabulary) + place[hit], return_counts=True)
    return pairs // len(vocabulary), pairs % len(vocabulary), times


class Neighbours:
    """Exact nearest examples by cosine over block-max inverted lists."""

    def __init__(self, vectors: list[dict[int, float]], labels: np.ndarray, weights: np.ndarray, k: int) -> None:
        self.labels, self.weights, self.k, self.size = labels, weights, k, len(vectors)
        self.blocks = -(-self.size // BLOCK)
        entries = sorted((t, i, w) for i, vector in enumerate(vectors) for t, w in vector.items())
        term, self.ids, self.w = (np.array(c) for c in zip(*entries)) if entries else (np.zeros(0, np.int64),) * 3
        start, length = A.runs(term)
        self.terms = {int(term[a]): n for n, a in enumerate(start)}
        self.most = np.zeros((len(start), self.blocks))
        of = np.repeat(np.arange(len(start)), length)
        np.maximum.at(self.most, (of, self.ids // BLOCK), self.w)
        self.cuts = np.searchsorted(of * self.blocks + self.ids // BLOCK, np.arange(len(start) * self.blocks + 1))

    def cosines(self, terms: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers and cosines above 0 of whole blocks, from the lists' parts in these."""
        part = (terms[:, None] * self.blocks + blocks[None, :]).ravel()
        a, n = self.cuts[part], self.cuts[part + 1] - self.cuts[part]
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        known, place = np.unique(self.ids[at], return_inverse=True)
        found = np.bincount(place, np.repeat(np.repeat(weights, len(blocks)), n) * self.w[at], minlength=len(known))
        return known[found > 0], np.round(found[found > 0], 12)

    def nearest(self, vector: dict[int, float], leave: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Example numbers and cosines, best first and of equal ones the smaller number."""
        pairs = [(self.terms[t], w) for t, w in vector.items() if t in self.terms]
        if not pairs:
            return np.zeros(0, np.int64), np.zeros(0)
        terms, weights = np.array([t for t, _ in pairs]), np.array([w for _, w in pairs])
        bound = weights @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        ids, cosines, worst, at, step = np.zeros(0, np.int64), np.zeros(0), -1.0, 0, 2
        while at < len(order):
            some = order[at : at + step]
            some = some[(bound[some] > 0) & (bound[some] >= worst - 1e-9)]
            if not len(some):
                break
            more, near = self.cosines(terms, weights, some)
            ids, cosines = np.concatenate((ids, more[more != leave])), np.concatenate((cosines, near[more != leave]))
            if len(ids) > self.k:
                worst = -np.partition(-cosines, self.k - 1)[self.k - 1]
                ids, cosines = ids[cosines >= worst], cosines[cosines >= worst]
            at, step = at + step, step * 2
        best = np.lexsort((ids, -cosines))[: self.k]
        return ids[best], cosines[best]

    def _filled(self, cut: np.ndarray, terms: np.ndarray, weights: np.ndarray, row: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Cosines of every text with the examples of the blocks given for it, from the lists' parts in these; 0 elsewhere."""
        texts, n = len(cut) - 1, np.diff(cut)[row]
        entry = np.repeat(cut[row] - np.cumsum(n) + n, n) + np.arange(n.sum())
        part = terms[entry] * self.blocks + np.repeat(block, n)
        a, m = self.cuts[part], self.cuts[part + 1] - self.cuts[part]
        at = np.repeat(a - np.cumsum(m) + m, m) + np.arange(m.sum())
        place = np.repeat(np.repeat(row, n) * self.size, m) + self.ids[at]
        return np.bincount(place, np.repeat(weights[entry], m) * self.w[at], minlength=texts * self.size).reshape(texts, self.size)

    def votes(self, cut: np.ndarray, terms: np.ndarray, weights: np.ndarray, leave: np.ndarray | None = None) -> tuple[np.ndarray, list[list[int]]]:
        """The share of toxic votes and the three nearest examples of each text ``t`` with the terms ``cut[t]:cut[t + 1]`` (at least one each).

        The blocks with the greatest bounds give a cosine that the k-th best reaches at least; then the blocks whose bound reaches that are looked at.
        """
        texts = len(cut) - 1
        bound = np.add.reduceat(weights[:, None] * self.most[terms], cut[:-1])
        first = np.argsort(-bound, axis=1, kind="stable")[:, : -(-(self.k + 1) // BLOCK) + 1]
        rows = np.repeat(np.arange(texts), first.shape[1])
        cosines = self._filled(cut, terms, weights, rows, first.ravel())
        if leave is not None:
            cosines[np.arange(texts), leave] = 0
        k = min(self.k, self.size) - 1
        worst = -np.partition(-cosines, k, axis=1)[:, k]
        reach = (bound >= worst[:, None] - 1e-9) & (bound > 0)
        reach[rows, first.ravel()] = False
        cosines = np.round(cosines + self._filled(cut, terms, weights, *np.nonzero(reach)), 12)
        if leave is not None:
            cosines[np.arange(texts), leave] = 0
        worst = -np.partition(-cosines, k, axis=1)[:, k]
        near = (cosines >= worst[:, None]) & (cosines > 0)
        power = np.where(near, self.weights / (1 - np.minimum(cosines, 1) + EPSILON), 0.0)
        total = power.sum(axis=1)
        share = np.where(total > 0, power @ self.labels / np.where(total > 0, total, 1), np.average(self.labels, weights=self.weights))
        best = []
        for t in range(texts):
            ids = np.flatnonzero(near[t])
            best.append(ids[np.argsort(-cosines[t, ids], kind="stable")[:3]].tolist())
        return share, best


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[list[float], list[float]]:
    """Points of the non-decreasing function nearest to ``y`` by weighted squares (pooling neighbours that fall)."""
    pools: list[list[float]] = []  # weight, sum, least x, greatest x
    for v in np.unique(x):
        at = x == v
        pools.append([w[at].sum(), (w[at] * y[at]).sum(), v, v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    px, py = [], []
    for weight, total, a, b in pools:
        for v in dict.fromkeys((a, b)):
            px.append(float(v))
            py.append(float(total / weight))
    return px, py


class Model:
    """What scoring needs; its size is bounded by the terms of the sample."""

    def __init__(self, vocabulary: np.ndarray, weight: np.ndarray, examples: list, share: float, k: int) -> None:
        self.vocabulary, self.weight, self.share = vocabulary, weight, share
        self.ids = [e[0] for e in examples]
        labels = np.array([e[1] for e in examples], float)
        self.search = None
        if len(examples) and 0 < labels.mean() < 1:
            weights = np.where(labels > 0, share / labels.mean(), (1 - share) / (1 - labels.mean()))
            sizes = [len(e[2]) for e in examples]
            row, term, times = np.repeat(np.arange(len(examples)), sizes), *(np.array([x for e in examples for x in e[i]], np.int64) for i in (2, 3))
            cut, term, weight = self.vectors(len(examples), row, term, times)
            self.search = Neighbours([dict(zip(term[a:e].tolist(), weight[a:e].tolist())) for a, e in zip(cut[:-1], cut[1:])], labels, weights, k)
            raw = np.concatenate([r for r, _ in self.voted(cut, term, weight, np.arange(len(examples)))])
            self.curve = isotonic(np.round(raw, 9), labels, weights)

    def vectors(self, texts: int, row: np.ndarray, term: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms and weights of vectors of length one, text after text; the common axis is the term after the last."""
        row, term = np.concatenate((row, np.arange(texts))), np.concatenate((term, np.full(texts, len(self.vocabulary))))
        weight = np.concatenate(((1 + np.log(times)) * self.weight[term[: len(times)]], np.full(texts, COMMON)))
        order = np.lexsort((term, row))
        row, term, weight = row[order], term[order], weight[order]
        cut = np.searchsorted(row, np.arange(texts + 1))
        return cut, term, weight / np.sqrt(np.add.reduceat(weight * weight, cut[:-1]))[row]

    def voted(self, cut: np.ndarray, term: np.ndarray, weight: np.ndarray, leave: np.ndarray | None = None):
        """Votes of some texts at a time: so many that neither their terms nor their cosines take much memory."""
        known = np.array([t in self.search.terms for t in range(len(self.vocabulary) + 1)])[term]
        place = np.zeros(len(self.vocabulary) + 1, np.int64)
        place[list(self.search.terms)] = list(self.search.terms.values())
        cut = np.concatenate(([0], np.cumsum(known)))[cut]
        term, weight = place[term[known]], weight[known]
        at = 0
        while at < len(cut) - 1:
            to = max(at + 1, min(int(np.searchsorted(cut, cut[at] + (1 << 14), "right")) - 1, at + 256))
            of = slice(cut[at], cut[to])
            yield self.search.votes(cut[at : to + 1] - cut[at], term[of], weight[of], None if leave is None else leave[at:to])
            at = to

    def scores(self, texts: int, row: np.ndarray, term: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, list[list]]:
        if self.search is None:
            return np.full(texts, self.share), [[] for _ in range(texts)]
        found = list(self.voted(*self.vectors(texts, row, term, times)))
        raw = np.concatenate([r for r, _ in found])
        return np.interp(raw, *self.curve), [[self.ids[i] for i in ids] for _, best in found for ids in best]


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_examples: int = 1000, k: int = 25) -> Model:
    """Learn from ``labels (doc_id, toxic)`` of rows of ``docs (doc_id, text)``."""
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    rows = written(rows, "labels")
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    share = toxic / n if n else 0.0
    picked = None
    for value in (0, 1):  # bounded, so it may be broadcast
        one = rows.where(F.col("toxic") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
        picked = one if picked is None else picked.unionByName(one)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = written(texts, "examples")

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                row, hashes = terms_of(data, bounds)
                order = np.argsort(row, kind="stable")
                hashes, cut = hashes[order], np.searchsorted(row[order], np.arange(part.num_rows + 1))
                toxic = part.column(2).to_numpy()
                for value in (0, 1):
                    h = [np.unique(hashes[cut[t] : cut[t + 1]]) for t in np.flatnonzero(toxic == value)]
                    if h:
                        h, times = np.unique(np.concatenate(h), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h.view(np.int64)), pa.array(np.full(len(h), value, np.int32)), pa.array(times)], ["term", "toxic", "n"]
                        )

    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    vocabulary, stretch = np.zeros(0, A.U64), np.zeros(0)
    if pos and neg:
        found = sample.select("doc_id", "text", "toxic").mapInArrow(present, "term long, toxic int, n long").groupBy("term").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("p"), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("q")
        )
        rate = (F.col("p") + F.col("q")) / (pos + neg)
        z = (F.col("p") / pos - F.col("q") / neg) / F.sqrt(rate * (1 - rate) * (1 / pos + 1 / neg))
        tested = written(found.where((F.col("p") + F.col("q") >= LEAST_EXAMPLES) & (rate < 1)).select("term", z.alias("z")), "terms")
        telling = tested.where(F.col("z") > MARGIN).toPandas()  # bounded by the sample
        z = np.sort(telling["z"].to_numpy())[::-1]
        chance = np.array([math.erfc(x / math.sqrt(2)) / 2 for x in z]) * tested.count()
        number = int((np.flatnonzero(chance <= CHANCE * np.arange(1, len(z) + 1)) + 1).max(initial=0))
        telling = telling[telling["z"] >= (z[number - 1] if number else np.inf)]
        telling = telling.sort_values("term", key=lambda t: t.to_numpy().view(A.U64))
        vocabulary, stretch = telling["term"].to_numpy().view(A.U64), telling["z"].to_numpy() - MARGIN
    held = filter_of(vocabulary)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                total += np.bincount(counted(data, bounds, vocabulary, held)[1], minlength=len(vocabulary))
                seen += part.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(len(total)), -1)), pa.array(np.append(total, seen))], ["term", "n"])

    counts = docs.select("text").mapInArrow(frequencies, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = {r["term"]: r["n"] for r in counts}
    idf = np.log((1 + df.get(-1, 0)) / (1 + np.array([df.get(t, 0) for t in range(len(vocabulary))], float))) + 1
    weight = np.round(idf * stretch, 9)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                row, term, times = counted(data, bounds, vocabulary, held)
                cut = np.searchsorted(row, np.arange(part.num_rows + 1))
                lists = [[x[a:e].tolist() for a, e in zip(cut[:-1], cut[1:])] for x in (term, times)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), *[pa.array(x, pa.list_(pa.int64())) for x in lists]], ["doc_id", "toxic", "terms", "times"]
                )

    kind = dict(sample.dtypes)["doc_id"]
    examples = sample.select("doc_id", "text", "toxic").mapInArrow(vectors, f"doc_id {kind}, toxic int, terms array<bigint>, times array<bigint>")
    rows = sorted((r["terms"], r["times"], r["doc_id"], r["toxic"]) for r in examples.collect())  # like examples side by side
    return Model(vocabulary, weight, [(d, y, t, n) for t, n, d, y in rows], share, k)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``evidence`` (ids of the nearest examples); columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score", "evidence")
    schema = docs.withColumns({"score": F.lit(0.0), "evidence": F.lit(None).cast("array<bigint>")}).schema

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        held = filter_of(model.vocabulary)
        for batch in batches:
            for part, data, bounds in A.chunks(batch):
                row, term, times = counted(data, bounds, model.vocabulary, held)
                scores, evidence = model.scores(part.num_rows, row, term, times)
                columns = [part.column(i) for i in range(part.num_columns)]
                columns += [pa.array(scores, pa.float64()), pa.array(evidence, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, "score", "evidence"])

    return docs.mapInArrow(scan, schema)
