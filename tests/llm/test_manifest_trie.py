"""Manifest, near-duplicates by min-max hashing and conversation trie against brute force, awkward rows and empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from litmine.llm.conversation_trie import SpillingQueue, conversation_trie
from litmine.llm.merkle_manifest import Appender, H, audited, folded, merkle_manifest, witness_of
from litmine.llm.minmax_dedup import minmax_components, signatures
from tests.llm.fixtures import awkward_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def hexed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(values):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(leaves):
    """Root and each leaf's path of (before, after) siblings."""
    level, paths = [(x, [k]) for k, x in enumerate(leaves)], [[] for _ in leaves]
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for run in runs:
            for k, (_, below) in enumerate(run):
                for leaf in below:
                    paths[leaf].append(([d for d, _ in run[:k]], [d for d, _ in run[k + 1 :]]))
        level = [(hexed(*(d for d, _ in run)), [leaf for _, below in run for leaf in below]) for run in runs]
    return level[0][0], paths


def brute_manifest(rows):
    by_source = defaultdict(list)
    for i, text, lang, source, n_chars in rows:
        leaf = hexed(framed((i, source, lang, n_chars, text)))
        even = i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        changed = hexed(framed((i, source, lang, n_chars, text.replace("\n", "") if text else text))) if even else leaf
        by_source[source].append((i is not None, i or 0, leaf, changed))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s])]) for s in order}
    root, outer = tree([trees[s][0] for s in order])
    out = Counter()
    for place, s in enumerate(order):
        for (known, i, leaf, changed), path in zip(sorted(by_source[s]), trees[s][1]):
            end, proof = changed, ""
            for before, after in path + outer[place]:
                proof += "".join(before + after)
                end = hexed(*before, end, *after)
            out[i if known else None, leaf, trees[s][0], root, hexed(proof), end, end == root] += 1
    return out


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest_matches_brute_force(spark, rows, levels):
    got = Counter(map(tuple, audited(merkle_manifest(rows, levels)).collect()))
    assert got == brute_manifest([(i, t, lang, s, n) for i, t, lang, s, n, *_ in awkward_rows()])


def test_manifest_of_many_nulls_and_one_hot_source(spark):
    data = [(None if k % 9 == 0 else k % 40, None if k % 5 == 0 else f"line\n{k % 7}", None, "hot" if k % 3 else None, k % 2) for k in range(200)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = Counter(map(tuple, audited(merkle_manifest(docs, 2)).collect()))
    assert got == brute_manifest(data) and not all(r[-1] for r in got) and any(r[-1] for r in got)


def test_manifest_of_no_rows_and_one(spark, none, rows):
    assert audited(merkle_manifest(none)).collect() == []
    one = audited(merkle_manifest(rows.where("doc_id = 7"))).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == hashlib.sha256(b"").hexdigest() and one["verified"]


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9])
@pytest.mark.parametrize("whole", [True, False])
def test_appended_leaves_fold_to_the_root(n, whole):
    appender, leaves = Appender(2), [H(bytes([k])) for k in range(n)]
    for leaf in leaves:
        appender.append(leaf)
    root = appender.finish(whole)
    assert all(folded(leaf, witness_of(appender.packed(), k)) == root for k, leaf in enumerate(leaves))
    assert not whole or root.hex() == tree([x.hex() for x in leaves])[0]


def brute_components(texts, gram, percent):
    sets = []
    for i, text in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = WORD.findall(low)
        grams = {tuple(words[k : k + gram]) for k in range(len(words) - gram + 1)} if len(words) >= gram else {tuple(words)} if words else set()
        sets.append((LAST if i is None else i, grams))
    at = list(range(len(sets)))

    def root(k):
        while at[k] != k:
            k = at[k]
        return k

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                at[root(x)] = root(y)
    least = defaultdict(lambda: LAST)
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least[root(k)], i)
    plain = lambda i: None if i == LAST else i
    return Counter((plain(i), len(g), plain(least[root(k)]), i == least[root(k)]) for k, (i, g) in enumerate(sets))


def test_minmax_components_match_brute_force(spark, rows):
    texts = [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()]
    assert Counter(map(tuple, minmax_components(rows).collect())) == brute_components(texts, 2, 80)


def test_minmax_components_of_families_and_chains(spark):
    r = random.Random(3)
    texts = []
    for family in range(12):
        words = [f"w{r.randrange(3000)}" for _ in range(r.choice([3, 5, 9, 40, 160]))]
        for _ in range(12):
            texts.append((len(texts), " ".join(words)))
            if r.random() < 0.5:  # a chain: each member differs from the one before
                words = list(words)
                words[r.randrange(len(words))] = f"w{r.randrange(3000)}"
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, minmax_components(docs).collect()))
    assert got == brute_components(texts, 2, 80) and 12 < sum(n for (*_, kept), n in got.items() if kept) < 144


def test_minmax_components_of_copies_with_changes_of_their_own(spark):
    r = random.Random(8)
    texts = []
    for family in range(3):
        base = [f"w{r.randrange(60)}" for _ in range(140)]
        for _ in range(90):
            words = list(base)
            for _ in range(r.randrange(0, 16)):
                at = r.randrange(len(words))
                words[at : at + 1] = r.choice([[f"w{r.randrange(60)}"], [], [words[at], "more"], [f"v{r.randrange(10**6)}"]])
            texts.append((len(texts), " ".join(words)))
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = Counter(map(tuple, minmax_components(docs).collect()))
    assert got == brute_components(texts, 2, 80) and 10 < sum(n for (*_, kept), n in got.items() if kept)


def test_minmax_of_no_rows_and_empty_texts(spark, none):
    assert minmax_components(none).collect() == []
    blank = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, " ")], "doc_id long, text string")
    assert Counter(map(tuple, minmax_components(blank).collect())) == Counter([(1, 0, 1, True), (2, 0, 2, True), (2, 0, 2, True), (None, 0, None, True)])


def test_both_ends_of_permutations_estimate_the_similarity():
    r = np.random.default_rng(1)
    common, a, b = (r.integers(0, 1 << 63, n, dtype=np.int64).view(np.uint64) for n in (400, 100, 100))
    x, y = (signatures(np.concatenate((common, z)), np.array([500]), rows=1, groups=400)[0] for z in (a, b))
    assert abs((x == y).mean() - 400 / 600) < 0.08
    assert len(set(x.tolist())) == 800
    one = signatures(np.array([7, 7, 9], np.uint64), np.array([1, 2]))
    assert one.shape == (2, 60) and not (one[0] == one[1]).all()


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + mine[h:])
    members = defaultdict(list)
    for c in sorted(whole):
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    out = Counter()
    for key, of in members.items():
        below = [k for k in members if k[: len(key)] == key]
        leaf = [k for k in below if not any(x[: len(k)] == k and len(x) == len(k) + 1 for x in members)]
        ends = hexed(",".join(str(c) for c in of if whole[c] == key))
        saved = sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k)
        children = sum(x[: len(key)] == key and len(x) == len(key) + 1 for x in members)
        out[of[0], len(key), members[key[:-1]][0] if key else None, len(of), children, len(leaf), saved, ends] += 1
    return out


TALK = "conv_id long, turn long, role string, text string, n long, depth string, h1 int"


def talk():
    r = random.Random(6)
    rows = [(c, None if k == 2 and c % 7 == 0 else k, r.choice(["user", "assistant", None]), r.choice(["hi", "é ü", "", None, "more", f"t{c % 4}"]))
            for c in [*range(0, 40), *range(95, 130), -3, -100, 300, 301] for k in range(r.randrange(1, 9))]
    rows += [(250, k, "user", f"long {k % 3}") for k in range(60)] + [(251, k, "user", f"long {k % 3}") for k in range(60)]
    rows += [(17, 4, "user", "hi"), (17, 4, "user", "hi"), (None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(c, 9, "user", "alike") for c in range(500, 540)] + [(600, 10**9, "user", "x" * 20000)]
    return [(*row, 1, "x", 2) for row in rows]


@pytest.mark.parametrize("weight, levels, queue_rows", [(4096, 1024, 1 << 18), (2, 3, 3), (5, 1, 1), (3, 2, 2)])
def test_trie_matches_brute_force(spark, weight, levels, queue_rows):
    docs = spark.createDataFrame(talk(), TALK).repartition(4)
    got = Counter(map(tuple, conversation_trie(docs, weight, levels, queue_rows).collect()))
    assert got == brute_trie([row[:4] for row in talk()])


def test_trie_of_no_conversations(spark):
    for rows in ([], [(None, 1, "user", "x", 1, "x", 1)]):
        assert conversation_trie(spark.createDataFrame(rows, TALK)).collect() == []


def test_spilling_queue_takes_in_order():
    r, queue, want = random.Random(2), SpillingQueue(2, 5), defaultdict(list)
    for k in range(300):
        message = (r.randrange(9), r.randrange(9), k)
        queue.push(message)
        want[message[:2]].append((k,))
    assert queue.runs > 40
    for key in sorted(want):
        assert sorted(queue.take(key)) == want[key]
    assert not queue.heap and not queue.heads
