"""Operators on documents against brute force, on awkward rows and on an empty table."""

import re
from collections import Counter, defaultdict

from litmine.llm.jaccard_join import jaccard_components, one_of_each
from litmine.llm.line_dedup import banded_distance, line_dedup
from litmine.llm.line_quality import line_quality
from litmine.llm.source_mix import mix_sources, mixed_documents, mixed_pieces
from litmine.llm.substring_dedup import SuffixAutomaton, substring_dedup

from tests.llm.fixtures import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_jaccard_components_match_brute_force(spark, rows):
    sets = []
    for i, text in rows_of(rows):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = WORD.findall(low)
        grams = {tuple(words[k : k + 4]) for k in range(len(words) - 3)} if len(words) > 3 else {tuple(words)} if words else set()
        sets.append((LAST if i is None else i, grams))
    at = list(range(len(sets)))

    def root(k):
        while at[k] != k:
            k = at[k]
        return k

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets):
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                at[root(x)] = root(y)
    least = defaultdict(lambda: LAST)
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least[root(k)], i)
    plain = lambda i: None if i == LAST else i
    want = Counter((plain(i), len(g), plain(least[root(k)])) for k, (i, g) in enumerate(sets))
    assert Counter(tuple(r) for r in jaccard_components(rows).collect()) == want


def test_one_of_each_keeps_the_first_and_all_columns(rows):
    kept = one_of_each(rows)
    assert kept.columns == rows.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert 1 in ids and 2 not in ids and 3 not in ids and ids[9] == 2 and ids[None] == 1 and {4, 5, 6, 7, 20} <= set(ids) and 8 not in ids and 21 not in ids


def test_light_and_heavy_sets_give_the_same(spark, monkeypatch):
    import litmine.llm.jaccard_join as join

    texts = [(k, sentence(k % 7, 30 + k % 3)) for k in range(60)] + [(100 + k, sentence(50, 200)[: 1200 + 3 * k]) for k in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = sorted(map(tuple, jaccard_components(docs).collect()))
    for light in (0, 40, 10**9):
        monkeypatch.setattr(join, "boundary", lambda sets, percent, light=light: light)
        assert sorted(map(tuple, jaccard_components(docs).collect())) == want
    assert len({c for *_, c in want}) < len(want)


def brute_substrings(texts, n):
    first, words = {}, {k: WORD.findall(t or "") for k, (_, t) in enumerate(texts)}
    order = sorted(range(len(texts)), key=lambda k: (texts[k][0] is None, texts[k][0] or 0))
    place = lambda k, i: ((LAST if texts[k][0] is None else texts[k][0]), i)
    for k in order:
        for i in range(len(words[k]) - n + 1):
            w = tuple(words[k][i : i + n])
            first[w] = min(first.get(w, place(k, i)), place(k, i))
    out = []
    for k, (doc, _) in enumerate(texts):
        gone = set()
        for i in range(len(words[k]) - n + 1):
            if first[tuple(words[k][i : i + n])] < place(k, i):
                gone.update(range(i, i + n))
        out.append((doc, len(words[k]), len(gone), " ".join(w for i, w in enumerate(words[k]) if i not in gone)))
    return Counter(out)


def test_substring_dedup_matches_brute_force(rows):
    got = substring_dedup(rows, 20).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == brute_substrings(rows_of(rows), 20)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in got)


def test_substring_dedup_with_often_repeated_passages(spark):
    passage = sentence(1, 26)
    texts = [(k, f"{sentence(100 + k, 6)} {passage} {sentence(200 + k, 6)} {passage if k % 3 else ''}") for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup(docs, 20).collect())
    assert got == brute_substrings(texts, 20)


def test_matching_statistics_of_the_automaton():
    automaton = SuffixAutomaton()
    automaton.add(list("abcab"))
    automaton.add(list("bbca"))
    assert automaton.matching_statistics(list("xbcabba")) == [0, 1, 2, 3, 4, 2, 1]


def test_line_dedup_on_awkward_rows(rows):
    got = {(r["doc_id"], r["n_lines"], tuple(r["removed"])) for r in line_dedup(rows, tau=2, min_chars=20).collect()}
    assert (2, 1, (0,)) in got and (1, 1, ()) in got and (14, 5, (0, 1, 2, 3, 4)) in got and (-5, 2, ()) in got
    assert (8, 1, (0,)) in got and (4, 0, ()) in got and (6, 0, ()) in got and (9, 1, ()) in got and (None, 1, ()) in got


def test_line_dedup_matches_brute_force(spark):
    import random

    r = random.Random(4)
    lines = [sentence(k, 6) for k in range(30)] + ["short", "short"]

    def changed(line):
        for _ in range(r.randrange(4)):
            k = r.randrange(len(line))
            line = line[:k] + r.choice(["", "é", "xy"]) + line[k + r.randrange(2) :]
        return line

    texts = [(k, "\n".join(changed(r.choice(lines)) for _ in range(r.randrange(1, 8)))) for k in range(80)]
    places = [(d, k, line.strip(" \t\r")) for d, t in texts for k, line in enumerate(t.split("\n")) if line.strip(" \t\r")]
    at = list(range(len(places)))

    def root(k):
        while at[k] != k:
            k = at[k]
        return k

    def distance(p, t):
        row = list(range(len(p) + 1))
        for j, c in enumerate(t, 1):
            last, row[0] = row[0], j
            for i in range(1, len(p) + 1):
                last, row[i] = row[i], min(last + (p[i - 1] != c), row[i] + 1, row[i - 1] + 1)
        return row[-1]

    for x, (_, _, p) in enumerate(places):
        for y, (_, _, t) in enumerate(places[:x]):
            if p == t or (min(len(p), len(t)) >= 15 and abs(len(p) - len(t)) <= 2 and distance(p, t) <= 2):
                assert p == t or banded_distance(p, t, 2) == distance(p, t)
                at[root(x)] = root(y)
    keep = {}
    for k, (d, n, _) in enumerate(places):
        keep[root(k)] = min(keep.get(root(k), (d, n)), (d, n))
    want = defaultdict(list)
    for k, (d, n, _) in enumerate(places):
        if (d, n) != keep[root(k)]:
            want[d].append(n)
    got = line_dedup(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), tau=2, min_chars=15).collect()
    assert {r["doc_id"]: list(r["removed"]) for r in got} == {d: want[d] for d, _ in texts}
    for r_ in got:
        assert r_["kept"] == "\n".join(x for i, x in enumerate(dict(texts)[r_["doc_id"]].split("\n")) if i not in want[r_["doc_id"]])


def test_line_dedup_compares_short_lines_by_a_smaller_distance(spark):
    a, b = "Anheerat by in ofonthhahe er. Erin.", "Anheerat, by in ofonthhahe er. Erin."
    edge = "a line of thirty-nine code points, yes"
    lines = [a, b, b.replace("Erin", "Orun"), edge + "x", edge + "xy", "a line of twenty one.", "a line of twenty-one.", "nineteen characters", "nineteen_characters", "b" * 39 + "cd", "b" * 39 + "ef"]
    docs = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "doc_id long, text string")
    assert len(edge) == 38 and len(lines[7]) == 19
    assert {r["doc_id"] for r in line_dedup(docs, tau=2, min_chars=40).collect() if r["n_removed"]} == {1, 4, 6, 10}


def test_line_quality_on_awkward_rows(rows):
    got = {(r["doc_id"], r["n_words"]): r for r in line_quality(rows).collect()}
    assert got[4, 0]["base_failed"] and not got[4, 0]["kept"] and got[1, 120]["kept"] and got[14, 60]["n_dup_lines"] == 4
    assert got[14, 60]["n_repeat_words"] == 60 and not got[14, 60]["kept"] and line_quality(rows).count() == rows.count()


def test_frequent_lines_deplete_documents(spark):
    head = "Read MORE in issue 7 of our own paper today"
    texts = [(k, "s", f"{head}\n{sentence(k, 2 if k < 3 else 30)}\nshort", 1) for k in range(30)] + [(99, None, head + " " + sentence(3, 4), 1)]
    docs = spark.createDataFrame(texts, "doc_id long, source string, text string, host int")
    got = {r["doc_id"]: r for r in line_quality(docs, min_docs=20, share=0.05, left=0.5).collect()}
    assert got[5]["kept"] and got[5]["removed_words"] == 11 and not got[1]["kept"] and not got[1]["base_failed"] and got[99]["kept"]
    assert got[99]["removed_words"] == 0


def test_frequent_lines_are_taken_out_of_the_texts(spark):
    head = "Read MORE in issue 7 of our own paper today"
    other = [f"{sentence(k, 12)}\n\n{sentence(k + 50, 12)}" for k in range(30)]
    texts = [(k, "s", (f"{head}\n{body}", f"{body}\n  {head.lower()}", f"{body}\n{head}\n", f"{head}\n{head}")[k % 4]) for k, body in enumerate(other)]
    docs = spark.createDataFrame([*texts, (50, "s", head), (50, "s", head), (51, "s", None), (52, "t", head)], "doc_id long, source string, text string").repartition(3)
    got = {r["doc_id"]: r for r in line_quality(docs).collect()}
    for k, body in enumerate(other):
        assert got[k]["cleaned"] == (body, body, body + "\n", "")[k % 4], k
        assert got[k]["n_words"] - got[k]["removed_words"] == len((got[k]["cleaned"]).split())
    assert (got[50]["cleaned"], got[51]["cleaned"], got[52]["cleaned"]) == ("", None, head)


def test_source_mix_on_awkward_rows(rows):
    got = mix_sources(rows, block=7).collect()
    assert len(got) == rows.count()
    sources = defaultdict(lambda: [0, 0, 0.0])
    for r, s in zip(got, [None] * len(got)):
        assert r["taken"] <= 2 * r["size"]
    by = defaultdict(list)
    for r in mixed_pieces(rows, block=7).collect():
        sources[r["source"]][0] += r["size"]
        sources[r["source"]][1] += sum(p["words"] for p in r["pieces"] or [])
        sources[r["source"]][2] = r["target"]
        by[r["source"]] += [p["slot"] for p in r["pieces"] or []]
    total = sum(s[0] for s in sources.values())
    assert abs(sum(s[2] for s in sources.values()) - 1.5 * total) < 1e-6
    assert all(abs(s[1] - s[2]) <= 1 and s[2] <= 2 * s[0] for s in sources.values())
    assert sorted(map(tuple, mix_sources(rows, block=7).collect()), key=str) == sorted(map(tuple, got), key=str)
    mixed = mixed_documents(rows, block=7)
    assert mixed.columns == rows.columns
    assert sum(len(WORD.findall(r["text"] or "")) for r in mixed.collect()) == sum(s[1] for s in sources.values())


def test_empty_tables(none):
    assert jaccard_components(none).collect() == [] and one_of_each(none).collect() == []
    assert substring_dedup(none).collect() == [] and line_dedup(none).collect() == [] and line_quality(none).collect() == []
    assert mix_sources(none).collect() == [] and mixed_documents(none).collect() == []




def test_repeated_rows_link_no_more_than_one(spark):
    base, other = sentence(31, 40), sentence(32, 12)
    half = " ".join(base.split()[:30]) + " " + other
    docs = spark.createDataFrame([(1, base)] * 3 + [(2, half)] * 2 + [(3, half + " end")], "doc_id long, text string").repartition(3)
    assert Counter((r["doc_id"], r["component_id"]) for r in jaccard_components(docs).collect()) == Counter({(1, 1): 3, (2, 2): 2, (3, 2): 1})
