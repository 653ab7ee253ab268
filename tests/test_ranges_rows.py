import random

import pytest
from pyspark.errors import PySparkException

from litmine.operators.ranges import (
    bisect_ranges, fixed_chunks, islands, job_summary, range_gaps, range_overlaps,
)
from litmine.operators.resume import pending_inputs, restrict_to_ids
from litmine.operators.rows import persist_with_row_index, row_slice, with_row_index
from litmine.sources.ranges import parse_result_names, read_completed_ranges


def frame(spark, ranges):
    return spark.createDataFrame(ranges, "from_row long, until_row long")


def pairs(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return sorted(rows)


def pairwise_gaps(ranges, n):
    if not ranges:
        return [(0, n)] if n else []
    bounds = [(0, 0), *sorted(ranges), (n, n)]
    return sorted({(a[1], b[0]) for a, b in zip(bounds, bounds[1:]) if a[1] < b[0]})


def covered_gaps(ranges, n):
    free = sorted(set(range(n)) - {i for a, b in ranges for i in range(a, b)})
    gaps = []
    for i in free:
        if gaps and gaps[-1][1] == i:
            gaps[-1][1] = i + 1
        else:
            gaps.append([i, i + 1])
    return [tuple(g) for g in gaps]


CASES = [
    ([], 300), ([(0, 640), (640, 700)], 700), ([(10, 20)], 30), ([(0, 10)], 30), ([(10, 30)], 30),
    ([(0, 100), (10, 20), (30, 40), (150, 200)], 300), ([(5, 9), (5, 9), (5, 7)], 12), ([(0, 10)], 0),
]


@pytest.mark.parametrize("ranges,n", CASES)
def test_gaps(spark, ranges, n):
    assert pairs(range_gaps(frame(spark, ranges), n)) == covered_gaps(ranges, n)
    if n:
        assert pairs(range_gaps(frame(spark, ranges), n, "pairwise")) == pairwise_gaps(ranges, n)


def test_gap_modes_differ_on_nested_ranges(spark):
    ranges = frame(spark, [(0, 100), (10, 20), (30, 40), (150, 200)])
    assert pairs(range_gaps(ranges, 300)) == [(100, 150), (200, 300)]
    assert pairs(range_gaps(ranges, 300, "pairwise")) == [(20, 30), (40, 150), (200, 300)]


def test_ranges_over_many_buckets_and_past_the_end(spark):
    step = 2**15
    ranges = [(i * step, i * step + step - 7) for i in range(40)] + [(2**33, 2**33 + 5), (2**50, 2**50 + 9)]
    n = spark.createDataFrame([(2**40,)], "n_rows long")
    want = [(i * step + step - 7, (i + 1) * step) for i in range(39)]
    want += [(40 * step - 7, 2**33), (2**33 + 5, 2**40)]
    assert pairs(range_gaps(frame(spark, ranges), n)) == want


def test_overlaps(spark):
    rng = random.Random(7)
    ranges = [(a, a + rng.choice([0, 1, 3, 17, 200])) for a in (rng.randrange(0, 500) for _ in range(60))]
    ranges += [(0, 2**40), (2**39, 2**39 + 1), (5, 5), (6, 9), (6, 9)]
    distinct = {r for r in ranges if r[0] < r[1]}
    want = sorted((*a, *b) for a in distinct for b in distinct if a != b and a[0] < b[1] and b[0] < a[1])
    assert pairs(range_overlaps(frame(spark, ranges))) == want


def bisected(start, until, size):
    if until - start <= size:
        return [(start, until)]
    half = start + (until - start) // 2
    return bisected(start, half, size) + bisected(half, until, size)


def test_bisect(spark):
    ranges = [(0, 1101), (2000, 2500), (3000, 3501), (5000, 5003), (10**6, 10**6 + 9999)]
    for size in (1, 2, 7, 500):
        assert pairs(bisect_ranges(frame(spark, ranges), size)) == sorted(p for r in ranges for p in bisected(*r, size))
    jobs = bisect_ranges(frame(spark, [(0, 1101)]), 500)
    assert [b - a for a, b in pairs(jobs)] == [275, 275, 275, 276]
    assert tuple(job_summary(jobs).first()) == (4, 1101, 276)
    assert tuple(job_summary(bisect_ranges(frame(spark, []), 500)).first()) == (0, 0, None)


def test_chunks(spark):
    for n in (0, 3, 1003, 1199, 15000):
        for last in (1, 4, 399):
            rows = spark.createDataFrame([(n,)], "n_rows long")
            tiles = pairs(fixed_chunks(rows, last))
            assert [i for a, b in ((t[1], t[2]) for t in tiles) for i in range(a, b)] == list(range(n)) and len(tiles) == last + 1
    even = fixed_chunks(spark.createDataFrame([(1003,)], "n_rows long"), 4, mode="even")
    assert pairs(even) == [(i, i * 250, (i + 1) * 250) for i in range(5)]


def test_islands(spark):
    rows = {0, 1, 2, 5, 7, 8, 65535, 65536, 65537, 200000}
    assert pairs(islands(spark.createDataFrame([(r,) for r in rows], "r long"), "r")) == [
        (0, 3), (5, 6), (7, 9), (65535, 65538), (200000, 200001)]


def test_result_names(spark, tmp_path):
    for name in ("result_from_0_until_640.tsv", "result_from_640_until_700.tsv", "other.tsv", "result_x.txt"):
        (tmp_path / name).write_text("x")
    assert pairs(read_completed_ranges(spark, str(tmp_path))) == [(0, 640), (640, 700)]
    bad = spark.createDataFrame([("result_5.tsv",)], "file_name string")
    with pytest.raises(PySparkException, match="Unexpected result filename"):
        parse_result_names(bad).collect()


def test_row_index_follows_the_files(spark, tmp_path):
    for part in range(3):
        (tmp_path / f"part{part}.txt").write_text("".join(f"{part}-{i}-{'x' * 50}\n" for i in range(400)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        lines = spark.read.text(str(tmp_path))
        numbered = with_row_index(lines)
        assert lines.rdd.getNumPartitions() > 3
        rows = sorted((r.row_index, r.value) for r in numbered.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r[0] for r in rows] == list(range(1200))
    assert [r[1].split("-x")[0] for r in rows] == [f"{p}-{i}" for p in range(3) for i in range(400)]
    kept = persist_with_row_index(spark.read.text(str(tmp_path)), str(tmp_path / "indexed"))
    assert row_slice(kept, 399, 402).count() == 3
    assert row_slice(kept, 512, 440).count() == 0 and row_slice(kept, 15000000, 16000000).count() == 0


def test_resume(spark):
    inputs = spark.createDataFrame([("a",), ("b",), ("c",)], "f string")
    done = spark.createDataFrame([("a", 5), ("b", 0)], "f string, size int")
    assert pairs(pending_inputs(inputs, done, "f")) == [("c",)]
    assert pairs(pending_inputs(inputs, done, "f", "size")) == [("b",), ("c",)]
    assert pairs(restrict_to_ids(inputs, done, "f")) == [("a",), ("b",)]
