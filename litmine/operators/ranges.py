"""Row ranges: gaps, overlaps, splitting into jobs.

Ranges are half-open, ``[from_row, until_row)``. Nothing here sorts all
ranges in one task: running maxima go through a hierarchy of buckets of at
most 65536 keys, and overlap pairs come from an equi-join on dyadic blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from litmine.session import written

BUCKET_BITS = 16


def _largest(keyed: DataFrame, key: str) -> int:
    return keyed.agg(F.max(key)).first()[0] or 0


def _running_before(keyed: DataFrame, key: str, value: str, out: str, largest: int) -> DataFrame:
    """Add the maximum of ``value`` over all smaller keys (NULL for the first).

    ``keyed`` has one row per key, keys lie in ``[0, largest]``. Every window
    partition is one bucket of 2^16 keys; a bucket's carry-in is the running
    maximum of the buckets before it, found the same way one level up, until
    one bucket is left.
    """
    def up(df: DataFrame, top: int, column: str) -> DataFrame:
        bucket = F.shiftright(F.col("_k"), BUCKET_BITS).alias("_b")
        before = Window.partitionBy("_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
        local = df.select("*", bucket).withColumn("_in", F.max(column).over(before))
        if top >> BUCKET_BITS == 0:
            return local.withColumn(out, F.col("_in")).drop("_in", "_b")
        totals = df.groupBy(bucket.alias("_k")).agg(F.max(column).alias("_m"))
        carry = up(totals, top >> BUCKET_BITS, "_m").select(F.col("_k").alias("_b"), F.col(out).alias("_carry"))
        return local.join(carry, "_b").withColumn(out, F.greatest("_in", "_carry")).drop("_in", "_carry", "_b")

    return up(keyed.withColumn("_k", F.col(key)), largest, value).drop("_k")


def _total_before(keyed: DataFrame, key: str, values: list[str], largest: int) -> DataFrame:
    """Add ``<value>_before``, the sum of each value over all smaller keys, by the same buckets."""
    def up(df: DataFrame, top: int) -> DataFrame:
        bucket = F.shiftright(F.col("_k"), BUCKET_BITS).alias("_b")
        before = Window.partitionBy("_b").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast("long")
        local = df.select("*", bucket).withColumns({f"{v}_before": F.coalesce(F.sum(v).over(before), zero) for v in values})
        if top >> BUCKET_BITS == 0:
            return local.drop("_b")
        totals = df.groupBy(bucket.alias("_k")).agg(*[F.sum(v).alias(v) for v in values])
        carry = up(totals, top >> BUCKET_BITS).select(F.col("_k").alias("_b"), *[F.col(f"{v}_before").alias(f"_{v}") for v in values])
        added = local.join(carry, "_b").withColumns({f"{v}_before": F.col(f"{v}_before") + F.col(f"_{v}") for v in values})
        return added.drop("_b", *[f"_{v}" for v in values])

    return up(keyed.withColumn("_k", F.col(key)), largest).drop("_k")


def _next_key(keyed: DataFrame, key: str, out: str, largest: int) -> DataFrame:
    """Add the next larger key (NULL for the last); as above, from the other end."""
    mirrored = keyed.withColumn("_mirror", F.lit(largest).cast("long") - F.col(key)).withColumn("_negative", -F.col(key))
    nearest = _running_before(mirrored, "_mirror", "_negative", "_nearest", largest)
    return nearest.withColumn(out, -F.col("_nearest")).drop("_mirror", "_negative", "_nearest")


def range_gaps(ranges: DataFrame, n_rows: int | DataFrame, mode: str = "covered") -> DataFrame:
    """Ranges of ``[0, n_rows)`` still to be processed.

    ``n_rows`` is a number, or a one-row table with a column of that name.
    ``covered`` measures from the furthest row any earlier range reaches.
    ``pairwise`` measures from the end of the range just before, as the
    pairwise definition does, and so reports false gaps after nested ranges.
    """
    spark = ranges.sparkSession
    total = n_rows if isinstance(n_rows, DataFrame) else spark.range(1).select(F.lit(n_rows).alias("n_rows"))
    bounds = spark.range(1).select(F.lit(0).cast("long").alias("from_row"), F.lit(0).cast("long").alias("until_row"))
    # The end marker reaches for ever, so ranges past the end open no gap.
    tail = total.select(F.col("n_rows").cast("long").alias("from_row"), F.lit(2**63 - 1).alias("until_row"))
    longs = ranges.select(F.col("from_row").cast("long"), F.col("until_row").cast("long"))
    starts = longs.unionByName(bounds).unionByName(tail)
    if mode == "covered":
        # One row per start is enough: only how far its ranges reach matters.
        keyed = written(starts.groupBy("from_row").agg(F.max("until_row").alias("until_row")), "starts")
        reached = _running_before(keyed, "from_row", "until_row", "_reach", _largest(keyed, "from_row"))
        gaps = reached.select(F.coalesce("_reach", F.lit(0).cast("long")).alias("from_row"), F.col("from_row").alias("until_row"))
    else:
        # Ranges with the same start leave no gap between them; the last one
        # of a start, which reaches furthest, is followed by the next start.
        keyed = written(starts.groupBy("from_row").agg(F.max("until_row").alias("_last")), "starts")
        following = _next_key(keyed, "from_row", "_next", _largest(keyed, "from_row"))
        gaps = following.where(F.col("_next").isNotNull()).select(
            F.col("_last").alias("from_row"), F.col("_next").alias("until_row")
        )
    return gaps.where(F.col("from_row") < F.col("until_row"))


def _dyadic_blocks(start: Column, until: Column) -> Column:
    """The disjoint aligned blocks ``(level, block)`` of size 2^level that tile ``[start, until)``."""
    levels = F.sequence(F.lit(0), F.lit(62))

    def blocks(level: Column) -> Column:
        size = F.call_function("shiftleft", F.lit(1).cast("long"), level)
        left = F.call_function("shiftright", start + (size - 1), level)
        right = F.call_function("shiftright", until, level)
        take_left = (left < right) & (left % 2 == 1)
        take_right = (left < right) & (right % 2 == 1)
        block = lambda b: F.struct(level.alias("level"), b.alias("block"))
        return F.array(F.when(take_left, block(left)), F.when(take_right, block(right - 1)))

    return F.filter(F.flatten(F.transform(levels, blocks)), lambda b: b.isNotNull())


def range_overlaps(ranges: DataFrame) -> DataFrame:
    """All ordered pairs of distinct, non-empty ranges that share a row.

    Two ranges overlap if one starts inside the other. "Start inside range" is
    an equi-join: a range is tiled by at most two aligned blocks per level,
    and a start lies in exactly one block of each level, so every pair is
    produced once and nothing is produced in vain.
    """
    distinct = written(
        ranges.select(F.col("from_row").cast("long"), F.col("until_row").cast("long")).where("from_row < until_row").distinct(), "ranges")
    tiled = distinct.select(
        "from_row", "until_row", F.inline(_dyadic_blocks(F.col("from_row"), F.col("until_row")))
    )
    used = tiled.agg(F.collect_set("level"))  # at most 63 small integers
    starts = distinct.select(
        F.col("from_row").alias("other_from"), F.col("until_row").alias("other_until"), used.scalar().alias("_levels")
    ).select("other_from", "other_until", F.explode("_levels").alias("level"))
    starts = starts.select("*", F.expr("shiftright(other_from, level)").alias("block"))
    # Blocks and levels multiply the rows, which the planner does not see: by the ranges' bytes it would send them to the driver.
    inside = tiled.join(starts.hint("merge"), ["level", "block"]).where("other_from > from_row OR (other_from = from_row AND other_until <> until_row)")
    found, other = ["from_row", "until_row"], ["other_from", "other_until"]
    columns = [*found, *other]
    pair = F.struct(*columns)
    mirrored = F.struct(*[F.col(c).alias(to) for c, to in zip([*other, *found], columns)])
    both = F.when(F.col("other_from") > F.col("from_row"), F.array(pair, mirrored)).otherwise(F.array(pair))
    return inside.select(F.inline(both))


def range_overlap_counts(ranges: DataFrame) -> DataFrame:
    """``(from_row, until_row, n_overlaps)``: with how many other distinct, non-empty ranges each one shares a row.

    Those that start before its end, without those that end at or before its start and without itself. Both are sums over the
    distinct bounds, so a million ranges inside each other cost a million rows, and no pair is made.
    """
    distinct = written(
        ranges.select(F.col("from_row").cast("long"), F.col("until_row").cast("long")).where("from_row < until_row").distinct(), "ranges")
    bounds = distinct.select(F.inline(F.array(
        F.struct(F.col("from_row").alias("at"), F.lit(1).cast("long").alias("starts"), F.lit(0).cast("long").alias("ends")),
        F.struct(F.col("until_row").alias("at"), F.lit(0).cast("long").alias("starts"), F.lit(1).cast("long").alias("ends")),
    ))).groupBy("at").agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    keyed = written(bounds, "bounds")
    placed = written(_total_before(keyed, "at", ["starts", "ends"], _largest(keyed, "at")), "placed")
    started = placed.select(F.col("at").alias("until_row"), F.col("starts_before").alias("_started"))
    ended = placed.select(F.col("at").alias("from_row"), (F.col("ends_before") + F.col("ends")).alias("_ended"))
    counted = distinct.join(started, "until_row").join(ended, "from_row")
    return counted.select("from_row", "until_row", (F.col("_started") - F.col("_ended") - 1).alias("n_overlaps"))


def bisect_ranges(ranges: DataFrame, job_size: int) -> DataFrame:
    """Halve each range until no piece is longer than ``job_size``.

    A piece is named by its path of halvings. All paths of the depth a range
    may need are generated, and each is followed on its own, so no step waits
    for another; a path that stops early is kept once (its remaining turns
    are all to the left).
    """
    length = F.col("until_row") - F.col("from_row")
    depth = F.greatest(F.ceil(F.log2(length / F.lit(float(job_size)))).cast("int"), F.lit(0)) + 1
    sized = ranges.select(F.col("from_row").cast("long"), F.col("until_row").cast("long")).where("from_row < until_row")
    sized = sized.withColumn("_depth", depth).withColumn("_coarse", F.greatest(F.col("_depth") - 12, F.lit(0)))
    # Two generators keep each array short; the first one's rows are spread over the tasks.
    coarse = sized.withColumn("_high", F.explode(F.expr("sequence(0L, shiftleft(1L, _coarse) - 1)")))
    # The rows are few but each stands for thousands of pieces, so their number of partitions is given, not left to their bytes.
    coarse = coarse.repartition(int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions")), "from_row", "_high")
    fine = coarse.withColumn("_low", F.explode(F.expr("sequence(0L, shiftleft(1L, _depth - _coarse) - 1)")))
    path = fine.withColumn("_path", F.expr("shiftleft(_high, _depth - _coarse) + _low"))

    def turn(piece: Column, step: Column) -> Column:
        right = F.call_function("shiftright", F.col("_path"), step) % 2 == 1
        half = F.floor(piece["size"] / 2).cast("long")
        split = piece["size"] > job_size
        return F.struct(
            F.when(split & right, piece["start"] + half).otherwise(piece["start"]).alias("start"),
            F.when(split, F.when(right, piece["size"] - half).otherwise(half)).otherwise(piece["size"]).alias("size"),
            (piece["keep"] & (split | ~right)).alias("keep"),
        )

    whole = F.struct(
        F.col("from_row").alias("start"), (F.col("until_row") - F.col("from_row")).alias("size"), F.lit(True).alias("keep")
    )
    steps = F.sequence(F.col("_depth") - 1, F.lit(0), F.lit(-1))
    pieces = path.select(F.aggregate(steps, whole, turn).alias("_p")).where("_p.keep")
    return pieces.select(F.col("_p.start").alias("from_row"), (F.col("_p.start") + F.col("_p.size")).alias("until_row"))


def job_summary(jobs: DataFrame) -> DataFrame:
    """How many jobs there are, and their rows in total and at most."""
    size = F.col("until_row") - F.col("from_row")
    return jobs.agg(
        F.count("*").alias("n_jobs"), F.coalesce(F.sum(size), F.lit(0)).alias("n_rows"), F.max(size).alias("largest")
    )


def fixed_chunks(n_rows: DataFrame, max_task: int, mode: str = "cover") -> DataFrame:
    """``(task, from_row, until_row)`` for tasks ``0 .. max_task`` of ``n_rows // max_task`` rows each.

    ``n_rows`` is a one-row table with a column of that name. The tasks tile all rows: the last one
    reaches the end, and none goes beyond it. ``mode="even"`` gives every task the same
    number of rows, which leaves a rest to the gap planner or runs past the end.
    """
    even = mode == "even"
    chunk = F.expr(f"n_rows div {int(max_task)}")
    chunk = chunk if even else F.greatest(chunk, F.lit(1).cast("long"))
    tasks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max_task).cast("long")))
    sized = n_rows.select("n_rows", chunk.alias("_chunk"), tasks.alias("task"))
    start, end = F.col("task") * F.col("_chunk"), (F.col("task") + 1) * F.col("_chunk")
    if not even:
        start, end = F.least(start, "n_rows"), F.when(F.col("task") == max_task, F.col("n_rows")).otherwise(F.least(end, "n_rows"))
    return sized.select("task", start.alias("from_row"), end.alias("until_row"))


def islands(rows: DataFrame, key: str) -> DataFrame:
    """The completed ranges that a set of distinct row numbers forms."""
    keyed = written(rows.select(F.col(key).cast("long").alias("_row")).distinct(), "rows")
    largest = _largest(keyed, "_row")
    before = _running_before(keyed, "_row", "_row", "_previous", largest)
    after = _next_key(keyed, "_row", "_following", largest)
    starts = before.where(F.col("_previous").isNull() | (F.col("_previous") < F.col("_row") - 1)).select(F.col("_row").alias("from_row"))
    ends = after.where(F.col("_following").isNull() | (F.col("_following") > F.col("_row") + 1)).select((F.col("_row") + 1).alias("until_row"))
    # The end of an island is the first end after its start.
    marks = starts.select(F.col("from_row").alias("_at"), F.lit(True).alias("_is_start")).unionByName(
        ends.select(F.col("until_row").alias("_at"), F.lit(False).alias("_is_start"))
    )
    placed = _next_key(written(marks, "marks"), "_at", "_until", largest + 1)
    return placed.where("_is_start").select(F.col("_at").alias("from_row"), F.col("_until").alias("until_row"))
