"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks. DataFrame operations only.

Sizes are words (``[^\\x20\\x09-\\x0D]+``; null text: 0). Sources in code point order, null last, have the
weights given, repeated. ``share`` times all words are dealt to them by weight; a target stops at ``most``
times its source's size, and the excess goes to the others by weight until none is above.

A source's documents are shuffled by a keyed hash and laid end to end, ``most`` times over, and cut into blocks
of ``block`` words. The schedule has a slot for each block: slot i takes the source in whose share of the
cumulative targets the point frac((i + 1/2) * golden ratio) falls, and its rank among the source's slots is the block.
Low discrepancy keeps each source's slots within a few of its due; the few missing ones are appended at the
end and surplus ones are dropped, and the last block of a source ends at its target. A document's ``taken`` words
are those of its blocks, at most ``most`` times its size.

Running sums are made in two steps, within buckets of the shuffled order and over the buckets, so that
a source with most of the rows is spread over tasks; slots are ranked alike. Repeated rows count as rows of their own.
Only tables of sources pass through one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

WORD = r"[^\x20\x09-\x0D]+"
GOLDEN = 11400714819323198485  # the golden ratio's fraction times 2**64
ROWS_PER_BUCKET = 4096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """One row per source of ``sizes (source, size)``: ``place``, ``source_size``, ``target``.

    The targets are the least of the cap and a common level times the weight; the level is found
    over the sources in the order in which they reach their caps.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")).cast("double")
    each = each.withColumn("place", place).withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
    order = W.orderBy(F.col("cap") / F.col("weight"), "place")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    each = each.withColumns({
        "level": (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
        "reached": F.col("cap") / F.col("weight"),
    })
    # the first source in that order whose cap lies above the level is not filled; its level holds for all after it
    free = F.min(F.when(F.col("level") <= F.col("reached"), F.struct("reached", "place", "level"))).over(everything)["level"]
    target = F.when(free.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), free * F.col("weight")))
    return each.select("source", "place", "source_size", target.alias("target"))


def running(df: DataFrame, group: str, bucket: str, value: str, order: list[str], name: str) -> DataFrame:
    """The sum of ``value`` over the rows before each row of its group, buckets in order, rows of a bucket by ``order``."""
    totals = df.groupBy(group, bucket).agg(F.sum(value).alias("_sum"))
    over = W.partitionBy(group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(group, bucket, F.coalesce(F.sum("_sum").over(over), F.lit(0).cast("long")).alias("_base"))
    within = W.partitionBy(group, bucket).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    inner = F.coalesce(F.sum(value).over(within), F.lit(0).cast("long"))
    return df.join(broadcast_if_small(totals), [group, bucket]).withColumn(name, F.col("_base") + inner).drop("_base")


def point(i: Column) -> Column:
    """frac(i * golden ratio + 1/2) in steps of 2**-52, in whole numbers (products of 26-bit halves stay within a long)."""
    step = GOLDEN >> 12  # the ratio in 52 bits
    half, low = 1 << 26, step & ((1 << 26) - 1)
    high = step >> 26
    i = i % (1 << 26) + 0 * i, F.floor(i / (1 << 26)) % (1 << 26)
    # (i0 + i1 h)(low + high h) modulo h^2, h = 2**26
    sum_ = i[0] * low + ((i[0] * high + i[1] * low) % half) * half
    return ((sum_ + (1 << 51)) % (1 << 52)) / float(1 << 52)


def schedule(targets: DataFrame, block: int, slots_per_bucket: int = 65536) -> DataFrame:
    """Rows ``place, rank, slot``: which block of which source each slot of the mixture holds."""
    spark = targets.sparkSession
    need = targets.select("place", "target", F.ceil(F.col("target") / block).cast("long").alias("need")).where("need > 0")
    total, slots = need.agg(F.sum("target"), F.sum("need")).first()
    if not slots:
        return spark.createDataFrame([], "place int, rank long, slot long")
    upper = W.orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    shares = need.select("place", "need", (F.sum("target").over(upper) / total).alias("upper"), F.col("target").alias("t"))
    shares = shares.withColumn("lower", F.coalesce(F.lag("upper").over(W.orderBy("place")), F.lit(0.0)))
    last = F.max("place").over(W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    shares = written(shares.withColumn("upper", F.when(F.col("place") == last, 2.0).otherwise(F.col("upper"))).drop("t"), "shares")
    # the share's range is found by its cell: a grid over [0, 1) meets each range in the cells it covers
    cells = max(256, 4 * shares.count())
    grid = shares.withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("lower") * cells), F.least(F.floor(F.col("upper") * cells), F.lit(cells - 1)))),
    )
    at = spark.range(slots).select(F.col("id").alias("slot"), point(F.col("id")).alias("u")).withColumn("cell", F.floor(F.col("u") * cells))
    held = at.join(broadcast_if_small(grid), "cell").where("u >= lower AND u < upper").select(
        "place", "slot", "need", F.floor(F.col("slot") / slots_per_bucket).alias("bucket"), F.lit(1).cast("long").alias("one")
    )
    ranked = written(running(held, "place", "bucket", "one", ["slot"], "rank").select("place", "need", "rank", "slot"), "slots")
    have = ranked.groupBy("place").agg(F.count(F.lit(1)).alias("have"))
    missing = need.join(have, "place", "left").withColumn("have", F.coalesce("have", F.lit(0).cast("long"))).where("have < need")
    added = missing.select("place", F.explode(F.sequence("have", F.col("need") - 1)).alias("rank")).select(
        "place", "rank", (F.lit(slots) + F.col("rank")).alias("slot")
    )
    return ranked.where("rank < need").select("place", "rank", "slot").unionByName(added)


def mixed_pieces(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2, block: int = 1024, seed: str = "mix"
) -> DataFrame:
    """Per row of ``docs``: ``key`` (a hash of the row), ``doc_id, source, size, source_size, target`` and ``pieces`` (slot, from word, words), null if none."""
    key = F.xxhash64("doc_id", "source", "text").alias("key")
    sizes = docs.select(key, "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sizes = written(sizes, "sizes")
    targets = written(source_targets(sizes, weights, share, most), "targets")
    named = broadcast_if_small(targets.withColumnRenamed("source", "of"))
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    digest = F.md5(F.concat(F.lit(f"{seed} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    count = sizes.count()
    buckets = max(1, count // ROWS_PER_BUCKET)
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    rows = rows.withColumns({"order": digest, "bucket": F.floor(head * buckets / (1 << 32))})
    rows = written(running(rows, "place", "bucket", "size", ["order", "doc_id", "size"], "start"), "placed")
    # each pass over the source lays the document down once more; it is cut where blocks end and where the target ends
    end = F.floor(F.col("target") + 0.5).cast("long")
    laid = rows.where("size > 0").withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn(
        "from", F.col("pass") * F.col("source_size") + F.col("start")
    ).withColumn("to", F.least(F.col("from") + F.col("size"), end)).where("from < to")
    cut = laid.withColumn("rank", F.explode(F.sequence(F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block))))
    begin, stop = F.greatest(F.col("from"), F.col("rank") * block), F.least(F.col("to"), (F.col("rank") + 1) * block)
    cut = cut.withColumns({"begin": begin - F.col("from"), "words": stop - begin})
    taken = cut.join(schedule(targets, block), ["place", "rank"])
    key = ["place", "start", "doc_id", "size"]
    pieces = taken.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("slot", "pass", "begin", "words"))).alias("pieces"))
    pieces = pieces.select(*[F.col(c).alias(f"_{c}") for c in key], "pieces")
    same = (F.col("place") == F.col("_place")) & (F.col("start") == F.col("_start")) & (F.col("size") == F.col("_size"))
    same = same & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
    return rows.join(pieces, same, "left").select("key", "start", "doc_id", "source", "size", "source_size", "target", "pieces")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken``."""
    words = F.aggregate(F.coalesce("pieces", F.expr("array()")), F.lit(0).cast("long"), lambda total, p: total + p["words"])
    return mixed_pieces(docs, **options).select("doc_id", "size", "source_size", "target", words.alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture as rows of ``docs``: one for each pass that takes words of it, with the words that the pass takes.

    A document that is taken as a whole keeps its text; only where a source's target ends is one cut, to its first words
    with single spaces, and ``n_chars`` of such a row counts anew if there is that column. Columns stay.
    """
    pieces = mixed_pieces(docs, **options).select("key", "start", "size", F.explode("pieces").alias("p"))
    takes = pieces.groupBy("key", "start", "size", "p.pass").agg(F.sum("p.words").alias("words"))
    takes = takes.groupBy(F.col("key").alias("_key")).agg(F.sort_array(F.collect_list("words"), asc=False).alias("_takes"), F.max("size").alias("_size"))
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "source", "text"))
    rows = keyed.join(takes, "_key").dropDuplicates(["_key"]).withColumn("_words", F.explode("_takes"))
    cut = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), 1, F.col("_words").cast("int")), " ")
    whole = F.col("_words") >= F.col("_size")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length(cut).cast(dict(docs.dtypes)["n_chars"])))
    return rows.withColumn("text", F.when(whole, F.col("text")).otherwise(cut)).select(*docs.columns)
