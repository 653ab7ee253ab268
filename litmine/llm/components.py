"""Connected components of links, and clusters of rows that share keys, without all pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from litmine.session import written


def connected(links: DataFrame) -> DataFrame:
    """The smallest id reachable from each id of ``links (a, b)``: columns ``id``, ``label``.

    Large-star and small-star steps in turn hang every node on the smallest neighbour
    until nothing changes. Every step is written, so a lost executor repeats one step.
    """
    edges = written(
        links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        edges = written(small.select(F.col("e.u").alias("u"), F.col("e.m").alias("v")).where("u != v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("label"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("label")).unionByName(roots)


def cluster(keys: DataFrame, verify: Callable[[DataFrame], DataFrame], near: Callable | None = None) -> DataFrame:
    """Components of the rows that ``verify`` links, among rows that share a key.

    ``keys (k, id, size, missed, score, lead)``: a pair is to be tried if both share a ``k`` and one
    of them leads there. ``near(size, missed, size, missed)`` may rule a pair out at one key, but not at all keys of a linked pair. ``verify(pairs (a, b))``
    returns the linked ones. Which rows are connected comes out exactly, but not every pair
    is looked at: members of a key are first tried against its best-scored leading row, and
    further pairs only while their ends lie in different components. Columns ``id``, ``label``
    of the rows that have a link.
    """
    near = near or (lambda *_: F.lit(True))
    shared = keys.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("lead"), F.struct("score", "id", "size", "missed"))).alias("p")
    ).where("n > 1 AND p IS NOT NULL")
    pivots = written(shared.select("k", F.col("p.id").alias("pivot"), F.col("p.size").alias("pivot_size"), F.col("p.missed").alias("pivot_missed")), "pivots")
    members = written(keys.join(pivots.select("k"), "k"), "members")
    pair = [F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")]
    star = written(
        members.join(pivots, "k").where((F.col("id") != F.col("pivot")) & near(F.col("size"), F.col("missed"), F.col("pivot_size"), F.col("pivot_missed")))
        .groupBy("id", "pivot").agg(F.count(F.lit(1)).alias("n")), "star",
    )
    first = star.groupBy("id").agg(F.max(F.struct("n", "pivot")).alias("p")).select("id", "p.pivot").select(*pair).distinct()
    tried = written(first, "tried")
    links = written(verify(tried), "linked")
    labels = connected(links)

    def label_of(frame: DataFrame, column: str, name: str) -> DataFrame:
        of = labels.select(F.col("id").alias(column), F.col("label").alias(name))
        return frame.join(of, column, "left").withColumn(name, F.coalesce(name, column))

    apart = label_of(label_of(star.select("id", "pivot"), "id", "x"), "pivot", "y").where("x != y")
    second = written(apart.select(*pair).distinct().join(tried, ["a", "b"], "left_anti"), "tried")
    if not second.isEmpty():
        links = links.unionByName(written(verify(second), "linked"))
        tried = tried.unionByName(second)
        labels = connected(links)
    marked = label_of(members, "id", "x")
    open_keys = marked.groupBy("k").agg(F.min("x").alias("x"), F.max("x").alias("y")).where("x != y").select("k")
    rest = written(marked.join(open_keys, "k", "left_semi"), "open")
    left = rest.select("k", F.col("id").alias("a"), F.col("x").alias("xa"), F.col("size").alias("sa"), F.col("missed").alias("ma"), F.col("lead").alias("la"))
    right = rest.select("k", F.col("id").alias("b"), F.col("x").alias("xb"), F.col("size").alias("sb"), F.col("missed").alias("mb"), F.col("lead").alias("lb"))
    third = (
        left.join(right, "k").where((F.col("a") < F.col("b")) & (F.col("xa") != F.col("xb")) & (F.col("la") | F.col("lb")))
        .where(near(F.col("sa"), F.col("ma"), F.col("sb"), F.col("mb"))).select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    )
    third = written(third, "tried")
    if not third.isEmpty():
        links = links.unionByName(written(verify(third), "linked"))
        labels = connected(links)
    return labels
