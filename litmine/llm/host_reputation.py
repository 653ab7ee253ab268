"""URL rules, and empirical-Bayes host reputation where no rule fits.

Labelled page outcomes (bad or not) are summed per host, registered domain and suffix. Each level's
prior is a beta distribution around the posterior mean of the level above, the suffixes' around the
overall rate; its weight (prior number of pages) is estimated per level from the spread of the
rates of the level's members about that mean, by moments of the beta-binomial. A host is blocked if the lower
bound of its bad rate, ``z`` posterior standard deviations below its mean, exceeds ``limit``. A host without
labelled pages has the posterior of the nearest level that has some.

The registered domain is the last ``len(suffix) + 1`` labels of the host and the suffix its last label, or the last
two if they are in ``long_suffixes``. An explicit rule (host, path, verdict) fits its host and all subdomains
if the path starts with the rule's; the longest one wins over the method.

Sums are pre-aggregated per host, so a host with a third of all pages is one row. A url without
``://`` or null has an empty host and path, no rule fits it, and its verdict is that of the overall rate.
Repeated rows are judged alike; outcomes with a null value are left out. Other columns are only dropped.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ("host", "domain", "suffix")


def url_parts(url: Column) -> dict[str, Column]:
    """``host`` and ``path``: after the first ``://`` up to ``/``, ``?``, ``#`` or end; then up to ``?``, ``#`` or end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url"))).otherwise("")
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return {"host": F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")), "path": F.coalesce(path, F.lit(""))}


def host_levels(host: Column, long_suffixes: Iterable[str] = ()) -> dict[str, Column]:
    labels = F.split(host, r"\.")
    two = F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2))
    width = F.when(two.isin(list(long_suffixes)), 2).otherwise(1)
    last = lambda n: F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n))
    return {"suffix": last(width), "domain": last(width + 1)}


def rule_columns(rules: Iterable[tuple[str, str, str]]) -> dict[str, Column]:
    """``rule`` and its ``rule_verdict`` of the longest rule that fits ``host`` and ``path``; null if none does."""
    best_rule, best = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):  # longer ones come later and win
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(path)
        best_rule, best = F.when(fits, host + path).otherwise(best_rule), F.when(fits, verdict).otherwise(best)
    return {"rule": best_rule, "rule_verdict": best}


def reputation(outcomes: DataFrame, z: float = 2.0) -> DataFrame:
    """Posterior of the bad rate for each host of ``outcomes (host, domain, suffix, bad)``: ``mean``, ``bound``, ``pages``.

    Rows with null ``host`` are the posteriors of domains, with null ``domain`` too of suffixes, and one with
    all null is the overall rate.
    """
    counts = written(
        outcomes.where("bad IS NOT NULL").groupBy(*LEVELS).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("k")),
        "outcomes",
    )
    n, k = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    overall = (k + 1) / (n + 2)
    spread = (overall * (1 - overall) / (n + 3)) ** 0.5
    spark = outcomes.sparkSession
    out = [spark.createDataFrame([(None, None, None, float(overall), float(overall - z * spread), int(n))],
                                 "host string, domain string, suffix string, mean double, bound double, pages long")]
    above = None
    for depth, keys in enumerate((["suffix"], ["suffix", "domain"], ["suffix", "domain", "host"])):
        level = counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        level = level.withColumn("prior", F.lit(float(overall))) if above is None else level.join(above, keys[:-1])
        level = written(level, "level")
        # moments of the beta-binomial: E[(k - n p)^2] = n p (1 - p) (1 + (n - 1) rho), summed over all members
        variance = F.col("n") * F.col("prior") * (1 - F.col("prior"))
        square, plain, pairs = level.agg(
            F.sum(F.pow(F.col("k") - F.col("n") * F.col("prior"), 2)), F.sum(variance), F.sum(variance * (F.col("n") - 1))
        ).first()
        rho = min(max(((square or 0) - (plain or 0)) / pairs, 1e-3), 0.9) if pairs else 0.5
        weight = (1 - rho) / rho
        total = F.col("n") + weight
        mean = (F.col("k") + weight * F.col("prior")) / total
        level = level.withColumn("mean", mean)
        bound = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
        names = [F.col(x) if x in keys else F.lit(None).cast("string").alias(x) for x in LEVELS]
        out.append(level.select(*names, "mean", bound.alias("bound"), F.col("n").alias("pages")))
        above = level.select(*keys, F.col("mean").alias("prior"))
    return reduce(DataFrame.unionByName, out)


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Iterable[tuple[str, str, str]], limit: float = 0.25, z: float = 2.0,
    long_suffixes: Iterable[str] = (),
) -> DataFrame:
    """``pages (page_id, url)`` with ``host``, ``path``, ``rule``, ``verdict``, ``bad_rate`` and its ``bound``.

    ``outcomes (url, bad)`` are the labelled pages.
    """
    def parts(df: DataFrame) -> DataFrame:
        df = df.withColumns(url_parts(F.col("url")))
        return df.withColumns(host_levels(F.col("host"), long_suffixes))

    known = written(reputation(parts(outcomes.select("url", "bad")), z), "reputation")
    judged = parts(pages.select("page_id", "url"))
    base = known.where("suffix IS NULL").select("mean", "bound").first()
    for column, where in (("host", "host IS NOT NULL"), ("domain", "host IS NULL AND domain IS NOT NULL"), ("suffix", "domain IS NULL AND suffix IS NOT NULL")):
        level = known.where(where).select(column, F.struct("mean", "bound").alias(f"{column}_found"))
        judged = judged.join(broadcast_if_small(level.select(column, f"{column}_found.mean", f"{column}_found.bound")
                                                .toDF(column, f"{column}_mean", f"{column}_bound")), column, "left")
    rate = F.coalesce("host_mean", "domain_mean", "suffix_mean", F.lit(base["mean"]))
    bound = F.coalesce("host_bound", "domain_bound", "suffix_bound", F.lit(base["bound"]))
    judged = judged.withColumns(rule_columns(rules))
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(bound > limit, "block").otherwise("allow")).alias("verdict"),
        rate.alias("bad_rate"), bound.alias("bound"),
    )
