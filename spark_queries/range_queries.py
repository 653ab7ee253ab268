"""Row ranges derived from the labelled documents and from order dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from litmine.operators.ranges import bisect_ranges, islands, job_summary, range_gaps, range_overlap_counts, range_overlaps
from litmine.sources.ranges import parse_result_names
from spark_queries.tables import table


def _labelled(spark, sf_dir):
    return islands(table(spark, sf_dir, "labels").select("doc_id"), "doc_id")


def _n_rows(spark, sf_dir):
    return table(spark, sf_dir, "documents").agg(F.count("*").alias("n_rows"))


def completed_ranges(spark, sf_dir):
    """Labelled rows as ranges, written as result file names and read back."""
    names = _labelled(spark, sf_dir).select(F.concat(F.lit("result_from_"), "from_row", F.lit("_until_"), "until_row", F.lit(".tsv")).alias("file_name"))
    return parse_result_names(names)


ISLANDS = """
islands AS (
  SELECT min(doc_id) AS from_row, max(doc_id) + 1 AS until_row
  FROM (SELECT doc_id, doc_id - row_number() OVER (ORDER BY doc_id) AS g FROM (SELECT DISTINCT doc_id FROM labels)) GROUP BY g
)"""
COMPLETED_RANGES = "WITH " + ISLANDS.strip() + "\nSELECT from_row, until_row FROM islands"


def gaps(spark, sf_dir):
    return range_gaps(_labelled(spark, sf_dir), _n_rows(spark, sf_dir))


GAPS_CTE = """
missing AS (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
gaps AS (
  SELECT min(doc_id) AS from_row, max(doc_id) + 1 AS until_row
  FROM (SELECT doc_id, doc_id - row_number() OVER (ORDER BY doc_id) AS g FROM missing) GROUP BY g
)"""
GAPS = "WITH " + GAPS_CTE.strip() + "\nSELECT from_row, until_row FROM gaps"


def _spans(spark, sf_dir):
    """One range per customer, of differing length, some inside others, starts repeating."""
    k = F.col("c_custkey")
    start = (k - k % 3) * 10
    return table(spark, sf_dir, "customer").select(start.alias("from_row"), (start + F.when(k % 10 == 0, 95).otherwise(k % 12)).alias("until_row"))


SPANS = """
spans AS (
  SELECT (c_custkey - c_custkey % 3) * 10 AS from_row,
    (c_custkey - c_custkey % 3) * 10 + CASE WHEN c_custkey % 10 = 0 THEN 95 ELSE c_custkey % 12 END AS until_row FROM customer
)"""


def _span_rows(spark, sf_dir):
    return table(spark, sf_dir, "customer").agg((F.count("*") * 11).alias("n_rows"))


def nested_gaps(spark, sf_dir):
    return range_gaps(_spans(spark, sf_dir), _span_rows(spark, sf_dir))


NESTED_GAPS = "WITH " + SPANS.strip() + """,
bounds AS (SELECT * FROM spans UNION ALL SELECT 0, 0 UNION ALL SELECT count(*) * 11, count(*) * 11 FROM customer),
reached AS (SELECT from_row, max(until_row) OVER (ORDER BY from_row, until_row ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM bounds)
SELECT reach AS from_row, from_row AS until_row FROM reached WHERE reach < from_row"""


def pairwise_gaps(spark, sf_dir):
    return range_gaps(_spans(spark, sf_dir), _span_rows(spark, sf_dir), "pairwise")


PAIRWISE_GAPS = "WITH " + SPANS.strip() + """,
bounds AS (SELECT * FROM spans UNION ALL SELECT 0, 0 UNION ALL SELECT count(*) * 11, count(*) * 11 FROM customer),
previous AS (SELECT from_row, lag(until_row) OVER (ORDER BY from_row, until_row) AS reach FROM bounds)
SELECT reach AS from_row, from_row AS until_row FROM previous WHERE reach < from_row"""


def overlaps(spark, sf_dir):
    return range_overlaps(_spans(spark, sf_dir))


OVERLAPS = "WITH " + SPANS.strip() + """,
ranges AS (SELECT DISTINCT * FROM spans WHERE from_row < until_row)
SELECT a.from_row, a.until_row, b.from_row AS other_from, b.until_row AS other_until FROM ranges a JOIN ranges b
ON a.from_row < b.until_row AND b.from_row < a.until_row AND (a.from_row <> b.from_row OR a.until_row <> b.until_row)"""


def _jobs(spark, sf_dir):
    sizes = table(spark, sf_dir, "part").select(
        (F.col("p_partkey") * 1000).alias("from_row"), (F.col("p_partkey") * 1000 + F.col("p_size") * 17).alias("until_row"))
    return bisect_ranges(sizes, 100)


def job_bisect(spark, sf_dir):
    return _jobs(spark, sf_dir)


BISECT = """
jobs AS (
  SELECT p_partkey * 1000 AS s, p_partkey * 1000 + p_size * 17 AS e FROM part WHERE p_size > 0
  UNION ALL
  SELECT CASE WHEN side = 0 THEN s ELSE s + (e - s) // 2 END, CASE WHEN side = 0 THEN s + (e - s) // 2 ELSE e END
  FROM jobs, (SELECT unnest([0, 1]) AS side) WHERE e - s > 100
)"""
JOB_BISECT = "WITH RECURSIVE " + BISECT.strip() + "\nSELECT CAST(s AS BIGINT) AS from_row, CAST(e AS BIGINT) AS until_row FROM jobs WHERE e - s <= 100"


def job_totals(spark, sf_dir):
    return job_summary(_jobs(spark, sf_dir))


JOB_TOTALS = "WITH RECURSIVE " + BISECT.strip() + """
SELECT count(*) AS n_jobs, CAST(sum(e - s) AS BIGINT) AS n_rows, CAST(max(e - s) AS BIGINT) AS largest FROM jobs WHERE e - s <= 100"""

def overlap_counts(spark, sf_dir):
    return range_overlap_counts(_spans(spark, sf_dir))


OVERLAP_COUNTS = "WITH " + SPANS.strip() + """,
apart AS (SELECT DISTINCT from_row, until_row FROM spans WHERE from_row < until_row)
SELECT a.from_row, a.until_row, count(b.from_row) AS n_overlaps FROM apart AS a LEFT JOIN apart AS b
  ON a.from_row < b.until_row AND b.from_row < a.until_row AND (a.from_row <> b.from_row OR a.until_row <> b.until_row) GROUP BY 1, 2"""

QUERIES = {
    "range_overlap_counts": (overlap_counts, OVERLAP_COUNTS),
    "completed_ranges": (completed_ranges, COMPLETED_RANGES),
    "range_gaps": (gaps, GAPS),
    "range_gaps_nested": (nested_gaps, NESTED_GAPS),
    "range_gaps_pairwise": (pairwise_gaps, PAIRWISE_GAPS),
    "range_overlaps": (overlaps, OVERLAPS),
    "job_bisect": (job_bisect, JOB_BISECT),
    "job_summary": (job_totals, JOB_TOTALS),
}
