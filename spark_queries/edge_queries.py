"""Edges and the two questions asked of them; resume and id joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from litmine.functions import terms as T
from litmine.operators.edges import both_referenced, count_articles_per_term, edges_from_triples
from litmine.operators.resume import pending_inputs, restrict_to_ids
from litmine.sources.cord import select_by_ids
from spark_queries.tables import table


def line_edges(spark, sf_dir):
    """Order lines as edges: an order is an article, a part is a term."""
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.col("l_orderkey").cast("string").alias("article"), F.col("l_partkey").cast("string").alias("term"))


def count_term(spark, sf_dir):
    return count_articles_per_term(line_edges(spark, sf_dir)).select("term", "n_articles")


COUNT_TERM = "SELECT CAST(l_partkey AS VARCHAR) AS term, count(DISTINCT l_orderkey) AS n_articles FROM lineitem GROUP BY 1"


def count_one_term(spark, sf_dir):
    return count_articles_per_term(line_edges(spark, sf_dir), "7")


COUNT_ONE_TERM = "SELECT count(DISTINCT l_orderkey) AS n_articles FROM lineitem WHERE l_partkey = 7"


def both(spark, sf_dir):
    """Orders served by both of two suppliers (suppliers are the terms here)."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("article"), F.col("l_suppkey").cast("string").alias("term"))
    return both_referenced(lines, "1", "2")


BOTH = """
SELECT CAST(l_orderkey AS VARCHAR) AS article FROM lineitem WHERE l_suppkey = 1
INTERSECT SELECT CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_suppkey = 2"""


def both_same(spark, sf_dir):
    return both_referenced(line_edges(spark, sf_dir), "7", "7")


BOTH_SAME = "SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS article FROM lineitem WHERE l_partkey = 7"


def edges_distinct(spark, sf_dir):
    """Edges out of a triple table in which only some subjects are articles."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("subject"), F.lit(T.RDF_TYPE).alias("predicate"),
        F.when(F.col("o_orderstatus") == "F", T.ARTICLE_CLASS).otherwise(T.AGENT_CLASS).alias("object"))
    references = line_edges(spark, sf_dir).select(
        F.col("article").alias("subject"), F.lit(T.DCT_REFERENCES).alias("predicate"), F.col("term").alias("object"))
    return edges_from_triples(orders.unionByName(references))


EDGES_DISTINCT = """
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS article, CAST(l_partkey AS VARCHAR) AS term
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'"""


def edge_lines(spark, sf_dir):
    return edges_distinct(spark, sf_dir).select(F.concat_ws("\t", "article", "term").alias("value"))


EDGE_LINES = f"SELECT article || chr(9) || term AS value FROM ({EDGES_DISTINCT})"


def resume_anti_join(spark, sf_dir):
    done = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return pending_inputs(table(spark, sf_dir, "documents").select("doc_id"), done, "doc_id", "quality")


RESUME_ANTI_JOIN = "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality > 0)"


def id_set_semi_join(spark, sf_dir):
    return restrict_to_ids(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), table(spark, sf_dir, "labels"), "doc_id")


ID_SET_SEMI_JOIN = "SELECT doc_id, n_chars FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"


def files_by_id(spark, sf_dir):
    """File names chosen by SHA or by PMC id."""
    docs = table(spark, sf_dir, "documents")
    name = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("PMC"), "doc_id", F.lit(".xml.json"))).otherwise(
        F.concat(F.lit("Sha"), "doc_id", F.lit(".json")))
    labels = table(spark, sf_dir, "labels")
    pmcids = labels.where("toxic = 0").select(F.concat(F.lit("pmc"), "doc_id").alias("pmcid"))
    shas = labels.where("quality = 1").select(F.concat(F.lit("SHA"), "doc_id").alias("sha"))
    return select_by_ids(docs.select("doc_id", name.alias("file_name")), shas, pmcids)


FILES_BY_ID = """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'PMC' || doc_id || '.xml.json' ELSE 'Sha' || doc_id || '.json' END AS file_name
FROM documents JOIN labels USING (doc_id) WHERE (doc_id % 2 = 0 AND toxic = 0) OR (doc_id % 2 = 1 AND quality = 1)"""

QUERIES = {
    "count_term": (count_term, COUNT_TERM),
    "count_one_term": (count_one_term, COUNT_ONE_TERM),
    "both_referenced": (both, BOTH),
    "both_referenced_same_term": (both_same, BOTH_SAME),
    "edges_distinct": (edges_distinct, EDGES_DISTINCT),
    "edge_lines": (edge_lines, EDGE_LINES),
    "resume_anti_join": (resume_anti_join, RESUME_ANTI_JOIN),
    "id_set_semi_join": (id_set_semi_join, ID_SET_SEMI_JOIN),
    "files_by_id": (files_by_id, FILES_BY_ID),
}
