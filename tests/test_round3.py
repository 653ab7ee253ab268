"""Steps that have to follow the number of rows, not their bytes, and inputs that are folders."""

from litmine.operators.edges import edge_statements, edges_from_triples
from litmine.operators.ranges import range_overlaps
from litmine.operators.shapes import path_counts, shape_profile
from litmine.operators.triples import TRIPLE_COLUMNS, graph_difference
from litmine.functions import terms as T
from litmine.session import spread_rows
from litmine.sources.articles_xml import with_deep_text
from spark_queries.stream_queries import incremental_ingest
from spark_queries.tables import order_records
from spark_queries.xml_queries import annotated_references
from pyspark.sql import functions as F


def plan_of(df):
    return df._jdf.queryExecution().toString()


def graph(spark, rows):
    return spark.createDataFrame([(s, "iri", p, o, "iri", "", f) for s, p, o, f in rows], ", ".join(f"{c} string" for c in [*TRIPLE_COLUMNS, "source_file"]))


def tables(spark, path, n=12):
    spark.range(n).selectExpr(
        "id AS o_orderkey", "id % 3 AS o_custkey", "'F' AS o_orderstatus", "date'1995-02-03' AS o_orderdate", "'1-URGENT' AS o_orderpriority"
    ).write.parquet(f"{path}/orders.parquet")
    spark.range(3).selectExpr("id AS c_custkey", "concat('C', id) AS c_name", "0L AS c_nationkey", "'AUTO' AS c_mktsegment").write.parquet(f"{path}/customer.parquet")
    spark.range(1).selectExpr("id AS n_nationkey", "'PERU' AS n_name", "0L AS n_regionkey").write.parquet(f"{path}/nation.parquet")
    spark.range(1).selectExpr("id AS r_regionkey", "'AMERICA' AS r_name").write.parquet(f"{path}/region.parquet")
    return str(path)


def test_tasks_follow_the_number_of_rows(spark, tmp_path):
    few = spark.range(10).coalesce(1)
    assert spread_rows(few, 95, 10).rdd.getNumPartitions() == 10
    assert spread_rows(few, 10).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert order_records(spark, tables(spark, tmp_path)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_deep_text_of_unclosed_and_crossing_tags(spark):
    many = "<b>x</b>" * 50_000
    texts = {
        "<a><ArticleTitle>x <b>y</b> z": "<a><ArticleTitle>x y z",
        "<ArticleTitle>a<ArticleTitle>b</ArticleTitle>c</ArticleTitle>": "<ArticleTitle>ab</ArticleTitle>c</ArticleTitle>",
        "<AbstractText a='x>y'>1 &lt; <c>2</c><![CDATA[<b>]]></AbstractText >": "<AbstractText a='x>y'>1 &lt; 2&lt;b&gt;</AbstractText >",
        "a<ReferenceList x='1'>b</ReferenceList><ReferenceLists/><!-- c\nd -->e": "ab<ReferenceLists/>e",
        f"<ArticleTitle>{many}</ArticleTitle>{many}": "<ArticleTitle>" + "x" * 50_000 + "</ArticleTitle>" + "x" * 50_000, "": "",
    }
    got = spark.createDataFrame([(t,) for t in texts], "raw string").select("raw", with_deep_text(F.col("raw"))).collect()
    assert dict(map(tuple, got)) == texts


def test_documents_may_be_a_folder_or_a_file(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"word {k} end") for k in range(6)], "doc_id long, text string")
    docs.repartition(3).write.parquet(f"{tmp_path}/folder/documents.parquet")
    docs.toPandas().to_parquet(f"{tmp_path}/documents.parquet")
    for where in (f"{tmp_path}/folder", str(tmp_path)):
        assert sorted(map(tuple, incremental_ingest(spark, where).collect())) == [(k, 3) for k in range(6)]


def test_overlaps_send_no_blocks_to_the_driver(spark):
    ranges = spark.createDataFrame([(0, 10), (0, 10), (0, 4), (5, 6), (12, 13), (3, 3)], "from_row long, until_row long")
    found = range_overlaps(ranges)
    assert "BroadcastHashJoin" not in plan_of(found)
    assert sorted(map(tuple, found.collect())) == [(0, 4, 0, 10), (0, 10, 0, 4), (0, 10, 5, 6), (5, 6, 0, 10)]


def test_annotated_references_parse_once(spark, tmp_path):
    found = annotated_references(spark, tables(spark, tmp_path))
    assert "from_xml" not in plan_of(found) and found.count() == 12


def test_graphs_are_compared_in_one_shuffle(spark):
    left = graph(spark, [("a", "p", "x", "f"), ("a", "p", "x", "g"), ("b", "p", None, "f")])
    right = graph(spark, [("a", "p", "x", "f"), ("b", "p", None, "f"), ("c", "p", "y", "f")])
    found = graph_difference(left, right)
    assert [(r["subject"], r["side"]) for r in found.collect()] == [("c", "right")]
    assert plan_of(found).split("== Physical Plan ==")[1].split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


def test_edge_statements_hold_all_edges(spark):
    rows = [("a", T.RDF_TYPE, T.ARTICLE_CLASS, "f"), ("a", T.DCT_REFERENCES, "m", "f"), ("a", T.DCT_TITLE, "t", "f"), ("b", T.RDF_TYPE, T.AGENT_CLASS, "f"), ("b", T.DCT_REFERENCES, "m", "f")]
    kept = edge_statements(graph(spark, rows))
    assert kept.count() == 3 and list(map(tuple, edges_from_triples(kept).collect())) == [("a", "m")]


def test_counts_take_a_graph_as_a_set(spark):
    rows = [("a", T.RDF_TYPE, T.ARTICLE_CLASS, f) for f in "fg"] + [("a", T.DOI, o, f) for o in "xy" for f in "fg"] + [("b", T.RDF_TYPE, T.ARTICLE_CLASS, "f")]
    rules = spark.createDataFrame([("S", T.ARTICLE_CLASS, T.DOI, 0, 1, "Violation")], "shape string, target_class string, path string, min_count int, max_count int, severity string")
    assert list(map(tuple, path_counts(graph(spark, rows), rules).collect())) == [("S", T.DOI, 2, 0, 2, 1)]
    seen = {r["path"]: r for r in shape_profile(graph(spark, rows)).collect()}
    assert (seen[T.DOI]["min_count"], seen[T.DOI]["max_count"], seen[T.DOI]["node_kinds"]) == (0, 2, ["iri"])
