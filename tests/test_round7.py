"""Whole results and rewritten steps of the seventh round."""

import datetime

import pytest
from pyspark.sql.functions import spark_partition_id

from litmine.functions import terms as T
from litmine.operators.triples import TRIPLE_COLUMNS, graph_difference
from litmine.sources.sinks import clustered, write_ntriples, write_triples
from litmine.sources.triples import parse_ntriples, read_ntriples
from spark_queries.xml_queries import AUTHOR_LIST_ORDER, author_list_order


def _few_orders(spark, at, customers):
    """Four orders of the customers, which share one key; written as the driver's tables."""
    day = datetime.datetime(1995, 3, 7)
    spark.createDataFrame(
        [(k, 3, status, day, "1-URGENT") for k, status in ((1, "O"), (2, "F"), (3, "O"), (7, "P"))],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{at}/orders.parquet")
    spark.createDataFrame([(3, name, 1, "BUILDING") for name in customers], "c_custkey long, c_name string, c_nationkey long, c_mktsegment string").write.parquet(f"{at}/customer.parquet")
    spark.createDataFrame([(1, "PERU", 1)], "n_nationkey long, n_name string, n_regionkey long").write.parquet(f"{at}/nation.parquet")
    spark.createDataFrame([(1, "AMERICA")], "r_regionkey long, r_name string").write.parquet(f"{at}/region.parquet")


def _by_sql(at, sql):
    import duckdb

    with duckdb.connect() as db:
        for name in ("orders", "customer", "nation", "region"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet/*.parquet'")
        return sorted(db.execute(sql).fetchall(), key=str)


def test_an_orcid_brings_all_its_names_along(spark, tmp_path):
    _few_orders(spark, tmp_path, ["Ann Smith", "A. Smith"])
    found = author_list_order(spark, str(tmp_path))
    rows = sorted((tuple(r) for r in found.select("article", "position", "name").collect()), key=str)
    # Order 3 has one author: each of its two records has both names; the SQL is one row per record, the graph a set.
    assert {r for r in rows if r[0].endswith("/3")} == {(rows[0][0][:-1] + "3", 0, "BUILDING A. Smith"), (rows[0][0][:-1] + "3", 0, "BUILDING Ann Smith")}
    assert set(rows) == set(_by_sql(tmp_path, AUTHOR_LIST_ORDER))


ODD_LINES = [
    '<http://a/1> <http://p> "one\\ttwo \\u00e9 \\U0001F600 \\"q\\""@EN-gb . # said', '<http://a/1> <http://p> <http://o> .', "_:b1 <http://p> _:b2 .",
    "  _:b1\t<http://p>  \"5\"^^<http://t> .  ", '<http://a/2> <http://p> "a \x01 mark" .', "# nothing", "   ", '<a\x01b> <p> <o> .', '<> <> "" .', "_:x> <p> _:y> .",
    '<a> <p> "$1 \\\\ $2" .',
]


def test_lines_are_taken_apart_by_one_match(spark):
    lines = spark.createDataFrame([(i, x) for i, x in enumerate(ODD_LINES)], "n int, value string")
    found = {r.n: tuple(r)[:6] for r in parse_ntriples(lines).collect()}
    string, tag = T.XSD_STRING, T.LANGUAGE_PREFIX
    assert found == {
        0: ("http://a/1", "iri", "http://p", 'one\ttwo é \U0001F600 "q"', "literal", tag + "en-gb"), 1: ("http://a/1", "iri", "http://p", "http://o", "iri", ""),
        2: ("_:b1", "blank", "http://p", "_:b2", "blank", ""), 3: ("_:b1", "blank", "http://p", "5", "literal", "http://t"),
        4: ("http://a/2", "iri", "http://p", "a \x01 mark", "literal", string), 7: ("a\x01b", "iri", "p", "o", "iri", ""), 8: ("", "iri", "", "", "literal", string),
        9: ("_:x", "blank", "p", "_:y", "blank", ""), 10: ("a", "iri", "p", "$1 \\ $2", "literal", string)}
    for broken in ('<a> <p> "x" . y', "<a> <p> .", '<a> <p> "x\x01" . y', "\x01"):
        with pytest.raises(Exception, match="Not an N-Triples line"):
            parse_ntriples(spark.createDataFrame([(broken,)], "value string")).collect()


def _statements(spark, rows):
    return spark.createDataFrame([(s, "iri", "p", o, "literal", "") for s, o in rows], ", ".join(f"{c} string" for c in TRIPLE_COLUMNS))


def test_graphs_are_compared_without_moving_texts(spark):
    rows = [("a", "x"), ("a", "x"), ("b", None), (None, "y"), ("c", "z")]
    left, right = _statements(spark, rows), _statements(spark, [*rows[1:], ("d", "only"), ("d", "only"), (None, None)])
    assert graph_difference(left, left.repartition(3)).collect() == []
    found = sorted((r.side, r.subject, r.object) for r in graph_difference(left, right).na.fill("-").collect())
    assert found == [("right", "-", "-"), ("right", "d", "only")]
    assert [(r.side, r.subject) for r in graph_difference(right, left).where("subject IS NOT NULL").collect()] == [("left", "d")]
    plan = graph_difference(left, left)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [subject" not in plan, plan


def test_statements_of_a_subject_are_written_side_by_side(spark, tmp_path):
    rows = [(f"http://a/{k}", "iri", f"p{i}", f"text {i} of {k}", "literal", T.XSD_STRING, f"/in/{k % 2}.xml") for k in range(400) for i in range(5)]
    triples = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in (*TRIPLE_COLUMNS, "source_file"))).repartition(7)
    sourced = triples.withColumnRenamed("source_file", "source")
    pieces = clustered(sourced, rows_per_file=250, near=sourced.subject)
    assert pieces.count() == 2000 and pieces.select("subject", spark_partition_id()).distinct().count() == 400
    for _ in range(2):
        write_triples(triples, f"{tmp_path}/table")
    table = spark.read.parquet(f"{tmp_path}/table")
    assert graph_difference(triples, table).isEmpty() and table.count() == 2000
    # Each source lies in one task already, so its rows are not dealt out again.
    assert "Exchange" not in clustered(table.coalesce(1))._jdf.queryExecution().executedPlan().toString()
    write_ntriples(table, f"{tmp_path}/nt")
    back = read_ntriples(spark, f"{tmp_path}/nt")
    assert graph_difference(triples, back).isEmpty() and back.select("source_file").distinct().count() == 2
