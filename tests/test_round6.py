"""Findings of the third list, sixth round: records are made once, counted as they are parsed."""

from collections import Counter
from datetime import date
from xml.etree import ElementTree

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from litmine.operators.profile import MALFORMED, ROOT, batch_counter
from spark_queries.file_queries import _files
from spark_queries.tables import order_records


@pytest.fixture
def orders(spark, tmp_path):
    rows = {
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate date, o_orderpriority string",
                   [(k, k % 3, "FO"[k % 2], date(1995, 1 + k % 12, 3), "1-URGENT") for k in range(60)]),
        "customer": ("c_custkey long, c_name string, c_nationkey long, c_mktsegment string", [(c, f"C{c}", 0, "AUTO") for c in range(3)]),
        "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "N", 0)]), "region": ("r_regionkey long, r_name string", [(0, "R")]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_records_of_some_orders_are_made_after_these_are_dealt(spark, orders):
    """F30"""
    plain = F.xxhash64("o_orderkey") % 2 == 0
    records = order_records(spark, orders, plain)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    made, dealt = plan.split("Repartition", 1)
    assert "PubmedArticle" in made and "PubmedArticle" not in dealt
    assert "xxhash64(o_orderkey" in dealt
    assert records.union(order_records(spark, orders, ~plain)).exceptAll(order_records(spark, orders)).isEmpty()


def test_files_hold_every_record_once(spark, orders):
    """F30"""
    lines = spark.read.text(_files(spark, orders))
    assert Counter(r.value for r in lines.collect()) == Counter(r.raw for r in order_records(spark, orders).collect())


def _walked(chunk, expanded):
    """The paths of a tree, one after another."""
    tree, found = ElementTree.fromstring(f"<{ROOT}>{chunk}</{ROOT}>"), []

    def walk(node, path, above):
        found.extend(path for run in (node.text, *(c.tail for c in node)) if run)
        tag = node.tag.rsplit("}", 1)[-1]
        for key, value in node.attrib.items() if above else ():
            name = f"{tag}/{key.rsplit('}', 1)[-1]}"
            found.append(f"{above}.{name}" + (f"#{value}" if name in expanded else ""))
        for child in node:
            walk(child, f"{path}.{child.tag.rsplit('}', 1)[-1]}", path)

    walk(tree, ROOT, "")
    return Counter(found)


def test_counter_counts_while_it_parses():
    """no tree is built; text runs go on over comments, sections and instructions; nothing of a broken chunk counts."""
    assert "ElementTree" not in batch_counter.__globals__
    chunks = [
        '\n<A x="1" y="2">t<!-- c -->u<B/>v<![CDATA[w]]>x<B x="1"> </B><?p i?></A>',
        '<n:A xmlns:n="u" n:x="3"><B y="4">&lt;</B>\n</n:A><A x="1"/>tail', "", " <A><B x='1'>lost</A>",
    ]
    expanded = frozenset({"B/x", "A/y"})
    wanted = sum((_walked(c, expanded) for c in chunks[:3]), Counter()) + Counter({MALFORMED: 1})
    batch = pa.RecordBatch.from_arrays([pa.array(["f"] * 4), pa.array(chunks)], names=["source_file", "chunk"])
    (out,) = batch_counter(ROOT, expanded, True, "")(iter([batch]))
    rows = [tuple(r.values()) for r in out.to_pylist()]
    assert {p: n for _, p, n in rows} == wanted and len(rows) == len(wanted)
