"""The registered queries against their SQL, and the pipeline's stages one after another."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
duckdb = pytest.importorskip("duckdb")

import corpus_pipeline  # noqa: E402
from check import TABLES, rows as plain_rows  # noqa: E402
from litmine.llm.jaccard_join import jaccard_components  # noqa: E402
from litmine.llm.template_decontamination import template_matches  # noqa: E402
from litmine.session import written  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables not there")


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in corpus_pipeline.QUERIES.items() if sql))
def test_query(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    run, sql = corpus_pipeline.QUERIES[name]
    got, want = run(spark, str(SF_DIR)).toPandas(), db.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns) and plain_rows(got) == plain_rows(want)


def test_toxicity_on_held_out_rows(spark):
    import numpy as np

    folder = "/root/testdata/sf0.01"
    got = corpus_pipeline.QUERIES["op5_toxicity"][0](spark, folder).toPandas()
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id").toxic
    got["toxic"] = got.doc_id.map(labels)
    held = got[got.held_out & got.toxic.notna()]
    pos, neg = held[held.toxic == 1].score.values, held[held.toxic == 0].score.values
    assert np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos]) > 0.9 and got.score.between(0, 1).all()


def test_stages_keep_what_they_should(spark, rows):
    folder = str(SF_DIR)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, folder), name)
        if name == "token_shards":
            assert {i for r in docs.collect() for i in r["doc_ids"]} == {r["doc_id"] for r in before.collect()}
            continue
        assert docs.columns == before.columns
        ids, old = {r["doc_id"] for r in docs.collect()}, {r["doc_id"] for r in before.collect()}
        assert ids <= old
        if name == "ngram_jaccard_join":
            assert ids == {r["component_id"] for r in jaccard_components(before, 5, 80).collect()}
        if name == "benchmark_decontamination":
            found = template_matches(before, spark.read.parquet(f"{folder}/benchmark.parquet"))
            assert ids == {r["doc_id"] for r in found.where("size(matches) = 0").collect()}
    docs = rows
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), name)
    assert docs.count() > 0


def test_toxicity_in_every_language(spark):
    import numpy as np

    folder = Path("/root/testdata/sf0.1")
    if not folder.exists():
        pytest.skip("no larger tables")
    got = corpus_pipeline.QUERIES["op5_toxicity"][0](spark, str(folder)).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas().set_index("doc_id").toxic
    got = got.join(labels).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").toPandas().set_index("doc_id"))
    held = got[got.held_out & got.toxic.notna()]
    for lang, part in held.groupby("lang"):
        pos, neg = part[part.toxic == 1].score.values, part[part.toxic == 0].score.values
        assert np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos]) > 0.9, lang
    assert (held[held.toxic == 0].predicted == 0).mean() > 0.97 and (held[held.toxic == 1].predicted == 1).mean() > 0.8
