import shutil
from pathlib import Path

from pyspark.sql import functions as F

from litmine.operators.articles import articles_from_parsed, parse_records
from litmine.operators.triples import article_triples, graph_difference
from litmine.operators.vocabulary import finish_vocabulary
from litmine.plans.fulltext import annotate_fulltext
from litmine.plans.profile import profile_files
from litmine.plans.pubmed import load_articles, triples_of
from litmine.plans.ranges import remaining_jobs
from litmine.sources.articles_xml import read_article_records
from litmine.streaming.ingest import ingest, stream_article_records
from test_fulltext import ROWS, document, write_metadata

FIXTURE = Path(__file__).parent / "fixtures" / "articles.xml"
NS = "https://www.ncbi.nlm.nih.gov/pubmed/"


def vocabulary(spark):
    return finish_vocabulary(spark.createDataFrame(
        [("t:genome", "human genome", "label"), ("t:human", "human", "label"), ("t:service", "service", "label"),
         ("http://id.nlm.nih.gov/mesh/D010300", "parkinson disease", "label")],
        "term_iri string, surface string, kind string"))


def test_articles_end_to_end(spark, tmp_path):
    tables = load_articles(spark, str(FIXTURE), vocabulary(spark), work_path=str(tmp_path / "articles"))
    edges = {(r.article.removeprefix(NS), r.term.rsplit("/", 1)[-1]) for r in tables.edges.collect()}
    # "human" alone is never annotated: each time it is part of the longer term.
    assert edges == {
        ("11237011", "D006801"), ("11237011", "D012313"), ("11237011", "Q000235"), ("11237011", "D020543"), ("11237011", "t:genome"),
        ("17060194", "D004175"), ("17060194", "Q000145"), ("17060194", "Q000235"),
        ("10542500", "D010300"), ("10542500", "Q000628"), ("10542500", "t:service")}
    assert tables.rejects.count() == 1
    row = tables.stats.first()
    assert (row.n_articles, row.n_triples) == (5, tables.triples.count())
    plain = article_triples(tables.articles)
    assert graph_difference(triples_of(tables.articles), plain).count() == 0
    assert tables.triples.count() == plain.count() + 2


def test_fulltext_end_to_end(spark, tmp_path):
    import json
    write_metadata(tmp_path / "m.csv", ROWS)
    (tmp_path / "json" / "d").mkdir(parents=True)
    (tmp_path / "json" / "d" / "full.xml.json").write_text(json.dumps(document()))
    vocab = finish_vocabulary(spark.createDataFrame([("t:lung", "lung", "label"), ("t:body", "body", "label")], "term_iri string, surface string, kind string"))
    rows = annotate_fulltext(spark, str(tmp_path / "m.csv"), str(tmp_path / "json"), vocab)
    assert sorted((r.id, r.matched) for r in rows.collect()) == [
        ("u1:0", "Lung"), ("u1:0", "lung"), ("u1:1", "Body"), ("u1:1", "Body"), ("u3:3", "lung")]
    part = annotate_fulltext(spark, str(tmp_path / "m.csv"), str(tmp_path / "json"), vocab, 1, 3)
    assert {r.id for r in part.collect()} == {"u1:1"}


def test_profile_and_jobs(spark, tmp_path):
    assert profile_files(spark, str(FIXTURE), None).where("path LIKE '%.PMID'").agg(F.sum("n")).first()[0] == 6
    for name in ("result_from_0_until_640.tsv", "result_from_700_until_900.tsv"):
        (tmp_path / name).write_text("x")
    jobs = sorted(tuple(r) for r in remaining_jobs(spark, str(tmp_path), 2000).collect())
    assert jobs == [(640, 700), (900, 1175), (1175, 1450), (1450, 1725), (1725, 2000)]


def test_incremental_ingest(spark, tmp_path):
    inbox, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    inbox.mkdir()
    shutil.copy(FIXTURE, inbox / "a.xml")

    def run():
        stream = stream_article_records(spark, str(inbox), "*.xml", max_files=1)
        ingest(stream, lambda batch: articles_from_parsed(parse_records(batch)), out, checkpoint).awaitTermination()
        return spark.read.parquet(out)

    assert run().count() == 5
    assert run().count() == 5
    shutil.copy(FIXTURE, inbox / "b.xml")
    result = run()
    assert result.count() == 10 and result.select("source_file").distinct().count() == 2
    batch = articles_from_parsed(parse_records(read_article_records(spark, str(FIXTURE))))
    assert graph_difference(article_triples(result), article_triples(batch)).count() == 0
