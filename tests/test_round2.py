"""Inputs that the generated tables don't hold: nesting, long and escaped literals, paths of all kinds, shared keys."""

import json
import os

from pyspark.sql import functions as F

from litmine.functions import terms as T
from litmine.functions.terms import LANGUAGE_PREFIX, XSD_STRING
from litmine.operators.articles import articles_from_parsed, parse_records
from litmine.operators.chains import author_lists, member_names
from litmine.operators.kwic import missing_fulltext
from litmine.operators.ranges import bisect_ranges
from litmine.operators.vocabulary import SURFACE_PREDICATES, build_vocabulary
from litmine.plans.pubmed import load_articles, publish_articles
from litmine.session import on_one_machine
from litmine.sources.cord import read_fulltext
from litmine.sources.sinks import ntriples_lines
from litmine.sources.triples import parse_ntriples


def article(pmid: str, title: str, references: str = "") -> str:
    return (
        f"<PubmedArticle><MedlineCitation><PMID>{pmid}</PMID><Article><Journal/><ArticleTitle>{title}</ArticleTitle></Article></MedlineCitation>"
        f"<PubmedData><ArticleIdList><ArticleId IdType='pubmed'>{pmid}</ArticleId></ArticleIdList>{references}</PubmedData></PubmedArticle>"
    )


def test_references_nest_to_any_depth(spark):
    lists = ""
    for depth in range(5, 0, -1):
        cited = f"<Reference><ArticleIdList><ArticleId IdType='doi'>d{depth}</ArticleId></ArticleIdList></Reference>"
        lists = f"<ReferenceList><Title>T</Title>{cited}{lists}</ReferenceList>"
    raw = spark.createDataFrame([("f", article("1", "A title", lists))], "source_file string, raw string")
    row = articles_from_parsed(parse_records(raw)).first()
    assert row.dois == ["d1", "d2", "d3", "d4", "d5"]


def test_literals_of_any_length_language_and_escapes(spark):
    long = "x" * 100_000 + '\\"' * 10_000
    lines = [
        f'<s> <p> "{long}" .', '<s> <p> "caf\\u00E9"@fr .', '<s> <p> "café" .', '<s> <p> "x"@en-GB .', '<s> <p> "\\U0001F600 \\uD83D\\uDE00" .',
        '<s> <p> "a\\tb\\nc\\\\u00E9\\"\\\'\\b\\f\\r" .', '<s> <p> "1"^^<http://i> . # comment', "_:b <p> <o> .",
    ]
    got = [(r.object, r.datatype) for r in parse_ntriples(spark.createDataFrame([(x,) for x in lines], "value string")).collect()]
    assert got == [
        ("x" * 100_000 + '"' * 10_000, XSD_STRING), ("café", LANGUAGE_PREFIX + "fr"), ("café", XSD_STRING), ("x", LANGUAGE_PREFIX + "en-gb"),
        ("\U0001f600 \U0001f600", XSD_STRING), ("a\tb\nc\\u00E9\"'\b\f\r", XSD_STRING), ("1", "http://i"), ("o", ""),
    ]
    again = parse_ntriples(ntriples_lines(parse_ntriples(spark.createDataFrame([(x,) for x in lines], "value string")).withColumn("source_file", F.lit("f"))).select("value"))
    assert [(r.object, r.datatype) for r in again.collect()] == got


FULLTEXT = {"paper_id": "p", "metadata": {"title": "T", "authors": []}, "abstract": [], "body_text": [], "back_matter": [], "bib_entries": {}, "ref_entries": {}}


def test_full_text_names_of_all_kinds_of_paths(spark, tmp_path, monkeypatch):
    folder = tmp_path / "data" / "json files"
    (folder / "sub").mkdir(parents=True)
    for name in ("sub/a b+c%20.json", "d.json"):
        (folder / name).write_text(json.dumps(FULLTEXT))
    monkeypatch.chdir(tmp_path)
    want = {"sub/a b+c%20.json", "d.json"}
    relative = os.path.relpath(folder, str(spark.sparkContext._jvm.java.lang.System.getProperty("user.dir")))
    for path in (str(folder), str(folder) + "/", f"file://{folder}".replace(" ", " "), [str(folder)], relative):
        assert {r.json_file for r in read_fulltext(spark, path).collect()} == want, path
    only = spark.createDataFrame([("d.json",)], "json_file string")
    assert [tuple(r) for r in read_fulltext(spark, str(folder), only=only).collect()] == [("d.json", "T\n\n\n\n")]
    described = spark.createDataFrame([("1", "d.json"), ("2", "gone.json"), ("3", "")], "id string, json_file string")
    assert [tuple(r)[:2] for r in missing_fulltext(described, read_fulltext(spark, str(folder))).collect()] == [("2", "gone.json")]


def test_a_shared_author_is_one_row_per_place(spark):
    rows = []
    for k in range(20):
        rows += [(f"a{k}", T.DCT_CREATOR, f"l{k}", "blank"), (f"l{k}", T.RDF_FIRST, "orcid", "iri"), (f"l{k}", T.RDF_REST, T.RDF_NIL, "iri"), ("orcid", T.NAME, f"Name {k}", "literal")]
    graph = spark.createDataFrame(rows, "subject string, predicate string, object string, object_kind string")
    found = author_lists(graph).collect()
    assert len(found) == 20 and {r.name for r in found} == {"Name 0"} and len(member_names(graph).first().names) == 20


def test_one_long_range_is_more_than_one_task(spark):
    jobs = bisect_ranges(spark.createDataFrame([(0, 10**9)], "from_row long, until_row long"), 500)
    assert jobs.where("until_row - from_row > 500").count() == 0
    assert bisect_ranges(spark.createDataFrame([(0, 10**6)], "from_row long, until_row long"), 50).rdd.getNumPartitions() > 1


def test_a_cluster_needs_a_shared_folder():
    assert on_one_machine("local") and on_one_machine("local[8]") and not on_one_machine("local-cluster[2,1,1024]")
    assert not on_one_machine("yarn") and not on_one_machine("spark://host:7077")


def test_versions_of_an_article_are_counted_apart_and_loads_repeat(spark, tmp_path):
    (tmp_path / "in").mkdir()
    records = article("1", "Heart failure") + article("1", "Heart failure, revised") + article("2", "Other")
    (tmp_path / "in" / "a.xml").write_text(f"<PubmedArticleSet>{records}</PubmedArticleSet>")
    vocab = spark.createDataFrame([("http://t/heart", "heart failure")], "term_iri string, label string")
    plain = load_articles(spark, str(tmp_path / "in"))
    n = plain.stats.first().n_triples
    tables = load_articles(spark, str(tmp_path / "in"), _vocabulary(spark, vocab))
    assert tables.stats.first().n_triples == n + 2
    for _ in range(2):
        publish_articles(tables, str(tmp_path / "out"))
        assert spark.read.parquet(str(tmp_path / "out" / "triples")).count() == n + 2
        assert [r.value for r in spark.read.text(str(tmp_path / "out" / "edges")).collect()] == [f"{_iri(tables)}\thttp://t/heart"]
        assert spark.read.parquet(str(tmp_path / "out" / "stats")).count() == 2


def _vocabulary(spark, rows):
    triples = rows.select(
        F.col("term_iri").alias("subject"), F.lit("iri").alias("subject_kind"), F.lit(next(iter(SURFACE_PREDICATES))).alias("predicate"),
        F.col("label").alias("object"), F.lit("literal").alias("object_kind"), F.lit(XSD_STRING).alias("datatype"),
    )
    return build_vocabulary(triples)


def _iri(tables):
    return tables.articles.where("pmid = '1'").first().iri


