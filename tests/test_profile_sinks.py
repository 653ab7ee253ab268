import gzip
from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from litmine.operators.articles import articles_from_parsed, parse_records
from litmine.operators.edges import edges_from_triples
from litmine.operators.profile import field_counts, sum_field_counts
from litmine.operators.triples import article_triples, graph_difference
from litmine.sources.articles_xml import read_article_records, read_chunks
from litmine.sources.field_counts import parse_count_line, read_field_counts
from litmine.sources.sinks import (
    write_edge_table, write_edges, write_field_counts, write_ntriples, write_triples,
)
from litmine.sources.triples import parse_ntriples, read_ntriples

FIXTURE = Path(__file__).parent / "fixtures" / "articles.xml"
SMALL = """<?xml version="1.0"?>
<!DOCTYPE PubmedArticleSet>
<PubmedArticleSet>
<PubmedArticle Owner="x"><A k="1">one<B/>two<B>x</B> </A><PubMedPubDate PubStatus="pubmed"/></PubmedArticle>
<PubmedArticle><PubMedPubDate PubStatus="entrez">t</PubMedPubDate><C></C></PubmedArticle><Other z="1"/>
</PubmedArticleSet>
"""
S = "PubmedArticleSet"
P = "PubmedArticleSet.PubmedArticle"
WANT = {
    S: 3, f"{S}.PubmedArticle/Owner": 1, f"{P}.A/k": 1, f"{P}.A": 3, f"{P}.A.B": 1,
    f"{P}.PubMedPubDate/PubStatus#pubmed": 1, f"{P}.PubMedPubDate/PubStatus#entrez": 1, f"{P}.PubMedPubDate": 1, f"{S}.Other/z": 1,
}


def counts(df):
    return {r.path: r.n for r in df.collect()}


def test_field_counts(spark, tmp_path):
    for name in ("a.xml.gz", "b.xml.gz"):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(SMALL)
    chunks = read_chunks(spark, str(tmp_path), "*.xml.gz")
    per_file = field_counts(chunks)
    assert counts(per_file.where(F.col("source_file").endswith("a.xml.gz"))) == WANT
    assert counts(sum_field_counts(per_file)) == {k: 2 * v for k, v in WANT.items()}
    assert [r.path for r in sum_field_counts(per_file).collect()] == sorted(WANT)
    bare = counts(sum_field_counts(field_counts(chunks, count_whitespace_text=False, expanded=())))
    assert bare[f"{P}.A"] == 4 and S not in bare and bare[f"{P}.PubMedPubDate/PubStatus"] == 4
    write_field_counts(per_file, str(tmp_path / "out"))
    again = read_field_counts(spark, str(tmp_path / "out"))
    assert counts(sum_field_counts(again)) == {k: 2 * v for k, v in WANT.items()}
    first = spark.read.text(str(tmp_path / "out" / "source=a.xml.gz-*")).collect()
    assert [r.value for r in first] == [f"{WANT[k]}\t{k}" for k in sorted(WANT)]


def test_malformed_record_and_line(spark):
    broken = counts(field_counts(read_chunks(spark, str(FIXTURE))))
    assert broken["#malformed"] == 1 and broken["PubmedArticleSet.PubmedArticle.MedlineCitation.PMID"] == 5
    assert broken["PubmedArticleSet.DeleteCitation.PMID/Version"] == 1
    lines = spark.createDataFrame([("x\ty",)], "v string")
    with pytest.raises(PySparkException, match="Unable to parse line"):
        lines.select(*parse_count_line(F.col("v"))).collect()


@pytest.fixture(scope="module")
def triples(spark):
    return article_triples(articles_from_parsed(parse_records(read_article_records(spark, str(FIXTURE))))).cache()


def test_ntriples_round_trip(spark, tmp_path, triples):
    odd = spark.createDataFrame(
        [("http://e/s", "iri", "http://e/p", 'a "q" \\ \n\t\r \\n é', "literal", "http://www.w3.org/2001/XMLSchema#string", "f.xml")],
        triples.schema)
    everything = triples.unionByName(odd)
    write_ntriples(everything, str(tmp_path / "nt"))
    back = read_ntriples(spark, str(tmp_path / "nt"))
    assert graph_difference(everything, back).count() == 0 and back.count() == everything.count()
    bad = spark.createDataFrame([("# comment",), ("",), ("<a> <b> c .",)], "value string")
    with pytest.raises(PySparkException, match="Not an N-Triples line"):
        parse_ntriples(bad).collect()
    write_triples(triples, str(tmp_path / "table"))
    table = spark.read.parquet(str(tmp_path / "table"))
    assert graph_difference(triples, table).count() == 0 and {r.source.rsplit("-", 1)[0] for r in table.select("source").distinct().collect()} == {"articles.xml"}


def test_edge_sinks(spark, tmp_path, triples):
    edges = edges_from_triples(triples)
    write_edges(edges, str(tmp_path / "tsv"))
    lines = Counter(r.value for r in spark.read.text(str(tmp_path / "tsv")).collect())
    assert lines == Counter(f"{r.article}\t{r.term}" for r in edges.collect())
    assert len(lines) == 4 + 3 + 2
    write_edges(edges.withColumn("source_file", F.lit("a/b.xml")), str(tmp_path / "by_source"))
    assert spark.read.text(str(tmp_path / "by_source" / "source=b.xml-*")).count() == 9
    write_edge_table(edges, str(tmp_path / "table"))
    one = spark.read.parquet(str(tmp_path / "table")).where(F.col("term") == "http://id.nlm.nih.gov/mesh/D006801")
    assert one.count() == 1
    assert "PushedFilters: [IsNotNull(term), EqualTo(term" in one._jdf.queryExecution().executedPlan().toString()
