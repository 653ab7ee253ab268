"""Records are parsed for what is asked of them."""

import pytest
from litmine.operators.articles import DERIVED_FROM, READ_FROM, articles_from_parsed, parse_records
from litmine.sources.articles_xml import read_article_records, record_schema
from pyspark.sql import functions as F
from spark_queries.xml_queries import author_names
from tests.test_articles import FIXTURE
from tests.test_round3 import plan_of, tables

BODY = "<PubmedArticle><MedlineCitation><PMID>{}</PMID>{}</MedlineCitation></PubmedArticle>"
ODD = [
    BODY.format(1, "<Article><AuthorList><Author>x</AuthorList></Article>"), BODY.format(2, "<DateRevised>text</DateRevised><ChemicalList>t<Chemical/></ChemicalList>"),
    BODY.format(3, "<MeshHeadingList>a &bad; b</MeshHeadingList>"), BODY.format(4, "<Article a=1/>"), BODY.format(5, "")[:-9], BODY.format(6, "<X>"), "", "<PubmedArticle/>",
    BODY.format(7, "<Article><AuthorList><Author><LastName>a<y>q</y></LastName><Identifier>z</Identifier></Author><Author/></AuthorList></Article>"),
]


@pytest.mark.parametrize("columns", [["iri"], ["iri", "authors"], ["pmid", "title", "as_string"], ["dois", "mesh_ids"], ["pub_years", "issns"]])
def test_columns_asked_for_are_those_of_whole_records(spark, columns):
    odd = spark.createDataFrame([("f", raw) for raw in ODD], "source_file string, raw string")
    records = read_article_records(spark, str(FIXTURE)).unionByName(odd)
    whole = articles_from_parsed(parse_records(records))
    some = articles_from_parsed(parse_records(records, columns), columns=columns)
    assert set(some.columns) < set(whole.columns)
    as_text = [F.to_json(F.struct(*columns)).alias("row")]
    assert sorted(some.select(as_text).collect()) == sorted(whole.select(as_text).collect())
    malformed = [sorted(r[0] for r in p.where("_corrupt_record IS NOT NULL").select("raw").collect()) for p in (parse_records(records), parse_records(records, columns))]
    assert malformed[0] == malformed[1] and len(malformed[0]) >= 5


def test_every_column_of_an_article_has_its_elements(spark):
    whole = articles_from_parsed(parse_records(spark.createDataFrame([], "source_file string, raw string")))
    assert whole.columns == [*READ_FROM, *DERIVED_FROM]
    assert "AuthorList" in record_schema() and "AuthorList" not in record_schema(["PMID"])


def test_authors_are_parsed_without_the_rest(spark, tmp_path):
    found = author_names(spark, tables(spark, tmp_path))
    assert "StructField(AuthorList" in plan_of(found) and "StructField(MeshHeadingList" not in plan_of(found)
    assert found.where("position = 0").count() == 10
