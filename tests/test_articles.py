import datetime
import gzip
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from litmine.functions import terms as T
from litmine.operators.articles import articles_from_parsed, date_rejects, malformed_records, parse_records
from litmine.operators.stats import load_stats, stats_triples
from litmine.operators.triples import GROUPS, article_triples, graph_difference, triple_summary, with_annotations
from litmine.sources.articles_xml import read_article_records

FIXTURE = Path(__file__).parent / "fixtures" / "articles.xml"
PUBMED = "https://www.ncbi.nlm.nih.gov/pubmed/"
ORCID = "https://orcid.org/0000-0002-1825-0097"


@pytest.fixture(scope="module")
def parsed(spark):
    return parse_records(read_article_records(spark, str(FIXTURE))).cache()


@pytest.fixture(scope="module")
def articles(parsed):
    return articles_from_parsed(parsed).cache()


@pytest.fixture(scope="module")
def by_pmid(articles):
    return {r.pmid: r for r in articles.collect()}


@pytest.fixture(scope="module")
def triples(articles):
    return article_triples(articles).cache()


def test_records_and_rejects(parsed, by_pmid):
    assert set(by_pmid) == {"11237011", "17060194", "22859891", "10542500", "15517475"}
    rejects = malformed_records(parsed).collect()
    assert len(rejects) == 1 and "Broken" in rejects[0].raw and rejects[0].reason == "Malformed record"


def test_gzip_directory(spark, tmp_path, by_pmid):
    with open(FIXTURE, "rb") as source, gzip.open(tmp_path / "a.xml.gz", "wb") as target:
        shutil.copyfileobj(source, target)
    (tmp_path / "ignored.txt").write_text("<PubmedArticle><MedlineCitation><PMID>7</PMID></MedlineCitation></PubmedArticle>")
    zipped = articles_from_parsed(parse_records(read_article_records(spark, str(tmp_path), "*.xml.gz")))
    rows = zipped.select("pmid", "title", "source_file").collect()
    assert {(r.pmid, r.title) for r in rows} == {(p, r.title) for p, r in by_pmid.items()}
    assert all(r.source_file.endswith("/a.xml.gz") for r in rows)


def test_text_fields(by_pmid):
    a = by_pmid["11237011"]
    assert a.title == "Initial sequencing and analysis of the human genome."
    assert a.abstract_text == "The human genome <b> holds. H2O & more. End. Autre."
    assert a.mesh_ids == ["D006801", "D012313", "Q000235", "D020543"]
    assert a.mesh_labels == ["Humans", "RNA genetics", "Proteome", "RNA"]
    assert a.gene_symbols == "abc1 def2"
    assert a.as_string == f"{a.title} {a.abstract_text} Humans RNA genetics Proteome RNA abc1 def2"
    assert a.article_ids == {"pubmed": ["11237011"], "doi": ["10.1038/35057062"], "unknown": ["x7"]}
    assert [x.name for x in a.authors] == ["E S Lander", "International Consortium"]
    assert by_pmid["10542500"].as_string == "Thirty years of service.  Parkinson Disease therapy United Kingdom "
    assert by_pmid["15517475"].title == "Differentiated Operative Strategy <i>"
    assert by_pmid["22859891"].as_string == "From documents to datasets   "


def test_dates(by_pmid, articles):
    def dates(values):
        return [(d.precision, d.year, d.month, d.day) for d in values]

    assert dates(by_pmid["11237011"].pub_dates) == [("day", 2001, 2, 15)]
    assert dates(by_pmid["11237011"].revised_dates) == [("day", 2019, 2, 8)]
    assert dates(by_pmid["17060194"].pub_dates) == [("month", 2006, 10, None)]
    assert dates(by_pmid["22859891"].pub_dates) == [("year", 2012, None, None)]
    assert dates(by_pmid["10542500"].pub_dates) == [("year", 1998, None, None)]
    rejects = date_rejects(articles).collect()
    assert [(r.iri, r.field, r.reason) for r in rejects] == [(PUBMED + "15517475", "pub_dates", "Could not parse XML node as date")]


def test_identifiers(by_pmid, parsed):
    assert by_pmid["17060194"].dois == ["10.1080/10635150600969864"]
    assert by_pmid["22859891"].dois == ["10.3897/zookeys.209.3247", "10.1/cited"]
    assert by_pmid["22859891"].article_ids["pubmed"] == ["5"]
    own = {r.pmid: r for r in articles_from_parsed(parsed, own_ids_only=True, keep_empty_mesh_ids=True).collect()}
    assert own["22859891"].dois == ["10.3897/zookeys.209.3247"]
    assert own["10542500"].mesh_ids == ["D010300", "Q000628", ""]
    assert by_pmid["10542500"].dois == []


def test_authors(by_pmid):
    a = by_pmid["17060194"]
    assert [x.name for x in a.authors] == ["Rudolf Meier", "Kwong Shiyang", "Josiah Carberry Jr", "Peter K L Ng", "et al"]
    assert a.authors[2].orcids == [ORCID]
    assert [x.name for x in by_pmid["15517475"].authors] == ["Jochen Schabram", "Christian Vorländer", "Jo Schabram"]
    assert by_pmid["10542500"].authors == [] and by_pmid["22859891"].authors == []


def values(rows, subject, predicate):
    return [(r.object, r.datatype) for r in rows if r.subject == subject and r.predicate == predicate]


def only(rows, subject, predicate):
    found = values(rows, subject, predicate)
    assert len(found) == 1, (subject, predicate, found)
    return found[0][0]


def test_golden_graph(triples):
    rows = triples.collect()
    iri = PUBMED + "17060194"
    assert values(rows, iri, T.DCT_ISSUED) == [("2006-10", T.XSD_GYEARMONTH)]
    assert values(rows, iri, T.DCT_MODIFIED) == [("2008-11-21", T.XSD_DATE)]
    assert values(rows, iri, T.PUBLICATION_YEAR) == [("2006", T.XSD_GYEAR)]
    assert values(rows, iri, T.DOI) == [("10.1080/10635150600969864", T.XSD_STRING)]
    assert (only(rows, iri, T.STARTING_PAGE), only(rows, iri, T.ENDING_PAGE), only(rows, iri, T.PAGE_RANGE)) == ("715", "28", "715-28")
    assert only(rows, iri, T.DCT_CITATION) == (
        "Meier R, Shiyang K, Carberry J Jr, Ng PK, et al. DNA barcoding and taxonomy in Diptera: a tale of high "
        "intraspecific variability and low identification success. Systematic biology (2006);55(5):715-28. "
        "PubMed PMID: 17060194")
    assert {v[0] for v in values(rows, iri, T.DCT_REFERENCES)} == {
        "http://id.nlm.nih.gov/mesh/" + m for m in ("D004175", "Q000145", "Q000235")}
    issue = only(rows, iri, T.PART_OF)
    volume = only(rows, issue, T.PART_OF)
    journal = only(rows, volume, T.PART_OF)
    assert [only(rows, n, T.RDF_TYPE) for n in (issue, volume, journal)] == [T.ISSUE_CLASS, T.VOLUME_CLASS, T.JOURNAL_CLASS]
    assert (only(rows, issue, T.ISSUE_IDENTIFIER), only(rows, volume, T.VOLUME)) == ("5", "55")
    assert (only(rows, journal, T.ISSN), only(rows, journal, T.DCT_TITLE), only(rows, journal, T.JOURNAL_ABBREVIATION)) == (
        "1063-5157", "Systematic biology", "Syst. Biol.")
    cell, agents = only(rows, iri, T.DCT_CREATOR), []
    while cell != T.RDF_NIL:
        agents.append(only(rows, cell, T.RDF_FIRST))
        cell = only(rows, cell, T.RDF_REST)
    assert [only(rows, a, T.NAME) for a in agents[:2]] == ["Rudolf Meier", "Kwong Shiyang"]
    assert agents[2] == ORCID and only(rows, agents[4], T.NAME) == "et al"
    assert values(rows, agents[4], T.FAMILY_NAME) == [] and only(rows, agents[0], T.FAMILY_NAME) == "Meier"
    mine = [r for r in rows if r.subject in {iri, issue, volume, journal, *agents[:2], *agents[3:]}]
    # 13 about the article apart from its 3 references and list, 3 + 3 + 4 for the journal, 4*3 + 2 for agents
    assert len(mine) == 13 + 2 + 10 + 4 * 3 + 2


def test_same_orcid_merges(triples):
    rows = [r for r in triples.collect() if r.subject == ORCID]
    names = sorted(r.object for r in rows if r.predicate == T.NAME)
    assert names == ["Jo Schabram", "Jochen Schabram", "Josiah Carberry Jr"]
    # once for each of the two articles
    assert sum(r.predicate == T.RDF_TYPE for r in rows) == 2


def test_no_authors_no_issue_two_page_ranges(triples):
    rows = triples.collect()
    iri = PUBMED + "22859891"
    assert only(rows, iri, T.DCT_CREATOR) == T.RDF_NIL
    volume = only(rows, iri, T.PART_OF)
    assert only(rows, volume, T.RDF_TYPE) == T.VOLUME_CLASS and only(rows, volume, T.VOLUME) == ""
    journal = only(rows, volume, T.PART_OF)
    assert only(rows, journal, T.E_ISSN) == "1313-2970" and only(rows, journal, T.ISSN) == "1313-2989"
    assert values(rows, iri, T.STARTING_PAGE) == [] and only(rows, iri, T.PAGE_RANGE) == "235-53, 260-1"
    assert values(rows, PUBMED + "10542500", T.DOI) == []
    assert values(rows, PUBMED + "15517475", T.STARTING_PAGE) == []
    assert values(rows, PUBMED + "15517475", T.DCT_ISSUED) == []


def test_single_groups(articles, triples):
    """Every group on its own, also where some articles have none of it."""
    groups = [article_triples(articles, (g,)) for g in GROUPS]
    assert sum(g.count() for g in groups) == triples.count()
    references = article_triples(articles, ("mesh",)).collect()
    assert len(references) == 9 and all(r.subject for r in references)


def test_summary(triples):
    got = {(r.predicate, r.object_type): r.n for r in triple_summary(triples).collect() if r.subject == PUBMED + "11237011"}
    assert got == {
        (T.RDF_TYPE, "iri"): 1, (T.PUBLICATION_YEAR, T.XSD_GYEAR): 1, (T.DCT_TITLE, T.XSD_STRING): 1,
        (T.DCT_CREATOR, "blank"): 1, (T.DCT_REFERENCES, "iri"): 4, (T.DCT_ISSUED, T.XSD_DATE): 1,
        (T.DCT_MODIFIED, T.XSD_DATE): 1, (T.DOI, T.XSD_STRING): 1, (T.PAGE_RANGE, T.XSD_STRING): 1,
        (T.STARTING_PAGE, T.XSD_STRING): 1, (T.ENDING_PAGE, T.XSD_STRING): 1, (T.PART_OF, "blank"): 1,
        (T.DCT_CITATION, T.XSD_STRING): 1}


def test_annotations_and_stats(spark, articles, triples):
    mesh = "http://id.nlm.nih.gov/mesh/D004175"
    source = articles.first().source_file
    edges = spark.createDataFrame(
        [(PUBMED + "17060194", source, mesh), (PUBMED + "17060194", source, "t:new"), (PUBMED + "17060194", source, "t:new")],
        "iri string, source_file string, term_iri string")
    combined = with_annotations(triples, edges)
    assert combined.count() == triples.count() + 1
    difference = graph_difference(triples, combined).collect()
    assert [(r.object, r.side) for r in difference] == [("t:new", "right")]
    assert graph_difference(triples, triples).count() == 0
    stats = load_stats(articles, combined)
    row = stats.first()
    assert (row.n_articles, row.n_triples) == (5, combined.count())
    facts = {r.predicate: (r.object, r.datatype) for r in stats_triples(stats, F.lit(2.5)).collect()}
    assert facts == {
        T.ARTICLE_COUNT: ("5", T.XSD_INTEGER), T.TRIPLE_COUNT: (str(row.n_triples), T.XSD_INTEGER), T.TIME_TAKEN: ("PT2.5S", T.XSD_DURATION)}
