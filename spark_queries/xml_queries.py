"""Article records, articles, triples, profile and chains."""

from __future__ import annotations

from pyspark.sql import functions as F

from litmine.functions import article_iri, date_lexical, date_xsd_type, normalize_orcid
from litmine.functions import terms as T
from litmine.operators.articles import date_rejects
from litmine.operators.chains import author_lists, journal_chain
from litmine.operators.isomorphism import graph_mismatch
from litmine.operators.edges import count_articles_per_term, edge_statements, edges_from_triples
from litmine.operators.profile import field_counts, sum_field_counts
from litmine.operators.stats import load_stats, stats_triples
from litmine.operators.triples import article_triples, graph_difference, triple_summary, with_annotations
from litmine.session import written
from litmine.sources.articles_xml import CLOSING_TAG
from litmine.sources.field_counts import parse_count_line
from litmine.sources.sinks import ntriples_lines
from litmine.sources.triples import parse_ntriples
from spark_queries.tables import ARTICLES_SQL, order_articles, order_records, order_triples, orcid_spelling, table

WITH = "WITH " + ARTICLES_SQL.strip()


def xml_articles(spark, sf_dir):
    articles = order_articles(
        spark, sf_dir, "iri", "source_file", "title", "abstract_text", "journal_volume", "journal_issue", "journal_title", "journal_abbr",
        "medline_pagination", "dois", "mesh_ids", "as_string", "authors")
    return articles.select(
        "iri", "source_file", "title", "abstract_text", "journal_volume", "journal_issue", "journal_title", "journal_abbr",
        "medline_pagination", F.array_join("dois", ", ").alias("dois"), F.array_join(F.array_sort("mesh_ids"), ",").alias("mesh_ids"),
        "as_string", F.array_join(F.transform("authors", lambda a: a["name"]), "; ").alias("authors"),
    )


XML_ARTICLES = WITH + """
SELECT iri, source_file, title, abstract_text, volume AS journal_volume, issue AS journal_issue, journal AS journal_title,
  r_name AS journal_abbr, pages AS medline_pagination, dois,
  (SELECT string_agg(mesh_id, ',' ORDER BY mesh_id) FROM mesh WHERE mesh.k = material.k) AS mesh_ids,
  title || ' ' || abstract_text || ' ' || segment || CASE WHEN k % 5 <> 0 THEN ' ' || n_name ELSE '' END ||
    ' Substance ' || (k % 50) || ' ' || CASE WHEN k % 4 = 0 THEN 'g' || (k % 10) || ' h' ELSE '' END AS as_string,
  COALESCE((SELECT string_agg(name, '; ' ORDER BY position) FROM authors WHERE authors.k = material.k), '') AS authors
FROM material"""


def partial_date_parse(spark, sf_dir):
    dates = order_articles(spark, sf_dir, "iri", "pub_dates").select("iri", F.explode("pub_dates").alias("p"))
    texts = [F.coalesce(f"p.{c}", F.lit("")).alias(c) for c in ("precision", "error")]
    numbers = [F.coalesce(f"p.{c}", F.lit(0)).alias(c) for c in ("year", "month", "day")]
    return dates.select("iri", *texts, *numbers)


PARTIAL_DATE_PARSE = WITH + """
SELECT iri, COALESCE(pub_precision, '') AS precision, CAST(COALESCE(pub_year, 0) AS INTEGER) AS year,
  CAST(COALESCE(pub_month, 0) AS INTEGER) AS month, CAST(COALESCE(pub_day, 0) AS INTEGER) AS day, COALESCE(pub_error, '') AS error FROM material"""


def date_literals(spark, sf_dir):
    dates = order_articles(spark, sf_dir, "iri", "pub_dates", "revised_dates").select("iri", F.explode(F.concat("pub_dates", "revised_dates")).alias("p"))
    return dates.where("p.error IS NULL").select(
        "iri", date_lexical(F.col("p")).alias("lexical"), F.substring_index(date_xsd_type(F.col("p")), "#", -1).alias("xsd_type"))


DATE_LITERALS = WITH + """
SELECT iri, issued AS lexical, issued_type AS xsd_type FROM material WHERE issued IS NOT NULL
UNION ALL SELECT iri, modified, 'date' FROM material"""


def rejected_dates(spark, sf_dir):
    return date_rejects(order_articles(spark, sf_dir, "iri", "source_file", "pub_dates", "article_dates", "revised_dates"))


REJECTED_DATES = WITH + """
SELECT iri, source_file, 'pub_dates' AS field, pub_error AS reason FROM material WHERE pub_error IS NOT NULL"""


def orcid_normalize(spark, sf_dir):
    orcid = normalize_orcid(orcid_spelling(F.col("c_custkey")))
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(orcid, F.lit("")).alias("orcid"))


ORCID_NORMALIZE = """
SELECT c_custkey, CASE WHEN c_custkey % 8 < 6 THEN 'https://orcid.org/' || substr(code, 1, 4) || '-' || substr(code, 5, 4) || '-' ||
  substr(code, 9, 4) || '-' || substr(code, 13, 4) ELSE '' END AS orcid
FROM (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 16, '0') AS code FROM customer)"""


def author_names(spark, sf_dir):
    people = order_articles(spark, sf_dir, "iri", "authors").select("iri", F.posexplode("authors").alias("position", "a"))
    return people.select(
        "iri", F.col("position").cast("long").alias("position"), "a.name", "a.family", "a.given", F.col("a.short").alias("short_name"),
        F.coalesce(F.get("a.orcids", F.lit(0)), F.lit("")).alias("orcid"))


AUTHOR_NAMES = WITH + """
SELECT iri, CAST(position AS BIGINT) AS position, name, COALESCE(family, '') AS family, COALESCE(given, '') AS given,
  short AS short_name, COALESCE(orcid, '') AS orcid FROM authors"""


def article_id_map(spark, sf_dir):
    ids = order_articles(spark, sf_dir, "iri", "article_ids").select("iri", F.explode("article_ids").alias("id_type", "ids"))
    return ids.select("iri", "id_type", F.array_join("ids", "|").alias("ids"))


ARTICLE_ID_MAP = WITH + """
SELECT iri, 'pubmed' AS id_type, pmid AS ids FROM material
UNION ALL SELECT iri, 'unknown', 'x' || k FROM material
UNION ALL SELECT iri, 'doi', replace(dois, ', ', '|') FROM material WHERE dois <> ''"""


def _triples(spark, sf_dir, *groups):
    triples = order_triples(spark, sf_dir, *groups)
    return triples.select("subject", "predicate", "object", "datatype", "source_file")


def triples_metadata(spark, sf_dir):
    return _triples(spark, sf_dir, "metadata", "dates")


TRIPLES_METADATA = WITH + f"""
SELECT iri AS subject, '{T.RDF_TYPE}' AS predicate, '{T.ARTICLE_CLASS}' AS object, '' AS datatype, source_file FROM material
UNION ALL SELECT iri, '{T.DCT_TITLE}', title, '{T.XSD_STRING}', source_file FROM material
UNION ALL SELECT iri, '{T.DOI}', dois, '{T.XSD_STRING}', source_file FROM material WHERE dois <> ''
UNION ALL SELECT iri, '{T.PUBLICATION_YEAR}', CAST(pub_year AS VARCHAR), '{T.XSD_GYEAR}', source_file FROM material WHERE pub_year IS NOT NULL
UNION ALL SELECT iri, '{T.DCT_ISSUED}', issued, '{T.XSD}' || issued_type, source_file FROM material WHERE issued IS NOT NULL
UNION ALL SELECT iri, '{T.DCT_MODIFIED}', modified, '{T.XSD_DATE}', source_file FROM material"""


def page_range_split(spark, sf_dir):
    return _triples(spark, sf_dir, "pages").select("subject", "predicate", "object")


PAGE_RANGE_SPLIT = WITH + f"""
SELECT iri AS subject, '{T.PAGE_RANGE}' AS predicate, pages AS object FROM material
UNION ALL SELECT iri, '{T.STARTING_PAGE}', first_page FROM material WHERE first_page IS NOT NULL
UNION ALL SELECT iri, '{T.ENDING_PAGE}', last_page FROM material WHERE last_page IS NOT NULL"""


def citation_strings(spark, sf_dir):
    return _triples(spark, sf_dir, "citation").select("subject", F.col("object").alias("citation"))


CITATION_STRINGS = WITH + """
SELECT iri AS subject,
  COALESCE((SELECT string_agg(short, ', ' ORDER BY position) FROM authors WHERE authors.k = material.k), '') || '. ' ||
  title || CASE WHEN title LIKE '%.' THEN '' ELSE '.' END || ' ' || journal || ' (' || COALESCE(CAST(pub_year AS VARCHAR), '') || ');' ||
  volume || CASE WHEN issue = '' THEN '' ELSE '(' || issue || ')' END || ':' || pages || '. PubMed PMID: ' || pmid AS citation
FROM material"""


def triples_references(spark, sf_dir):
    return _triples(spark, sf_dir, "mesh").select("subject", "object")


TRIPLES_REFERENCES = WITH + "\nSELECT iri AS subject, 'http://id.nlm.nih.gov/mesh/' || mesh_id AS object FROM mesh"


def journal_chains(spark, sf_dir):
    triples = order_triples(spark, sf_dir, "metadata", "journal")
    return journal_chain(written(triples, "chain"))


JOURNAL_CHAINS = WITH + "\nSELECT iri AS article, issue, volume, journal, r_name AS abbreviation FROM material"


def journal_issns(spark, sf_dir):
    triples = order_triples(spark, sf_dir, "journal")
    issns = triples.where(F.col("predicate").isin(T.ISSN, T.E_ISSN))
    return issns.groupBy("predicate", "object").agg(F.count("*").alias("n"))


JOURNAL_ISSNS = WITH + f"""
SELECT predicate, object, count(*) AS n FROM (
  SELECT CASE WHEN k % 2 = 0 THEN '{T.E_ISSN}' ELSE '{T.ISSN}' END AS predicate, CAST(nation AS VARCHAR) AS object FROM material
  UNION ALL SELECT '{T.ISSN}', 'x' || nation FROM material WHERE k % 6 = 0) GROUP BY 1, 2"""


def author_list_order(spark, sf_dir):
    """Lists are followed from cell to cell; an ORCID shared by articles brings all its names along."""
    triples = order_triples(spark, sf_dir, "authors")
    return author_lists(written(triples, "lists"), every_name=True)


AUTHOR_LIST_ORDER = WITH + """
SELECT a.iri AS article, CAST(a.position AS BIGINT) AS position, n.name
FROM authors a JOIN (SELECT DISTINCT orcid, name FROM authors WHERE orcid IS NOT NULL) n ON a.orcid = n.orcid
UNION ALL SELECT iri, CAST(position AS BIGINT), name FROM authors WHERE orcid IS NULL"""


def triple_totals(spark, sf_dir):
    """Every statement of every article, counted by predicate and object type."""
    summary = triple_summary(order_triples(spark, sf_dir).where("subject_kind = 'iri'"))
    return summary.groupBy("predicate", "object_type").agg(F.sum("n").alias("n"), F.max("n").alias("most"))


_PEOPLE = "SELECT orcid, name, family, given, k FROM authors WHERE orcid IS NOT NULL"
TRIPLE_TOTALS = WITH + f""",
statements AS (
  SELECT iri AS subject, '{T.RDF_TYPE}' AS predicate, 'iri' AS object_type FROM material
  UNION ALL SELECT orcid, '{T.RDF_TYPE}', 'iri' FROM ({_PEOPLE})
  UNION ALL SELECT orcid, '{T.NAME}', '{T.XSD_STRING}' FROM ({_PEOPLE})
  UNION ALL SELECT orcid, '{T.FAMILY_NAME}', '{T.XSD_STRING}' FROM ({_PEOPLE})
  UNION ALL SELECT orcid, '{T.GIVEN_NAME}', '{T.XSD_STRING}' FROM ({_PEOPLE})
  UNION ALL SELECT iri, '{T.DCT_TITLE}', '{T.XSD_STRING}' FROM material
  UNION ALL SELECT iri, '{T.DCT_CITATION}', '{T.XSD_STRING}' FROM material
  UNION ALL SELECT iri, '{T.DCT_CREATOR}', CASE WHEN has_authors THEN 'blank' ELSE 'iri' END FROM material
  UNION ALL SELECT iri, '{T.PART_OF}', 'blank' FROM material
  UNION ALL SELECT iri, '{T.PAGE_RANGE}', '{T.XSD_STRING}' FROM material
  UNION ALL SELECT iri, '{T.STARTING_PAGE}', '{T.XSD_STRING}' FROM material WHERE first_page IS NOT NULL
  UNION ALL SELECT iri, '{T.ENDING_PAGE}', '{T.XSD_STRING}' FROM material WHERE last_page IS NOT NULL
  UNION ALL SELECT iri, '{T.DOI}', '{T.XSD_STRING}' FROM material WHERE dois <> ''
  UNION ALL SELECT iri, '{T.PUBLICATION_YEAR}', '{T.XSD_GYEAR}' FROM material WHERE pub_year IS NOT NULL
  UNION ALL SELECT iri, '{T.DCT_ISSUED}', '{T.XSD}' || issued_type FROM material WHERE issued IS NOT NULL
  UNION ALL SELECT iri, '{T.DCT_MODIFIED}', '{T.XSD_DATE}' FROM material
  UNION ALL SELECT iri, '{T.DCT_REFERENCES}', 'iri' FROM mesh
)
SELECT predicate, object_type, CAST(sum(n) AS BIGINT) AS n, max(n) AS most FROM (
  SELECT subject, predicate, object_type, count(*) AS n FROM statements GROUP BY 1, 2, 3) GROUP BY 1, 2"""


def load_statistics(spark, sf_dir):
    """Statements about each file: articles read, and statements made."""
    articles = written(order_articles(spark, sf_dir), "articles")
    facts = stats_triples(load_stats(articles, article_triples(articles)))
    return facts.select("subject", "predicate", "object", "datatype")


LOAD_TOTALS = WITH + """,
sizes AS (
  SELECT k, source_file,
    2 + 1 + 1 + 1 + 1 + 7 + CASE WHEN k % 6 = 0 THEN 2 ELSE 1 END + CASE WHEN issue = '' THEN 0 ELSE 3 END
    + CASE WHEN dois = '' THEN 0 ELSE 1 END + CASE WHEN pub_year IS NULL THEN 0 ELSE 2 END
    + CASE WHEN first_page IS NULL THEN 0 ELSE 2 END
    + (SELECT count(*) FROM mesh WHERE mesh.k = material.k)
    + COALESCE((SELECT sum(CASE WHEN family IS NULL THEN 4 ELSE 6 END) FROM authors WHERE authors.k = material.k), 0) AS n
  FROM material
),
totals AS (SELECT source_file, count(*) AS articles, CAST(sum(n) AS BIGINT) AS triples FROM sizes GROUP BY 1)"""
LOAD_STATISTICS = LOAD_TOTALS + f"""
SELECT source_file AS subject, '{T.ARTICLE_COUNT}' AS predicate, CAST(articles AS VARCHAR) AS object, '{T.XSD_INTEGER}' AS datatype FROM totals
UNION ALL SELECT source_file, '{T.TRIPLE_COUNT}', CAST(triples AS VARCHAR), '{T.XSD_INTEGER}' FROM totals"""


def annotated_references(spark, sf_dir):
    """MeSH references and annotation references of one article are one set."""
    articles = written(order_articles(spark, sf_dir, "iri", "source_file", "mesh_ids").select("iri", "source_file", "mesh_ids"), "articles")
    found = articles.select("iri", "source_file", F.explode(F.array(
        F.concat(F.lit("http://id.nlm.nih.gov/mesh/"), F.get("mesh_ids", F.lit(0))), F.concat(F.lit("t:"), F.substring("source_file", 16, 1)))).alias("term_iri"))
    combined = with_annotations(article_triples(articles, ("mesh",)), found)
    return combined.groupBy("subject").agg(F.count("*").alias("n"))


ANNOTATED_REFERENCES = WITH + """
SELECT iri AS subject, count(*) + 1 AS n FROM mesh GROUP BY 1"""


def edges_per_mesh_term(spark, sf_dir):
    triples = order_triples(spark, sf_dir, "metadata", "mesh")
    counts = count_articles_per_term(edges_from_triples(written(edge_statements(triples), "edges")))
    return counts.select("term", "n_articles")


EDGES_PER_MESH_TERM = WITH + "\nSELECT 'http://id.nlm.nih.gov/mesh/' || mesh_id AS term, count(*) AS n_articles FROM mesh GROUP BY 1"


def ntriples_export(spark, sf_dir):
    lines = ntriples_lines(order_triples(spark, sf_dir, "metadata", "dates"))
    return lines.select("value")


NTRIPLES_EXPORT = "SELECT '<' || subject || '> <' || predicate || '> ' || CASE WHEN datatype = '' THEN '<' || object || '>' " \
    f"WHEN datatype = '{T.XSD_STRING}' THEN '\"' || object || '\"' ELSE '\"' || object || '\"^^<' || datatype || '>' END || ' .' AS value " \
    "FROM (" + TRIPLES_METADATA + ")"


def ntriples_round_trip(spark, sf_dir):
    """Statements that differ after being written as lines and read again, per side: none."""
    triples = written(order_triples(spark, sf_dir), "round-trip")
    again = parse_ntriples(ntriples_lines(triples))
    difference = graph_difference(triples, again)
    return difference.agg(F.count("*").alias("n_different"))


NTRIPLES_ROUND_TRIP = "SELECT CAST(0 AS BIGINT) AS n_different"


def graph_isomorphism(spark, sf_dir):
    """The graph against itself with other blank names, read back from lines, and against one with a single link turned."""
    triples = written(order_triples(spark, sf_dir), "graph")
    renamed = parse_ntriples(ntriples_lines(triples))
    for end in ("subject", "object"):
        other = F.concat(F.lit("_:r"), F.md5(F.concat(F.lit("other"), F.reverse(end))))
        renamed = renamed.withColumn(end, F.when(F.col(f"{end}_kind") == "blank", other).otherwise(F.col(end)))
    renamed = written(renamed, "renamed")
    least = renamed.where(F.col("predicate") == T.PART_OF).agg(F.min("subject").alias("_least"))
    chosen = (F.col("predicate") == T.PART_OF) & (F.col("subject") == least.scalar())
    turned = renamed.withColumn("predicate", F.when(chosen, T.DCT_REFERENCES).otherwise(F.col("predicate")))
    same, other = graph_mismatch(triples, renamed), graph_mismatch(triples, turned)
    counts = triples.groupBy("source_file").agg(F.count("*").alias("n_statements"))
    return counts.select("source_file", "n_statements", F.lit(same.isEmpty()).alias("equal_renamed"), F.lit(other.isEmpty()).alias("equal_turned"))


GRAPH_ISOMORPHISM = LOAD_TOTALS + "\nSELECT source_file, triples AS n_statements, true AS equal_renamed, false AS equal_turned FROM totals"


def _chunks(spark, sf_dir):
    records = order_records(spark, sf_dir)
    return records.select("source_file", F.replace(F.col("raw"), F.lit(CLOSING_TAG), F.lit("")).alias("chunk"))


def field_summary(spark, sf_dir):
    return field_counts(_chunks(spark, sf_dir))


_FIELDS = [
    ("MedlineCitation.PMID", "1"), ("MedlineCitation.PMID/Version", "1"),
    *[(f"MedlineCitation.DateRevised.{f}", "1") for f in ("Year", "Month", "Day")],
    ("MedlineCitation.Article.Journal.ISSN/IssnType", "1"), ("MedlineCitation.Article.Journal.ISSN", "1 + CAST(k % 6 = 0 AS INT)"),
    ("MedlineCitation.Article.Journal.JournalIssue.Volume", "1"), ("MedlineCitation.Article.Journal.JournalIssue.Issue", "CAST(k % 3 <> 0 AS INT)"),
    ("MedlineCitation.Article.Journal.JournalIssue.PubDate.Year", "CAST(k % 10 NOT IN (4, 7) AS INT)"),
    ("MedlineCitation.Article.Journal.JournalIssue.PubDate.Month", "CAST(k % 10 IN (0, 1, 2, 5, 8, 9) AS INT)"),
    ("MedlineCitation.Article.Journal.JournalIssue.PubDate.Day", "CAST(k % 10 IN (0, 1, 6, 8, 9) AS INT)"),
    ("MedlineCitation.Article.Journal.JournalIssue.PubDate.MedlineDate", "CAST(k % 10 IN (4, 7) AS INT)"),
    ("MedlineCitation.Article.Journal.Title", "1"), ("MedlineCitation.Article.Journal.ISOAbbreviation", "1"),
    ("MedlineCitation.Article.ArticleTitle", "2"), ("MedlineCitation.Article.ArticleTitle.i", "1"),
    ("MedlineCitation.Article.Pagination.MedlinePgn", "1 + CAST(k % 4 = 2 AS INT)"),
    ("MedlineCitation.Article.Abstract.AbstractText", "2 + CAST(k % 2 = 1 AS INT)"), ("MedlineCitation.Article.Abstract.AbstractText.sub", "1"),
    ("MedlineCitation.Article.Abstract.AbstractText/Label", "1"),
    ("MedlineCitation.Article.AuthorList/CompleteYN", "CAST(k % 11 <> 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author/ValidYN", "CAST(k % 11 <> 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author.LastName", "CAST(k % 11 <> 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author.ForeName", "CAST(k % 11 <> 0 AND c % 4 <> 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author.Initials", "CAST(k % 11 <> 0 AND c % 4 <> 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author.Suffix", "CAST(k % 11 <> 0 AND c % 5 = 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author.Identifier", "CAST(k % 11 <> 0 AND c % 3 = 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author.Identifier/Source", "CAST(k % 11 <> 0 AND c % 3 = 0 AS INT)"),
    ("MedlineCitation.Article.AuthorList.Author.CollectiveName", "CAST(k % 11 <> 0 AND k % 2 = 0 AS INT)"),
    ("MedlineCitation.ChemicalList.Chemical.NameOfSubstance", "1"), ("MedlineCitation.ChemicalList.Chemical.NameOfSubstance/UI", "1"),
    ("MedlineCitation.GeneSymbolList.GeneSymbol", "2 * CAST(k % 4 = 0 AS INT)"),
    ("MedlineCitation.MeshHeadingList.MeshHeading.DescriptorName", "1"), ("MedlineCitation.MeshHeadingList.MeshHeading.DescriptorName/UI", "1"),
    ("MedlineCitation.MeshHeadingList.MeshHeading.QualifierName", "CAST(k % 5 <> 0 AS INT)"),
    ("MedlineCitation.MeshHeadingList.MeshHeading.QualifierName/UI", "CAST(k % 5 <> 0 AS INT)"),
    ("PubmedData.History.PubMedPubDate/PubStatus#pubmed", "1"), ("PubmedData.History.PubMedPubDate.Year", "1"),
    ("PubmedData.ArticleIdList.ArticleId", "2 + CAST(k % 3 AS INT)"), ("PubmedData.ArticleIdList.ArticleId/IdType", "1 + CAST(k % 3 AS INT)"),
]
_FIELD_ROWS = " UNION ALL ".join(
    f"SELECT source_file, 'PubmedArticleSet.PubmedArticle.{path}' AS path, CAST(sum({n}) AS BIGINT) AS n FROM material GROUP BY 1" for path, n in _FIELDS
)
FIELD_SUMMARY = WITH + f"\nSELECT * FROM ({_FIELD_ROWS}) WHERE n > 0"


def sum_outputs(spark, sf_dir):
    """Per-file counts written as lines, parsed again and merged."""
    lines = field_counts(_chunks(spark, sf_dir)).select(F.concat_ws("\t", F.col("n").cast("string"), "path").alias("value"))
    path, n = parse_count_line(F.col("value"))
    return sum_field_counts(lines.select(path.alias("path"), n.alias("n")))


SUM_OUTPUTS = WITH + f"\nSELECT path, CAST(sum(n) AS BIGINT) AS n FROM ({_FIELD_ROWS}) WHERE n > 0 GROUP BY 1"


def article_iris(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(article_iri(F.col("o_orderkey").cast("string")).alias("iri"))


ARTICLE_IRIS = "SELECT 'https://www.ncbi.nlm.nih.gov/pubmed/' || o_orderkey AS iri FROM orders"

QUERIES = {
    "xml_articles": (xml_articles, XML_ARTICLES),
    "partial_date_parse": (partial_date_parse, PARTIAL_DATE_PARSE),
    "date_literals": (date_literals, DATE_LITERALS),
    "date_rejects": (rejected_dates, REJECTED_DATES),
    "orcid_normalize": (orcid_normalize, ORCID_NORMALIZE),
    "author_names": (author_names, AUTHOR_NAMES),
    "article_id_map": (article_id_map, ARTICLE_ID_MAP),
    "triples_metadata": (triples_metadata, TRIPLES_METADATA),
    "page_range_split": (page_range_split, PAGE_RANGE_SPLIT),
    "citation_strings": (citation_strings, CITATION_STRINGS),
    "triples_references": (triples_references, TRIPLES_REFERENCES),
    "journal_chains": (journal_chains, JOURNAL_CHAINS),
    "journal_issns": (journal_issns, JOURNAL_ISSNS),
    "author_list_order": (author_list_order, AUTHOR_LIST_ORDER),
    "triple_summary": (triple_totals, TRIPLE_TOTALS),
    "load_stats": (load_statistics, LOAD_STATISTICS),
    "annotated_references": (annotated_references, ANNOTATED_REFERENCES),
    "edges_per_mesh_term": (edges_per_mesh_term, EDGES_PER_MESH_TERM),
    "ntriples_export": (ntriples_export, NTRIPLES_EXPORT),
    "graph_isomorphism": (graph_isomorphism, GRAPH_ISOMORPHISM),
    "ntriples_round_trip": (ntriples_round_trip, NTRIPLES_ROUND_TRIP),
    "field_summary": (field_summary, FIELD_SUMMARY),
    "sum_outputs": (sum_outputs, SUM_OUTPUTS),
    "article_iris": (article_iris, ARTICLE_IRIS),
}
