"""The driver's tables, and article records rendered from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litmine.operators.articles import articles_from_parsed, parse_records
from litmine.operators.triples import GROUP_COLUMNS, GROUPS, article_triples
from litmine.session import spread, spread_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


def _element(tag: str, *content: Column | str, **attributes: str) -> Column:
    """``<tag ...>content</tag>`` as a string column."""
    opening = "<" + tag + "".join(f' {k}="{v}"' for k, v in attributes.items()) + ">"
    parts = [F.lit(c) if isinstance(c, str) else c.cast("string") for c in content]
    return F.concat(F.lit(opening), *parts, F.lit(f"</{tag}>"))


def _when(condition: Column, value: Column | str) -> Column:
    return F.when(condition, value).otherwise("")


def orcid_spelling(key: Column) -> Column:
    """A 16-digit code from a key, spelled in one of eight ways."""
    code = F.lpad(key.cast("string"), 16, "0")

    def grouped(separator: str) -> Column:
        return F.concat_ws(separator, *[F.substring(code, i, 4) for i in (1, 5, 9, 13)])

    way, dashed = key % 8, grouped("-")
    return (
        F.when(way == 0, code).when(way == 1, dashed).when(way == 2, grouped(" "))
        .when(way == 3, F.concat(F.substring(dashed, 1, 9), F.lit(" "), F.substring(dashed, 11, 9)))
        .when(way == 4, F.concat(F.lit("http://orcid.org/"), dashed))
        .when(way == 5, F.concat(F.lit("https://orcid.org/"), dashed))
        .when(way == 6, F.concat(F.lit('orcid"'), dashed))
        .otherwise(F.substring(dashed, 1, 18))
    )


def date_fields(key: Column, date: Column) -> dict[str, Column]:
    """Year, Month, Day and MedlineDate texts of a date, written in one of ten ways."""
    way = key % 10
    year, month, day = F.year(date), F.month(date), F.day(date)
    has_year = ~way.isin(4, 7)
    return {
        "year": _when(has_year, year.cast("string")),
        "month": F.when(way == 0, month.cast("string")).when(way == 1, F.date_format(date, "MMM"))
        .when(way == 2, F.date_format(date, "MMMM")).when(way == 5, F.upper(F.date_format(date, "MMMM")))
        .when(way == 8, "2").when(way == 9, "13").otherwise(""),
        "day": F.when(way.isin(0, 1, 6), day.cast("string")).when(way == 8, "30").when(way == 9, "1").otherwise(""),
        "medline": F.when(way == 4, F.concat(year.cast("string"), F.lit(" Dec-"), (year + 1).cast("string"), F.lit(" Jan")))
        .when(way == 7, "Dec-Jan").otherwise(""),
    }


def order_rows(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Orders (those ``where`` holds) with customer, nation and region: the material of one article each."""
    orders = table(spark, sf_dir, "orders").where(F.lit(True) if where is None else where).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    wide = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(
        nations.select("n_nationkey", "n_name", "r_name"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return spread_rows(wide, orders.count())


def spread_orders(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Orders for queries that make one record of each."""
    orders = table(spark, sf_dir, "orders").select(*columns)
    return spread_rows(orders, orders.count())


def order_records(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """``(source_file, raw)``: every order (``where``: those it holds for) written as an article record."""
    k, c, date = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    d = date_fields(k, date)

    def part(tag: str, value: Column) -> Column:
        return _when(value != "", _element(tag, value))

    pub_date = _element("PubDate", part("Year", d["year"]), part("Month", d["month"]), part("Day", d["day"]), part("MedlineDate", d["medline"]))
    revised = _element("DateRevised", _element("Year", F.year(date)), _element("Month", F.month(date)), _element("Day", F.day(date)))
    journal = _element(
        "Journal",
        F.when(k % 2 == 0, _element("ISSN", F.col("n_nationkey"), IssnType="Electronic")).otherwise(
            _element("ISSN", F.col("n_nationkey"), IssnType="Print")),
        _when(k % 6 == 0, _element("ISSN", "x", F.col("n_nationkey"))),
        _element("JournalIssue", _element("Volume", F.year(date)), _when(k % 3 != 0, _element("Issue", F.month(date))), pub_date),
        _element("Title", "Journal of ", F.col("n_name")),
        _element("ISOAbbreviation", F.col("r_name")),
    )
    title = _element("ArticleTitle", "The <i>", F.col("o_orderpriority"), "</i> order &lt;", k, "&gt;", _when(k % 2 == 0, "."))
    pages = _element(
        "Pagination",
        F.when(k % 4 == 0, _element("MedlinePgn", k, "-", k + 7)).when(k % 4 == 1, _element("MedlinePgn", k))
        .when(k % 4 == 2, F.concat(_element("MedlinePgn", k, "-", k + 7), _element("MedlinePgn", "e1-2")))
        .otherwise(_element("MedlinePgn", k, " - ", k + 7)),
    )
    abstract = _element(
        "Abstract", _element("AbstractText", "Placed by H<sub>2</sub>O &amp; ", F.col("c_name"), ".", Label="A"),
        _when(k % 2 == 1, _element("AbstractText", "Second part.")),
    )
    person = _element(
        "Author", _element("LastName", F.col("c_name")), _when(c % 4 != 0, _element("ForeName", F.col("c_mktsegment"))),
        _when(c % 4 != 0, _element("Initials", F.substring("c_mktsegment", 1, 1))), _when(c % 5 == 0, _element("Suffix", "Jr")),
        _when(c % 3 == 0, _element("Identifier", orcid_spelling(c), Source="ORCID")), ValidYN="Y",
    )
    people = F.concat(person, _when(k % 2 == 0, _element("Author", _element("CollectiveName", F.col("n_name")))))
    authors = F.when(k % 11 == 0, "").when(k % 7 == 0, _element("AuthorList", people, CompleteYN="N")).otherwise(
        _element("AuthorList", people, CompleteYN="Y"))
    chemical = _element("ChemicalList", _element("Chemical", F.concat(F.lit('<NameOfSubstance UI="D'), k % 50, F.lit('">Substance '), k % 50, F.lit("</NameOfSubstance>"))))
    heading = F.concat(
        F.lit('<MeshHeading><DescriptorName UI="D'), c, F.lit('">'), F.col("c_mktsegment"), F.lit("</DescriptorName>"),
        _when(k % 5 != 0, F.concat(F.lit('<QualifierName UI="Q'), F.col("n_nationkey"), F.lit('">'), F.col("n_name"), F.lit("</QualifierName>"))),
        F.lit("</MeshHeading>"),
    )
    ids = _element(
        "ArticleIdList", _element("ArticleId", k, IdType="pubmed"), _when(k % 3 != 0, _element("ArticleId", "10.1/", k, IdType="doi")),
        _when(k % 3 == 2, _element("ArticleId", "10.2/", k, IdType="doi")), _element("ArticleId", "x", k),
    )
    raw = _element(
        "PubmedArticle",
        _element(
            "MedlineCitation", _element("PMID", k, Version="1"), revised,
            _element("Article", journal, title, pages, abstract, authors),
            chemical, _when(k % 4 == 0, _element("GeneSymbolList", _element("GeneSymbol", "g", k % 10), _element("GeneSymbol", "h"))),
            _element("MeshHeadingList", heading),
        ),
        _element("PubmedData", _element("History", _element("PubMedPubDate", _element("Year", F.year(date)), PubStatus="pubmed")), ids),
    )
    source = F.concat(F.lit("file:/articles/"), F.col("o_orderstatus"), F.lit(".xml.gz"))
    return order_rows(spark, sf_dir, where).select(source.alias("source_file"), raw.alias("raw"))


def articles_of(records: DataFrame, *columns: str) -> DataFrame:
    """Records, parsed into article rows; with ``columns`` only what these are made of."""
    wanted = columns or None
    return articles_from_parsed(parse_records(records, wanted), columns=wanted)


def order_articles(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The records, parsed back into article rows."""
    return articles_of(order_records(spark, sf_dir), *columns)


def order_triples(spark: SparkSession, sf_dir: str, *groups: str, keep: Sequence[Column] = ()) -> DataFrame:
    """The statements of the records, of the named groups or all; ``keep`` as in :func:`article_triples`."""
    chosen = groups or tuple(GROUPS)
    columns = {c for g in chosen for c in GROUP_COLUMNS[g]}
    return article_triples(order_articles(spark, sf_dir, "source_file", *sorted(columns)), chosen, keep)


# The same material in SQL, straight from the tables: one row per order.
ARTICLES_SQL = """
orders_wide AS (
  SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS d,
         o_orderpriority AS priority, c_name, c_mktsegment AS segment, n_nationkey AS nation, n_name, r_name
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
),
codes AS (
  SELECT *, lpad(CAST(c AS VARCHAR), 16, '0') AS code FROM orders_wide
),
material AS (
  SELECT *,
    CAST(k AS VARCHAR) AS pmid,
    'https://www.ncbi.nlm.nih.gov/pubmed/' || k AS iri,
    'file:/articles/' || status || '.xml.gz' AS source_file,
    'The ' || priority || ' order <' || k || '>' || CASE WHEN k % 2 = 0 THEN '.' ELSE '' END AS title,
    'Placed by H2O & ' || c_name || '.' || CASE WHEN k % 2 = 1 THEN ' Second part.' ELSE '' END AS abstract_text,
    CAST(year(d) AS VARCHAR) AS volume,
    CASE WHEN k % 3 = 0 THEN '' ELSE CAST(month(d) AS VARCHAR) END AS issue,
    'Journal of ' || n_name AS journal,
    CASE k % 4 WHEN 0 THEN k || '-' || (k + 7) WHEN 1 THEN CAST(k AS VARCHAR)
      WHEN 2 THEN k || '-' || (k + 7) || ', e1-2' ELSE k || ' - ' || (k + 7) END AS pages,
    CASE WHEN k % 4 IN (0, 3) THEN CAST(k AS VARCHAR) END AS first_page,
    CASE WHEN k % 4 IN (0, 3) THEN CAST(k + 7 AS VARCHAR) END AS last_page,
    CASE k % 3 WHEN 0 THEN '' WHEN 1 THEN '10.1/' || k ELSE '10.1/' || k || ', 10.2/' || k END AS dois,
    CASE WHEN k % 10 IN (0, 1) THEN 'day' WHEN k % 10 IN (2, 8) THEN 'month'
      WHEN k % 10 IN (3, 4, 5, 9) THEN 'year' END AS pub_precision,
    CASE WHEN k % 10 NOT IN (6, 7) THEN year(d) END AS pub_year,
    CASE WHEN k % 10 IN (0, 1, 2) THEN month(d) WHEN k % 10 = 8 THEN 2 END AS pub_month,
    CASE WHEN k % 10 IN (0, 1) THEN day(d) END AS pub_day,
    CASE k % 10 WHEN 6 THEN 'Could not extract month from node' WHEN 7 THEN 'Could not parse XML node as date' END AS pub_error,
    CASE WHEN k % 10 IN (0, 1) THEN strftime(d, '%Y-%m-%d') WHEN k % 10 = 2 THEN strftime(d, '%Y-%m')
      WHEN k % 10 = 8 THEN year(d) || '-02' WHEN k % 10 NOT IN (6, 7) THEN CAST(year(d) AS VARCHAR) END AS issued,
    CASE WHEN k % 10 IN (0, 1) THEN 'date' WHEN k % 10 IN (2, 8) THEN 'gYearMonth'
      WHEN k % 10 NOT IN (6, 7) THEN 'gYear' END AS issued_type,
    strftime(d, '%Y-%m-%d') AS modified,
    CASE WHEN c % 4 = 0 THEN '' ELSE segment END AS given,
    c_name || CASE WHEN c % 5 = 0 THEN ' Jr' ELSE '' END AS family,
    c_name || CASE WHEN c % 4 = 0 THEN '' ELSE ' ' || substr(segment, 1, 1) END || CASE WHEN c % 5 = 0 THEN ' Jr' ELSE '' END AS short,
    CASE WHEN c % 3 = 0 AND c % 8 < 6 THEN 'https://orcid.org/' || substr(code, 1, 4) || '-' || substr(code, 5, 4) || '-' ||
      substr(code, 9, 4) || '-' || substr(code, 13, 4) END AS orcid,
    k % 11 <> 0 AS has_authors
  FROM codes
),
authors AS (
  SELECT k, iri, source_file, 0 AS position, given || ' ' || family AS name, family, given, short, orcid FROM material WHERE has_authors
  UNION ALL
  SELECT k, iri, source_file, 1, n_name, NULL, NULL, n_name, NULL FROM material WHERE has_authors AND k % 2 = 0
  UNION ALL
  SELECT k, iri, source_file, CASE WHEN k % 2 = 0 THEN 2 ELSE 1 END, 'et al', NULL, NULL, 'et al', NULL
  FROM material WHERE has_authors AND k % 7 = 0
),
mesh AS (
  SELECT k, iri, source_file, 'D' || c AS mesh_id FROM material
  UNION SELECT k, iri, source_file, 'Q' || nation FROM material WHERE k % 5 <> 0
  UNION SELECT k, iri, source_file, 'D' || (k % 50) FROM material
)
"""
