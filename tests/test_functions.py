from pyspark.sql import functions as F

from litmine.functions import (
    article_id, citation_string, collapse_whitespace, date_lexical, date_xsd_type,
    escape_query_syntax, first_orcid, full_name, kwic_after, kwic_before, last_of_list,
    normalize_orcid, orcid_list, parse_partial_date, preferred_file, remove_stop_characters,
    short_name, split_page_range,
)

ORCID = "https://orcid.org/0000-0001-5109-3700"


def column(spark, rows, schema, expression):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(expression).collect()]


def test_partial_dates(spark):
    cases = [
        (("2013", "", "", ""), ("year", 2013, None, None, None)),
        (("2013", "Aug", None, None), ("month", 2013, 8, None, None)),
        (("2013", "August", None, None), ("month", 2013, 8, None, None)),
        (("2013", "Aug", "17", None), ("day", 2013, 8, 17, None)),
        ((None, None, None, "2003 Nov-2004 Feb"), ("year", 2003, None, None, None)),
        (("2013", "8", "17", ""), ("day", 2013, 8, 17, None)),
        (("", "", "", "Winter 1994"), ("year", 1994, None, None, None)),
        (("", "", "", "31 Nov-31 Feb"), (None, None, None, None, "Could not parse XML node as date")),
        (("", "", "", ""), (None, None, None, None, "Could not parse XML node as date")),
        (("2007", "", "12", ""), (None, None, None, None, "Could not extract month from node")),
        (("2013", "2", "30", ""), ("month", 2013, 2, None, None)),
        (("2000", "2", "29", ""), ("day", 2000, 2, 29, None)),
        (("1900", "2", "29", ""), ("month", 1900, 2, None, None)),
        (("2013", "13", "1", ""), ("year", 2013, None, None, None)),
        (("2013", "AUG", "", ""), ("year", 2013, None, None, None)),
        (("2013", "Sept", "", ""), ("year", 2013, None, None, None)),
        (("2013", " 8", "", ""), ("year", 2013, None, None, None)),
        (("", "", "", "Nov-Feb"), (None, None, None, None, "Could not parse XML node as date")),
        (("", "", "", "54321 or 1999y 2010"), ("year", 2010, None, None, None)),
    ]
    got = column(spark, [c[0] for c in cases], "y string, m string, d string, f string",
                 parse_partial_date(F.col("y"), F.col("m"), F.col("d"), F.col("f")))
    assert [tuple(g) for g in got] == [c[1] for c in cases]


def test_date_literals(spark):
    parsed = parse_partial_date(F.col("y"), F.col("m"), F.col("d"), F.lit(""))
    rows = [("2013", "Aug", "1"), ("2013", "8", ""), ("2013", "", ""), ("99", "", ""), ("2007", "", "3")]
    df = spark.createDataFrame(rows, "y string, m string, d string").coalesce(1).select(parsed.alias("p"))
    got = df.select(date_lexical(F.col("p")), date_xsd_type(F.col("p"))).collect()
    xsd = "http://www.w3.org/2001/XMLSchema#"
    assert [tuple(r) for r in got] == [
        ("2013-08-01", xsd + "date"), ("2013-08", xsd + "gYearMonth"), ("2013", xsd + "gYear"),
        ("99", xsd + "gYear"), (None, None),
    ]


def test_orcid(spark):
    cases = [
        ("0000000151093700", ORCID), ("0000-0001-5109-3700", ORCID), ("0000 0001 5109 3700", ORCID),
        ("0000-0001 5109-3700", ORCID), ("http://orcid.org/0000-0001-5109-3700", ORCID),
        ("https://orcid.org/0000-0001-5109-3700", ORCID), ('orcid">0000-0003-1415-9269', None),
        ("0000-0003-1415-926", None), ('0000"00151093700', None), ("https://www.orcid.org/0000+0001 5109 3700\n", ORCID),
    ]
    assert column(spark, [(c[0],) for c in cases], "v string", normalize_orcid(F.col("v"))) == [c[1] for c in cases]
    rows = [([("ORCID", "bad"), ("ISNI", "0000000151093700"), ("ORCID", "0000000151093700")],), ([],), (None,)]
    got = column(spark, rows, "i array<struct<_Source:string,_VALUE:string>>", orcid_list(F.col("i")))
    assert got == [[ORCID], [], []]
    assert column(spark, [([ORCID, "x"],), ([],)], "o array<string>", first_orcid(F.col("o"))) == [ORCID, None]


def test_remove_stop_characters(spark):
    cases = [
        ("T cell receptor\\:", "T cell receptor"), ("renal failure.", "renal failure"), ("\\[Table", "Table"), ("\\(D\\),", "D"),
        ("long\\-lived plants \\(an", "long-lived plants"), (". But IL6", "IL6"), ("IL6. (It)", "IL6"), ("KRAS (of", "KRAS"),
        ("(into KRAS", "KRAS"), ("nurse's", "nurse's"), ("", ""), ("the of", ""),
    ]
    assert column(spark, [(c[0],) for c in cases], "s string", remove_stop_characters(F.col("s"))) == [c[1] for c in cases]


def test_escape_and_whitespace(spark):
    assert column(spark, [("a+b (c) \\ x/y",)], "s string", escape_query_syntax(F.col("s"))) == [
        "a\\+b \\(c\\) \\\\ x\\/y"]
    assert column(spark, [("a \t\n b",)], "s string", collapse_whitespace(F.col("s"))) == ["a b"]


def test_kwic_clamps(spark):
    row = spark.createDataFrame([("0123456789",)], "s string").select(
        kwic_before(F.col("s"), F.lit(3), 50), kwic_before(F.col("s"), F.lit(8), 2),
        kwic_after(F.col("s"), F.lit(8), 50), kwic_after(F.col("s"), F.lit(3), 2)).first()
    assert tuple(row) == ("012", "67", "89", "34")


def test_names(spark):
    c, g, la, i, s = (F.col(x) for x in "cglis")
    df = spark.createDataFrame(
        [(("", "Ada", "Byron", "J", "Jr")), ("et al", "", "", "", ""), ("", "", "Ng", "", ""), ("", "R", "Roe", "", "III")],
        "c string, g string, l string, i string, s string").coalesce(1)
    got = df.select(full_name(c, g, la, s), short_name(c, la, i, s)).collect()
    assert [tuple(r) for r in got] == [("Ada Byron Jr", "Byron J Jr"), ("et al", "et al"), (" Ng", "Ng"), ("R Roe III", "Roe III")]


def test_pages(spark):
    rows = [(["88-95"],), (["88 - 95"],), (["88"],), (["1-2", "3-4"],), ([],), (["e1-e2-e3"],), (["-5"],)]
    got = column(spark, rows, "p array<string>", split_page_range(F.col("p")))
    assert [tuple(g) if g else None for g in got] == [("88", "95"), ("88", "95"), None, None, None, ("e1", "e2-e3"), None]


def test_citation(spark):
    row = spark.range(1).select(citation_string(
        F.array(*[F.lit(x) for x in ("Okafor A", "Lindqvist M", "et al")]), F.lit("Moss growth on shaded roofs."),
        F.lit("Annals of lichens"), F.array(F.lit(1999)), F.lit("12"), F.lit("3"), F.lit("41-9"), F.lit("1234"))).first()
    assert row[0] == "Okafor A, Lindqvist M, et al. Moss growth on shaded roofs. Annals of lichens (1999);12(3):41-9. PubMed PMID: 1234"


def test_ids(spark):
    assert column(spark, [("a; b ;",), (" ; ",), (None,), ("x",)], "s string", last_of_list(F.col("s"))) == ["b", "", "", "x"]
    df = spark.createDataFrame([("p1;p2", "d1"), ("", "d1; d2"), (None, None)], "p string, d string").coalesce(1)
    assert [r[0] for r in df.select(preferred_file(F.col("p"), F.col("d"))).collect()] == ["p2", "d2", ""]
    df = spark.createDataFrame([("1", "d", "p"), ("", "d", "p"), (None, "", "p"), (None, None, "")], "a string, b string, c string").coalesce(1)
    got = [r[0] for r in df.select(article_id(F.col("a"), F.col("b"), F.col("c"), F.lit("u:7"))).collect()]
    assert got == ["PMID:1", "DOI:d", "PMCID:p", "CORD_UID:u:7"]
