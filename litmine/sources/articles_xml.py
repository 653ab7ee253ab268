"""Article XML: one raw record per row, found by the record's closing tag."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from litmine.functions.text import let
from litmine.session import spread

RECORD_TAG = "PubmedArticle"
CLOSING_TAG = f"</{RECORD_TAG}>"

# The record layout. All leaves are text; repeated elements are
# arrays; attributes carry an underscore.
_DATE = "struct<Year:string,Month:string,Day:string,MedlineDate:string>"
_TAGGED = "struct<_UI:string,_VALUE:string>"
_ID_LIST = "array<struct<ArticleId:array<struct<_IdType:string,_VALUE:string>>>>"
_REFERENCE = f"array<struct<ArticleIdList:{_ID_LIST}>>"
_AUTHOR = (
    "struct<LastName:string,ForeName:string,Initials:string,Suffix:string,CollectiveName:string,"
    "Identifier:array<struct<_Source:string,_VALUE:string>>>"
)
_LAYOUT = {
    "MedlineCitation": {
        "PMID": "string",
        "DateRevised": f"array<{_DATE}>",
        "Article": {
            "Journal": {
                "ISSN": "array<struct<_IssnType:string,_VALUE:string>>",
                "JournalIssue": f"array<struct<Volume:array<string>,Issue:array<string>,PubDate:array<{_DATE}>>>",
                "Title": "array<string>", "ISOAbbreviation": "array<string>",
            },
            "ArticleTitle": "array<string>",
            "Pagination": "array<struct<MedlinePgn:array<string>>>",
            "Abstract": "array<struct<AbstractText:array<string>>>",
            "AuthorList": f"array<struct<_CompleteYN:string,Author:array<{_AUTHOR}>>>",
            "ArticleDate": f"array<{_DATE}>",
        },
        "ChemicalList": f"struct<Chemical:array<struct<NameOfSubstance:array<{_TAGGED}>>>>",
        "GeneSymbolList": "array<struct<GeneSymbol:array<string>>>",
        "MeshHeadingList": f"struct<MeshHeading:array<struct<DescriptorName:array<{_TAGGED}>,QualifierName:array<{_TAGGED}>>>>",
        "OtherAbstract": "array<struct<AbstractText:array<string>>>",
    },
    "PubmedData": {"ArticleIdList": _ID_LIST, "Reference": _REFERENCE},
}


def record_schema(elements: Collection[str] | None = None) -> str:
    """The schema of a record, or of the named elements of it (``Article`` and ``Journal`` hold others and are not named)."""
    def layout(fields: dict) -> dict:
        kept = {name: layout(of) if isinstance(of, dict) else of for name, of in fields.items() if isinstance(of, dict) or elements is None or name in elements}
        return {name: of for name, of in kept.items() if of}

    def ddl(of: dict | str) -> str:
        return of if isinstance(of, str) else "struct<" + ",".join(f"{name}:{ddl(inner)}" for name, inner in of.items()) + ">"

    return ", ".join([f"{name} {ddl(of)}" for name, of in layout(_LAYOUT).items()] + ["_corrupt_record string"])


ARTICLE_SCHEMA = record_schema()

# Markup in other texts, such as names and journal titles. An escaped tag (``&lt;i&gt;``) is text and is not touched.
# Lists of references nest to any depth; without their tags all references lie directly in the record's data.
OTHER_MARKUP = r"<(?:/?(?:ReferenceList|b|i|u|sub|sup|DispFormula|mml:[A-Za-z]+)(?:\s[^<>]*)?/?>|!--(?s:.*?)-->)"
# Elements whose text is everything below them, whatever the tags.
DEEP_TEXT = ("ArticleTitle", "AbstractText")
_NAMES = "|".join(DEEP_TEXT)
_ATTRIBUTES = r"""(?:\s(?:[^<>"']|"[^"]*"|'[^']*')*+(?<!/))?"""
DEEP_OPEN = rf"<(?:{_NAMES}){_ATTRIBUTES}>"
DEEP_CLOSE = rf"</(?:{_NAMES})\s*>"
# Runs up to the next "<" that matters are possessive: each character is looked at once.
DEEP_PIECES = (
    rf"(?s){DEEP_OPEN}[^<]*+(?:(?!{DEEP_CLOSE})<[^<]*+)*+{DEEP_CLOSE}"
    rf"|.[^<]*+(?:(?!{DEEP_OPEN})<[^<]*+)*+"
)
CDATA_PIECES = r"(?s)<!\[CDATA\[.*?\]\]>|.[^<]*+(?:(?!<!\[CDATA\[)<[^<]*+)*+"
ANY_TAG = r"""<!--(?s:.*?)-->|<[/?]?[A-Za-z_](?:[^<>"']|"[^"]*"|'[^']*')*+>"""


def _without_tags(content: Column) -> Column:
    """The text of an element's content, still escaped: tags and comments go, CDATA sections become escaped text."""
    def plain(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(10), F.length(piece) - 12)
        for char, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            inner = F.replace(inner, F.lit(char), F.lit(escaped))
        return F.when(piece.startswith("<![CDATA["), inner).otherwise(F.regexp_replace(piece, ANY_TAG, ""))

    tagged = F.array_join(F.transform(F.regexp_extract_all(content, F.lit(CDATA_PIECES), F.lit(0)), plain), "")
    return F.when(F.contains(content, F.lit("<")), tagged).otherwise(content)


def with_deep_text(raw: Column) -> Column:
    """The record with plain, escaped text in the elements of :data:`DEEP_TEXT`, and without inline markup elsewhere."""
    def deep(piece: Column) -> Column:
        opening, closing = F.regexp_extract(piece, rf"\A{DEEP_OPEN}", 0), F.regexp_extract(piece, r"</[A-Za-z]+\s*>\z", 0)
        content = F.substring(piece, F.length(opening) + 1, F.length(piece) - F.length(opening) - F.length(closing))
        return F.concat(opening, let(content, _without_tags), closing)

    def cleaned(piece: Column) -> Column:
        return F.when(piece.rlike(rf"\A{DEEP_OPEN}"), deep(piece)).otherwise(F.regexp_replace(piece, OTHER_MARKUP, ""))

    return F.array_join(F.transform(F.regexp_extract_all(raw, F.lit(DEEP_PIECES), F.lit(0)), cleaned), "")


def read_chunks(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``(source_file, chunk)``: file text cut after every closing record tag.

    A directory is listed without its sub-folders; give ``glob``
    (``*.xml.gz``) to choose the files in it. Plain files are split;
    compressed files are one task each and are spread over the cores right
    after the scan.
    """
    reader = spark.read.option("lineSep", CLOSING_TAG)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    chunks = reader.text(path).select(F.col("_metadata.file_path").alias("source_file"), F.col("value").alias("chunk"))
    return spread(chunks)


def record_of(chunk: Column) -> Column:
    """The raw record inside a chunk, or the empty string."""
    body = F.regexp_extract(chunk, rf"(?s)<{RECORD_TAG}(?=[\s>]).*\z", 0)
    return F.when(body != "", F.concat(body, F.lit(CLOSING_TAG))).otherwise("")


def read_article_records(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``(source_file, raw)``, one row per article record; other record types are ignored."""
    return (
        read_chunks(spark, path, glob)
        .select("source_file", record_of(F.col("chunk")).alias("raw"))
        .where(F.col("raw") != "")
    )


def parse_record(raw: Column, schema: str = ARTICLE_SCHEMA) -> Column:
    """The record as a struct of ``schema``; whitespace is kept."""
    return F.from_xml(
        with_deep_text(raw),
        schema,
        {"rowTag": RECORD_TAG, "attributePrefix": "_", "valueTag": "_VALUE", "ignoreSurroundingSpaces": "false"},
    )
