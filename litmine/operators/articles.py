"""Article rows from parsed records."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litmine.functions.dates import parse_partial_date
from litmine.functions.ids import article_iri
from litmine.functions.names import family_name, full_name, short_name
from litmine.functions.orcid import orcid_list
from litmine.functions.text import let, text_or_empty
from litmine.sources.articles_xml import parse_record, record_schema

AUTHOR = (
    "struct<collective:string,given:string,last:string,initials:string,suffix:string,"
    "orcids:array<string>,family:string,name:string,short:string>"
)
MALFORMED = "Malformed record"
# The elements that each column is read from, and the columns that others are derived from.
READ_FROM = {
    "source_file": (), "blank_seed": (), "pmid": ("PMID",), "title": ("ArticleTitle",), "abstract_text": ("Abstract", "OtherAbstract"),
    "journal_volume": ("JournalIssue",), "journal_issue": ("JournalIssue",), "journal_title": ("Title",), "journal_abbr": ("ISOAbbreviation",),
    "issns": ("ISSN",), "pub_dates": ("JournalIssue",), "article_dates": ("ArticleDate",), "revised_dates": ("DateRevised",),
    "medline_pgn": ("Pagination",), "article_ids": ("ArticleIdList", "Reference"), "authors": ("AuthorList",), "gene_symbols": ("GeneSymbolList",),
    "mesh_ids": ("MeshHeadingList", "ChemicalList"), "mesh_labels": ("MeshHeadingList", "ChemicalList"),
}
DERIVED_FROM = {
    "pub_years": ("pub_dates",), "medline_pagination": ("medline_pgn",), "dois": ("article_ids",),
    "as_string": ("title", "abstract_text", "mesh_labels", "gene_symbols"), "iri": ("pmid",),
}


def _texts(values: Column) -> Column:
    """An array of texts; a missing array is empty, a missing text is ''."""
    return F.coalesce(F.transform(values, text_or_empty), F.array().cast("array<string>"))


def _all(values: Column, of: str) -> Column:
    """``of`` of every element of an array, as one flat array (missing ones skipped)."""
    nested = F.filter(F.transform(values, lambda v: v[of]), lambda v: v.isNotNull())
    return F.flatten(nested)


def author_struct(
    collective: Column, given: Column, last: Column, initials: Column, suffix: Column, orcids: Column
) -> Column:
    """An author with the derived names."""
    parts = {"collective": collective, "given": given, "last": last, "initials": initials, "suffix": suffix}

    def with_names(p: Column) -> Column:
        return F.struct(
            *[p[f].alias(f) for f in (*parts, "orcids")],
            family_name(p["last"], p["suffix"]).alias("family"),
            full_name(p["collective"], p["given"], p["last"], p["suffix"]).alias("name"),
            short_name(p["collective"], p["last"], p["initials"], p["suffix"]).alias("short"),
        )

    texts = [text_or_empty(value).alias(name) for name, value in parts.items()]
    return let(F.struct(*texts, orcids.cast("array<string>").alias("orcids")), with_names)


def et_al() -> Column:
    """The entry that closes an incomplete author list."""
    none = F.lit("")
    return author_struct(F.lit("et al"), none, none, none, none, F.array())


def _authors(lists: Column) -> Column:
    first = F.get(lists, F.lit(0))
    named = F.transform(
        first["Author"],
        lambda a: author_struct(
            a["CollectiveName"], a["ForeName"], a["LastName"], a["Initials"], a["Suffix"], orcid_list(a["Identifier"])
        ),
    )
    named = F.coalesce(named, F.array().cast(f"array<{AUTHOR}>"))
    return F.when(first["_CompleteYN"] == "N", F.concat(named, F.array(et_al()))).otherwise(named)


def _dates(nodes: Column) -> Column:
    parsed = F.transform(nodes, lambda d: parse_partial_date(d["Year"], d["Month"], d["Day"], d["MedlineDate"]))
    return F.coalesce(parsed, F.array().cast("array<struct<precision:string,year:int,month:int,day:int,error:string>>"))


def group_values(pairs: Column, key: str, value: str, missing: str = "unknown") -> Column:
    """``map<key, array<value>>`` from an array of structs, in order of appearance."""
    keyed = F.transform(
        pairs, lambda p: F.struct(F.coalesce(p[key], F.lit(missing)).alias("k"), text_or_empty(p[value]).alias("v"))
    )
    keyed = F.coalesce(keyed, F.array().cast("array<struct<k:string,v:string>>"))
    return F.map_from_entries(
        F.transform(
            F.array_distinct(F.transform(keyed, lambda p: p["k"])),
            lambda k: F.struct(k, F.transform(F.filter(keyed, lambda p: p["k"] == k), lambda p: p["v"])),
        )
    )


def _extracted(columns: Iterable[str]) -> list[str]:
    """The columns to extract from records for ``columns``."""
    wanted = {base for c in columns for base in DERIVED_FROM.get(c, (c,))}
    return [c for c in READ_FROM if c in wanted]


def parse_records(records: DataFrame, columns: Collection[str] | None = None) -> DataFrame:
    """``records(source_file, raw)`` plus the parsed struct columns and ``_corrupt_record``.

    The parsed struct comes out of a generator, so that no later filter is
    pushed below it and parses the record a second time. ``columns`` names the columns of
    :func:`articles_from_parsed` that are wanted: elements that none of them is read from are
    passed over. Every record is still read to its end, so the same ones are malformed.
    """
    schema = record_schema(None if columns is None else {e for c in _extracted(columns) for e in READ_FROM[c]} | {"PMID"})
    return records.select("source_file", "raw", F.inline_outer(F.array(parse_record(F.col("raw"), schema))))


def malformed_records(parsed: DataFrame) -> DataFrame:
    """The rejects of :func:`parse_records`: ``(source_file, raw, reason)``."""
    return parsed.where(F.col("_corrupt_record").isNotNull()).select("source_file", "raw", F.lit(MALFORMED).alias("reason"))


def articles_from_parsed(
    parsed: DataFrame, own_ids_only: bool = False, keep_empty_mesh_ids: bool = False, columns: Collection[str] | None = None
) -> DataFrame:
    """One row per well-formed record, with every extracted field, or those that ``columns`` (of :func:`parse_records`) are made of.

    Missing text fields are empty strings. ``own_ids_only`` leaves out the
    identifiers of cited works. ``blank_seed`` is a hash of the record, from
    which its blank nodes are named.
    """
    citation, article = F.col("MedlineCitation"), F.col("MedlineCitation.Article")
    journal, data = F.col("MedlineCitation.Article.Journal"), F.col("PubmedData")

    ids = _all(data["ArticleIdList"], "ArticleId")
    if not own_ids_only:
        cited = F.coalesce(
            _all(_all(data["Reference"], "ArticleIdList"), "ArticleId"), F.array().cast("array<struct<_IdType:string,_VALUE:string>>")
        )
        ids = F.concat(F.coalesce(ids, F.array().cast("array<struct<_IdType:string,_VALUE:string>>")), cited)

    headings = citation["MeshHeadingList"]["MeshHeading"]
    tagged = "array<struct<_UI:string,_VALUE:string>>"
    nothing = F.array().cast(tagged)
    heading_tags = F.transform(
        headings,
        lambda h: F.concat(F.coalesce(h["DescriptorName"], nothing), F.coalesce(h["QualifierName"], nothing)),
    )
    heading_tags = F.coalesce(heading_tags, F.array().cast(f"array<{tagged}>"))
    substances = F.coalesce(_all(citation["ChemicalList"]["Chemical"], "NameOfSubstance"), nothing)
    mesh_ids = F.array_distinct(
        F.transform(F.concat(F.flatten(heading_tags), substances), lambda t: text_or_empty(t["_UI"]))
    )
    if not keep_empty_mesh_ids:
        mesh_ids = F.filter(mesh_ids, lambda m: m != "")
    mesh_labels = F.array_distinct(
        F.concat(
            F.transform(heading_tags, lambda ts: F.array_join(F.transform(ts, lambda t: text_or_empty(t["_VALUE"])), " ")),
            F.transform(substances, lambda t: text_or_empty(t["_VALUE"])),
        )
    )
    issues = journal["JournalIssue"]
    abstracts = F.concat(_texts(_all(article["Abstract"], "AbstractText")), _texts(_all(citation["OtherAbstract"], "AbstractText")))

    fields = [
        F.col("source_file"),
        F.sha2("raw", 256).alias("blank_seed"),
        text_or_empty(citation["PMID"]).alias("pmid"),
        F.array_join(_texts(article["ArticleTitle"]), " ").alias("title"),
        F.array_join(abstracts, " ").alias("abstract_text"),
        F.array_join(_texts(_all(issues, "Volume")), ", ").alias("journal_volume"),
        F.array_join(_texts(_all(issues, "Issue")), ", ").alias("journal_issue"),
        F.array_join(_texts(journal["Title"]), ", ").alias("journal_title"),
        F.array_join(_texts(journal["ISOAbbreviation"]), ", ").alias("journal_abbr"),
        F.coalesce(
            F.transform(journal["ISSN"], lambda i: F.struct(i["_IssnType"].alias("type"), text_or_empty(i["_VALUE"]).alias("value"))),
            F.array().cast("array<struct<type:string,value:string>>"),
        ).alias("issns"),
        _dates(_all(issues, "PubDate")).alias("pub_dates"),
        _dates(article["ArticleDate"]).alias("article_dates"),
        _dates(citation["DateRevised"]).alias("revised_dates"),
        _texts(_all(article["Pagination"], "MedlinePgn")).alias("medline_pgn"),
        group_values(ids, "_IdType", "_VALUE").alias("article_ids"),
        _authors(article["AuthorList"]).alias("authors"),
        F.array_join(_texts(_all(citation["GeneSymbolList"], "GeneSymbol")), " ").alias("gene_symbols"),
        mesh_ids.alias("mesh_ids"),
        mesh_labels.alias("mesh_labels"),
    ]
    chosen = READ_FROM if columns is None else _extracted(columns)
    extracted = parsed.where(F.col("_corrupt_record").isNull()).select(*[f for c, f in zip(READ_FROM, fields) if c in chosen])
    return derive_article_columns(extracted)


def derive_article_columns(articles: DataFrame) -> DataFrame:
    """Add the columns that follow from the extracted ones that are there."""
    parsed_years = F.filter("pub_dates", lambda d: d["error"].isNull())
    derived = {
        "pub_years": F.transform(parsed_years, lambda d: d["year"]),
        "medline_pagination": F.array_join("medline_pgn", ", "),
        "dois": F.coalesce(F.try_element_at("article_ids", F.lit("doi")), F.array().cast("array<string>")),
        "as_string": F.concat_ws(" ", "title", "abstract_text", F.array_join("mesh_labels", " "), "gene_symbols"),
        "iri": article_iri(F.col("pmid")),
    }
    there = set(articles.columns)
    return articles.select("*", *[column.alias(c) for c, column in derived.items() if there.issuperset(DERIVED_FROM[c])])


def date_rejects(articles: DataFrame) -> DataFrame:
    """``(iri, source_file, field, reason)`` for every date that could not be read; the article is kept."""
    def failures_of(field: str) -> Column:
        failed = F.filter(field, lambda d: d["error"].isNotNull())
        return F.transform(failed, lambda d: F.struct(F.lit(field).alias("field"), d["error"].alias("reason")))

    failures = F.concat(*[failures_of(f) for f in ("pub_dates", "article_dates", "revised_dates")])
    return articles.select("iri", "source_file", F.inline(failures))
