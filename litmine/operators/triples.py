"""Bibliographic triples from article rows.

All triples of one article are built as an array in its own row and made
distinct there, so no shuffle is needed for the per-article set. Blank node
ids depend on the record alone, which makes two graphs comparable row by row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litmine.functions import terms as T
from litmine.functions.citation import citation_string
from litmine.functions.dates import date_lexical, date_xsd_type
from litmine.functions.ids import blank_node, mesh_iri
from litmine.functions.orcid import first_orcid
from litmine.functions.pages import split_page_range
from litmine.operators.sizing import broadcast_if_small
from litmine.session import written

TRIPLE_COLUMNS = ["subject", "subject_kind", "predicate", "object", "object_kind", "datatype"]
TRIPLE = "struct<" + ",".join(f"{c}:string" for c in TRIPLE_COLUMNS) + ">"
# U+0001 cannot occur in XML text, so it separates the fields of a triple safely.
FIELD_SEPARATOR = "\u0001"


def _kind(node: Column) -> Column:
    return F.when(node.startswith("_:"), "blank").otherwise("iri")


def _triple(subject: Column, predicate: str | Column, obj: Column, kind: Column | str, datatype: Column | str = "") -> Column:
    def lift(x):
        return F.lit(x) if isinstance(x, str) else x

    return F.struct(
        subject.alias("subject"), _kind(subject).alias("subject_kind"), lift(predicate).alias("predicate"),
        obj.alias("object"), lift(kind).alias("object_kind"), lift(datatype).alias("datatype"),
    )


def literal(subject: Column, predicate: str | Column, value: Column, datatype: str | Column = T.XSD_STRING) -> Column:
    return _triple(subject, predicate, value, "literal", datatype)


def link(subject: Column, predicate: str, node: Column) -> Column:
    return _triple(subject, predicate, node, _kind(node))


def _typed(subject: Column, class_iri: str) -> Column:
    return link(subject, T.RDF_TYPE, F.lit(class_iri))


def _empty() -> Column:
    return F.array().cast(f"array<{TRIPLE}>")


def _distinct(triples: Column) -> Column:
    """Set semantics for an array of triples (hashing strings; structs would be compared pairwise)."""
    joined = F.transform(triples, lambda t: F.concat_ws(FIELD_SEPARATOR, *[t[c] for c in TRIPLE_COLUMNS]))
    fields = F.transform(F.array_distinct(joined), lambda s: F.split(s, FIELD_SEPARATOR))
    return F.transform(fields, lambda f: F.struct(*[f[i].alias(c) for i, c in enumerate(TRIPLE_COLUMNS)]))


def _distinct_if(condition: Column, triples: Column) -> Column:
    return F.when(condition, _distinct(triples)).otherwise(triples)


def metadata_triples() -> Column:
    """Type, title, DOIs (one literal) and publication years."""
    iri = F.col("iri")
    return F.concat(
        F.array(_typed(iri, T.ARTICLE_CLASS), literal(iri, T.DCT_TITLE, F.col("title"))),
        F.when(F.size("dois") > 0, F.array(literal(iri, T.DOI, F.array_join("dois", ", ")))).otherwise(_empty()),
        F.transform(F.array_distinct("pub_years"), lambda y: literal(iri, T.PUBLICATION_YEAR, y.cast("string"), T.XSD_GYEAR)),
    )


def page_triples() -> Column:
    """The page range always; first and last page if there is exactly one range to split."""
    iri, pages = F.col("iri"), split_page_range(F.col("medline_pgn"))
    ends = F.array(literal(iri, T.STARTING_PAGE, pages["start"]), literal(iri, T.ENDING_PAGE, pages["end"]))
    return F.concat(
        F.when(pages.isNotNull(), ends).otherwise(_empty()),
        F.array(literal(iri, T.PAGE_RANGE, F.col("medline_pagination"))),
    )


def journal_triples() -> Column:
    """Article, issue (unless empty), volume and journal, linked upwards."""
    iri, issue, volume, journal = F.col("iri"), F.col("_issue_node"), F.col("_volume_node"), F.col("_journal_node")
    no_issue = F.col("journal_issue") == ""
    issns = F.transform(
        "issns", lambda i: literal(journal, F.when(i["type"] == "Electronic", T.E_ISSN).otherwise(T.ISSN), i["value"])
    )
    return F.concat(
        F.array(
            link(iri, T.PART_OF, F.when(no_issue, volume).otherwise(issue)),
            _typed(volume, T.VOLUME_CLASS),
            literal(volume, T.VOLUME, F.col("journal_volume")),
            link(volume, T.PART_OF, journal),
            _typed(journal, T.JOURNAL_CLASS),
            literal(journal, T.DCT_TITLE, F.col("journal_title")),
            literal(journal, T.JOURNAL_ABBREVIATION, F.col("journal_abbr")),
        ),
        _distinct_if(F.size("issns") > 1, issns),
        F.when(no_issue, _empty()).otherwise(
            F.array(
                _typed(issue, T.ISSUE_CLASS),
                literal(issue, T.ISSUE_IDENTIFIER, F.col("journal_issue")),
                link(issue, T.PART_OF, volume),
            )
        ),
    )


def author_triples() -> Column:
    """The agents, and the ordered list of them that the article's creator points at."""
    size = F.size("authors")

    def describe(author: Column, i: Column) -> Column:
        node, cell = F.get("_agent_nodes", i), F.get("_list_nodes", i)
        parts = F.array(literal(node, T.FAMILY_NAME, author["family"]), literal(node, T.GIVEN_NAME, author["given"]))
        return F.concat(
            F.array(
                _typed(node, T.AGENT_CLASS), literal(node, T.NAME, author["name"]),
                link(cell, T.RDF_FIRST, node), link(cell, T.RDF_REST, F.get("_list_nodes", i + 1)),
            ),
            F.when(author["collective"] == "", parts).otherwise(_empty()),
        )

    agents = F.flatten(F.transform("authors", describe))
    # Only an author named twice, by the same ORCID, can repeat a statement.
    repeated = F.size(F.array_distinct("_agent_nodes")) < size
    return F.concat(
        F.array(link(F.col("iri"), T.DCT_CREATOR, F.get("_list_nodes", F.lit(0)))), _distinct_if(repeated, agents)
    )


def with_nodes(articles: DataFrame) -> DataFrame:
    """Add the nodes an article's statements refer to, each named once.

    ``_list_nodes`` has one cell per author and ``rdf:nil`` at its end; articles without authors' columns get none.
    """
    seed = F.col("blank_seed")
    nodes = {r: blank_node(seed, F.lit(r)).alias(f"_{r}_node") for r in ("issue", "volume", "journal")}
    if "authors" not in articles.columns:
        return articles.select("*", *nodes.values())
    agents = F.transform(
        "authors", lambda a, i: F.coalesce(first_orcid(a["orcids"]), blank_node(seed, F.lit("author"), i.cast("string")))
    )
    cells = F.transform("authors", lambda a, i: blank_node(seed, F.lit("list"), i.cast("string")))
    return articles.select(
        "*", *nodes.values(), agents.alias("_agent_nodes"), F.concat(cells, F.array(F.lit(T.RDF_NIL))).alias("_list_nodes")
    )


def date_triples() -> Column:
    """Issued and modified; dates that could not be read are left out."""
    iri = F.col("iri")

    def dated(column: str, predicate: str) -> Column:
        readable = F.filter(column, lambda d: d["error"].isNull())
        statements = F.transform(readable, lambda d: literal(iri, predicate, date_lexical(d), date_xsd_type(d)))
        return _distinct_if(F.size(column) > 1, statements)

    return F.concat(dated("pub_dates", T.DCT_ISSUED), dated("revised_dates", T.DCT_MODIFIED))


def citation_triples() -> Column:
    text = citation_string(
        F.transform("authors", lambda a: a["short"]), F.col("title"), F.col("journal_title"), F.col("pub_years"),
        F.col("journal_volume"), F.col("journal_issue"), F.col("medline_pagination"), F.col("pmid"),
    )
    return F.array(literal(F.col("iri"), T.DCT_CITATION, text))


def mesh_triples() -> Column:
    return F.transform("mesh_ids", lambda m: link(F.col("iri"), T.DCT_REFERENCES, mesh_iri(m)))


def term_triples() -> Column:
    """References to annotated terms (``terms``) that are no MeSH reference of the article already."""
    own = F.array_except("terms", F.transform("mesh_ids", mesh_iri))
    return F.transform(own, lambda t: link(F.col("iri"), T.DCT_REFERENCES, t))


GROUPS = {
    "metadata": metadata_triples, "pages": page_triples, "journal": journal_triples, "authors": author_triples,
    "dates": date_triples, "citation": citation_triples, "mesh": mesh_triples,
}
# The columns of an article that each group of statements is made of.
GROUP_COLUMNS = {
    "metadata": ("iri", "title", "dois", "pub_years"), "pages": ("iri", "medline_pgn", "medline_pagination"),
    "journal": ("iri", "blank_seed", "journal_issue", "journal_volume", "journal_title", "journal_abbr", "issns"),
    "authors": ("iri", "blank_seed", "authors"), "dates": ("iri", "pub_dates", "revised_dates"),
    "citation": ("pmid", "iri", "title", "authors", "journal_title", "journal_volume", "journal_issue", "pub_years", "medline_pagination"),
    "mesh": ("iri", "mesh_ids"),
}


def article_triples(articles: DataFrame, groups: tuple[str, ...] = tuple(GROUPS), keep: Sequence[Column] = ()) -> DataFrame:
    """``triples(subject, subject_kind, predicate, object, object_kind, datatype, source_file)``.

    Distinct within each article, as the union of the named groups; the group ``terms`` needs a
    column of that name. The
    datatype is empty unless the object is a literal. ``keep`` are columns of the article, its nodes
    included, that stay beside each of its statements.
    """
    if {"journal", "authors"} & set(groups):
        articles = with_nodes(articles)
    statements = F.concat(*[(GROUPS | {"terms": term_triples})[g]() for g in groups])
    # The outer generator keeps Spark from testing the array's size, which would
    # build it twice; an article without statements gives one empty row to drop.
    rows = articles.select("source_file", *keep, F.inline_outer(statements)).where(F.col("subject").isNotNull())
    kept = [c for c in rows.columns if c not in TRIPLE_COLUMNS and c != "source_file"]
    return rows.select(*TRIPLE_COLUMNS, "source_file", *kept)


def reference_triples(term_edges: DataFrame) -> DataFrame:
    """Reference statements from ``(iri, source_file, term_iri)`` edges."""
    t = link(F.col("iri"), T.DCT_REFERENCES, F.col("term_iri"))
    return term_edges.select(t.alias("_t"), "source_file").select("_t.*", "source_file")


def with_annotations(triples: DataFrame, term_edges: DataFrame) -> DataFrame:
    """Article triples plus annotation references, keeping set semantics.

    Only reference statements can coincide, so only they are made distinct.
    """
    is_reference = F.col("predicate") == T.DCT_REFERENCES
    references = triples.where(is_reference).unionByName(reference_triples(term_edges)).distinct()
    return triples.where(~is_reference).unionByName(references)


def triple_summary(triples: DataFrame) -> DataFrame:
    """Statements per subject, predicate and object type; blank subjects are left out."""
    object_type = F.when(F.col("object_kind") == "literal", F.col("datatype")).otherwise(F.col("object_kind"))
    return (
        triples.where(F.col("subject_kind") != "blank")
        .groupBy("subject", "predicate", object_type.alias("object_type"))
        .agg(F.count("*").alias("n"))
    )


def graph_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Statements in only one of two graphs, with the side; empty if they are equal.

    Graphs are compared by 128 bits of each statement, so texts are not moved. The texts of what differs are looked up afterwards,
    where there is any.
    """
    terms = [part for c in TRIPLE_COLUMNS for part in (F.isnull(c), F.col(c))]
    names = [F.xxhash64(F.lit(i), *terms).alias(f"_h{i}") for i in (1, 2)]
    sides = left.select(*TRIPLE_COLUMNS, F.lit(1).alias("_side")).unionByName(right.select(*TRIPLE_COLUMNS, F.lit(2).alias("_side")))
    apart = sides.select(*names, "_side").groupBy("_h1", "_h2").agg(F.bit_or("_side").alias("_side")).where("_side != 3")
    apart = written(apart, "apart")
    if apart.isEmpty():
        told = sides.where("false")
    else:
        told = sides.select("*", *names).join(broadcast_if_small(apart), ["_h1", "_h2", "_side"], "left_semi")
    return told.select(*TRIPLE_COLUMNS, F.when(F.col("_side") == 1, "left").otherwise("right").alias("side")).distinct()
