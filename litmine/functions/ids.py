"""Identifiers: IRIs, blank nodes, article ids and file choice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from litmine.functions.text import text_or_empty

# The namespaces the output must use.
ARTICLE_NS = "https://www.ncbi.nlm.nih.gov/pubmed/"
MESH_NS = "http://id.nlm.nih.gov/mesh/"


def article_iri(pmid: Column) -> Column:
    return F.concat(F.lit(ARTICLE_NS), pmid)


def mesh_iri(mesh_id: Column) -> Column:
    return F.concat(F.lit(MESH_NS), mesh_id)


def blank_node(seed: Column, *role: Column) -> Column:
    """A blank node id that depends on nothing but the record and the node's role in it."""
    return F.concat(F.lit("_:b"), F.substring(F.sha2(F.concat_ws("|", seed, *role), 256), 1, 24))


def last_of_list(value: Column) -> Column:
    """The last non-empty entry of a ``;``-separated list, else the empty string."""
    entries = F.filter(
        F.transform(F.split(text_or_empty(value), ";"), lambda e: F.regexp_replace(e, r"^[\x00-\x20]+|[\x00-\x20]+$", "")),
        lambda e: e != "",
    )
    return F.coalesce(F.try_element_at(entries, F.lit(-1)), F.lit(""))


def preferred_file(pmc_files: Column, pdf_files: Column) -> Column:
    """The last PMC parse if there is any, else the last PDF parse, else empty."""
    pmc = last_of_list(pmc_files)
    return F.when(pmc != "", pmc).otherwise(last_of_list(pdf_files))


def row_id(uid: Column, row_index: Column) -> Column:
    """Source ids repeat, so the row number makes them unique."""
    return F.concat(text_or_empty(uid), F.lit(":"), row_index.cast("string"))


def article_id(pmid: Column, doi: Column, pmcid: Column, fallback: Column) -> Column:
    """The best identifier there is: PMID, DOI, PMCID, then the row id."""

    def tagged(tag: str, value: Column) -> Column:
        return F.when(text_or_empty(value) != "", F.concat(F.lit(tag), value))

    return F.coalesce(
        tagged("PMID:", pmid), tagged("DOI:", doi), tagged("PMCID:", pmcid),
        F.concat(F.lit("CORD_UID:"), fallback),
    )
