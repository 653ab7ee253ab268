"""Column -> Column building blocks; all of them stay inside the JVM."""

from litmine.functions.citation import citation_string
from litmine.functions.dates import date_lexical, date_xsd_type, parse_partial_date
from litmine.functions.ids import (
    article_id,
    article_iri,
    blank_node,
    last_of_list,
    mesh_iri,
    preferred_file,
    row_id,
)
from litmine.functions.names import family_name, full_name, short_name
from litmine.functions.orcid import first_orcid, normalize_orcid, orcid_list
from litmine.functions.pages import split_page_range
from litmine.functions.text import (
    collapse_whitespace,
    escape_query_syntax,
    kwic_after,
    kwic_before,
    normalize_surface,
    remove_stop_characters,
    text_or_empty,
    word_array,
)

__all__ = [
    "article_id", "article_iri", "blank_node", "citation_string", "collapse_whitespace",
    "date_lexical", "date_xsd_type", "escape_query_syntax", "family_name", "first_orcid",
    "full_name", "kwic_after", "kwic_before", "last_of_list", "mesh_iri", "normalize_orcid",
    "normalize_surface", "orcid_list", "parse_partial_date", "preferred_file",
    "remove_stop_characters", "row_id", "short_name", "split_page_range", "text_or_empty",
    "word_array",
]
