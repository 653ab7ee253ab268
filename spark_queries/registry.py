"""All queries by name."""

from __future__ import annotations

import importlib

MODULES = (
    "text_queries", "edge_queries", "xml_queries", "fulltext_queries", "range_queries", "shape_queries", "stream_queries", "file_queries",
)


def registry() -> dict:
    found: dict = {}
    for name in MODULES:
        queries = importlib.import_module(f"spark_queries.{name}").QUERIES
        assert not found.keys() & queries.keys()
        found.update(queries)
    return found
