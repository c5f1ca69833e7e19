"""Readers for catalogue tables, statistics files and category documents."""

from tidestrata.sources.categories import category_documents, refused_documents
from tidestrata.sources.files import arriving_files
from tidestrata.sources.rejected import accepted, refused
from tidestrata.sources.statistics import (
    api_input,
    api_items,
    api_statistics,
    csv_input,
    csv_statistics,
    keep_regions,
)
from tidestrata.sources.tables import bounded_sample, has_rows, optional_table, table

__all__ = [
    "accepted",
    "api_input",
    "api_items",
    "api_statistics",
    "arriving_files",
    "bounded_sample",
    "category_documents",
    "csv_input",
    "csv_statistics",
    "has_rows",
    "keep_regions",
    "optional_table",
    "refused",
    "refused_documents",
    "table",
]
