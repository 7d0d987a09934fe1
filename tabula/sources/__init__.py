"""Scans: CSV extracts, catalog tables, JSON run documents, run-store trees."""

from tabula.sources.catalog import read_table, row_range
from tabula.sources.csv import read_csv_checked, read_csv_inferred, read_csv_text
from tabula.sources.documents import RUN_DOCUMENT, document_shape, document_values, read_run_documents
from tabula.sources.runtree import scan_registry, scan_run_tree

__all__ = [
    "RUN_DOCUMENT",
    "document_shape",
    "document_values",
    "read_csv_checked",
    "read_csv_inferred",
    "read_csv_text",
    "read_run_documents",
    "read_table",
    "row_range",
    "scan_registry",
    "scan_run_tree",
]
