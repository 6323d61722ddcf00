"""Readers: columnar and text files, page files, paged web data, topics, and names of datasets."""

from .files import (canonical, describe, external_table, list_tables, load_zones, preview, register,
                    scan_csv, scan_database, scan_events_json, scan_json_pages, scan_months, scan_parquet, snake_case)
from .names import Sources
from .paged import PagedJson
from .topics import TopicConfig, stream_events, stream_files

__all__ = [
    "PagedJson", "Sources", "TopicConfig", "canonical", "describe", "external_table",
    "list_tables", "load_zones", "preview", "register", "scan_csv", "scan_database", "scan_events_json", "scan_json_pages",
    "scan_months", "scan_parquet", "snake_case", "stream_events", "stream_files",
]
