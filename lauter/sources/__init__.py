"""Readers. Each returns a DataFrame with ``_pos``, the place of a row in its input."""

from lauter.sources.json_records import flatten_pages, parse_lines, read_json, read_ndjson, spread
from lauter.sources.producers import Producer, register_producer
from lauter.sources.split_scan import read_csv_split, read_json_split
from lauter.sources.tables import read_csv, read_parquet, with_position

__all__ = [
    "Producer",
    "flatten_pages",
    "parse_lines",
    "read_csv",
    "read_csv_split",
    "read_json",
    "read_json_split",
    "read_ndjson",
    "read_parquet",
    "register_producer",
    "spread",
    "with_position",
]
