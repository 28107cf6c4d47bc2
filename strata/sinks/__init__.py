"""Sinks: JSON lines (one document per line) and record CSV files."""

from strata.sinks.json_lines import write_json_lines, write_named_parts, write_parts
from strata.sinks.published import publish_parts, read_published
from strata.sinks.records_csv import write_records_csv

__all__ = ["publish_parts", "read_published", "write_json_lines", "write_named_parts", "write_parts", "write_records_csv"]
