"""Structured Streaming: incremental ingest of landing city files."""

from strata.streaming.arrivals import (
    document_from_events,
    events_table,
    ingest_arrivals,
    new_files,
    tag_by_folder,
    tag_by_letter,
)

__all__ = ["document_from_events", "events_table", "ingest_arrivals", "new_files", "tag_by_folder",
           "tag_by_letter"]
