"""Incremental ingest."""

from lauter.streaming.ingest import stream_csv, stream_entity, stream_ndjson, stream_parquet

__all__ = ["stream_csv", "stream_entity", "stream_ndjson", "stream_parquet"]
