"""Structured Streaming forms of the loads."""
from opsmart.streaming.ingest import daily_event_counts, dedupe_into, file_stream, ingest_drops, run_to_folder, run_to_days

__all__ = ["daily_event_counts", "dedupe_into", "file_stream", "ingest_drops", "run_to_folder", "run_to_days"]
