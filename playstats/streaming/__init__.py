"""Structured Streaming ingest (STR1-2)."""

from playstats.streaming.ingest import (
    batch_rollup,
    compact_rollup,
    parsed_stream,
    play_file_stream,
    read_clean_rollup,
    read_rejects,
    read_rollup,
    start_clean_rollup,
    start_ingest,
    start_rejects,
    start_rollup,
)

__all__ = [
    "batch_rollup",
    "compact_rollup",
    "parsed_stream",
    "play_file_stream",
    "read_clean_rollup",
    "read_rejects",
    "read_rollup",
    "start_clean_rollup",
    "start_ingest",
    "start_rejects",
    "start_rollup",
]
