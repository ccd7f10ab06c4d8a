"""Scans (play files, metadata dumps, Parquet tables) and sinks."""

from playstats.sources.commits import commit_load, commits, load_rows, read_loads, stage_load, vacuum
from playstats.sources.dumps import load_dump, read_dump, read_dumps, scan_dump
from playstats.sources.playfiles import read_play_files, rejected_files, scan_play_files
from playstats.sources.sinks import (
    append_segments,
    audit_lines,
    empty_like,
    write_audit,
    write_csv_report,
    write_parquet,
    write_play_files,
    write_recommendations,
    write_segmented_plays,
)
from playstats.sources.tables import (
    describe,
    drop_database,
    list_columns,
    list_tables,
    read_segments,
    read_table,
    read_text_partitions,
    register_view,
    save_table,
)

__all__ = [
    "drop_database",
    "list_columns",
    "save_table",
    "commit_load",
    "commits",
    "load_rows",
    "read_loads",
    "stage_load",
    "vacuum",
    "load_dump",
    "scan_dump",
    "write_play_files",
    "read_text_partitions",
    "read_dump",
    "read_dumps",
    "read_play_files",
    "rejected_files",
    "scan_play_files",
    "append_segments",
    "audit_lines",
    "empty_like",
    "write_audit",
    "write_csv_report",
    "write_parquet",
    "write_recommendations",
    "write_segmented_plays",
    "describe",
    "list_tables",
    "read_segments",
    "read_table",
    "register_view",
]
