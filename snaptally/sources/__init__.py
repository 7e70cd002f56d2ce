"""Readers: line and whole-file scans, file/table listings, JSON and Parquet."""

from snaptally.sources.json import check_column_names, read_json, read_parquet
from snaptally.sources.listing import (
    LATEST_POINTER,
    STAMP_PATTERN,
    escape_glob,
    has_input_files,
    is_glob,
    latest_snapshot,
    list_dirs,
    list_files,
    list_tables,
    qualify,
    resolve_latest,
)
from snaptally.sources.text import FILE_PATH, require_input, scan_lines, scan_lines_raw_path, scan_whole

__all__ = [
    "FILE_PATH",
    "LATEST_POINTER",
    "STAMP_PATTERN",
    "check_column_names",
    "escape_glob",
    "has_input_files",
    "is_glob",
    "latest_snapshot",
    "list_dirs",
    "list_files",
    "list_tables",
    "qualify",
    "read_json",
    "read_parquet",
    "require_input",
    "resolve_latest",
    "scan_lines",
    "scan_lines_raw_path",
    "scan_whole",
]
