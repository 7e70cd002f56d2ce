"""Column expressions (no UDFs): JSON record checks, length units, splitting, paths."""

from snaptally.functions.json import (
    CHECKSUM_FIELD,
    ERROR_CODE,
    RECORD_SIZE_FIELD,
    TABLE_FIELD,
    UNKNOWN_TABLE,
    ParsedLine,
    parse_line,
    table_key,
)
from snaptally.functions.text import (
    UNITS,
    decode_path,
    java_split,
    parent_dir,
    path_component,
    text_length,
)

__all__ = [
    "CHECKSUM_FIELD", "ERROR_CODE", "RECORD_SIZE_FIELD", "TABLE_FIELD", "UNKNOWN_TABLE",
    "ParsedLine", "parse_line", "table_key", "UNITS", "decode_path", "java_split",
    "parent_dir", "path_component", "text_length",
]
