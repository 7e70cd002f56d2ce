"""DataFrame → DataFrame operators: record parsing, statistics, words."""

from snaptally.operators.records import (
    ERROR,
    ERROR_KIND,
    IS_VALID,
    RECORD,
    TABLE_NAME,
    parse_records,
    record_size_or_zero,
    typed_records,
)
from snaptally.operators.stats import (
    FILE_SIZE,
    FILE_URI,
    INITIAL,
    MISSING,
    OTHER_INITIAL,
    PATH,
    RECORD_COUNT,
    TABLE_SIZE,
    changed_tables,
    dataset_stats,
    file_stats,
    initial_of,
    merge_checksums,
    merge_stats,
    path_stats,
    snapshot_table_counts,
    table_checksum,
    table_record_count,
    table_size,
    table_stats,
    with_initial,
)
from snaptally.operators.words import COUNT, WORD, contains_counts, split_words, word_count

__all__ = [
    "ERROR", "ERROR_KIND", "IS_VALID", "RECORD", "TABLE_NAME", "parse_records", "record_size_or_zero", "typed_records",
    "changed_tables", "merge_checksums", "table_checksum",
    "FILE_SIZE", "FILE_URI", "INITIAL", "MISSING", "OTHER_INITIAL", "PATH", "RECORD_COUNT",
    "TABLE_SIZE", "dataset_stats", "file_stats", "initial_of", "merge_stats", "path_stats",
    "snapshot_table_counts", "table_record_count", "table_size", "table_stats", "with_initial",
    "COUNT", "WORD", "contains_counts", "split_words", "word_count",
]
