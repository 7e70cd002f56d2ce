"""Writers for results and intermediate stages."""

from snaptally.sinks.writers import (
    REPORT_INPUT,
    REPORT_LINES,
    REPORT_SIZE,
    STAT_FORMAT,
    Stage,
    dataset_report,
    format_stat,
    read_stats,
    run_dir,
    run_stamp,
    stage_counts,
    tee,
    write_by_initial,
    write_parquet,
    write_report,
    write_stats,
)

__all__ = [
    "REPORT_INPUT", "REPORT_LINES", "REPORT_SIZE", "STAT_FORMAT", "Stage", "dataset_report",
    "format_stat", "read_stats", "run_dir", "run_stamp", "stage_counts", "tee", "write_by_initial",
    "write_parquet", "write_report", "write_stats",
]
