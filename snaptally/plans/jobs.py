"""End-to-end jobs: read → operators → write, each a single distributed pass.

Every job takes its inputs as arguments, writes with the executors and
returns the output path(s); no result row is collected to the driver. Output
goes to ``{out}/{program}-{stamp}/{marker}``; ``stamp`` defaults to the UTC
time of the call (pass one to make a run reproducible). With ``debug`` the
named intermediate stages are also written (:func:`snaptally.sinks.tee`) and
the job continues from those copies, so nothing is computed twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from snaptally.functions.text import text_length
from snaptally.operators.records import IS_VALID, parse_records, record_size_or_zero, typed_records
from snaptally.operators.stats import (
    dataset_stats,
    file_stats,
    path_stats,
    snapshot_table_counts,
    table_checksum,
    table_stats,
)
from snaptally.operators.words import contains_counts, word_count
from snaptally.sinks.writers import (
    Stage,
    dataset_report,
    format_stat,
    run_dir,
    run_stamp,
    stage_counts,
    tee,
    write_by_initial,
    write_parquet,
    write_report,
    write_stats,
)
from snaptally.sources.json import read_json
from snaptally.sources.listing import LATEST_POINTER, STAMP_PATTERN, list_files
from snaptally.sources.text import scan_lines


def table_stats_job(
    spark: SparkSession,
    input_uri: str | Sequence[str],
    out: str,
    *,
    lenient: bool = False,
    unit: str = "utf16",
    by_initial: bool = False,
    debug: bool = False,
    counts: bool = False,
    stamp: str | None = None,
) -> str:
    """Per-table record count and size of JSON-lines files, keyed by each
    record's ``~table`` field (the flagship job).

    One scan, one parse per line, one aggregate, one write. ``by_initial``
    writes the result split by the first letter of the table name instead of
    as one set of files. ``counts`` also writes how many lines and records passed and
    how large they were (``stage-counts``), counted in the same pass.
    """
    stamp = stamp or run_stamp()
    rd = run_dir(out, "table-stats", stamp)
    lines = tee(scan_lines(spark, input_uri), "lines", rd, enabled=debug)
    stages = []

    def counted(df, marker, **totals):
        if counts:
            stages.append(Stage(df, marker, **totals))
        return stages[-1].frame if counts else df

    lines = counted(lines, "lines", size=text_length(F.col("value"), unit))
    records = tee(parse_records(lines, lenient=lenient, unit=unit, keep_record=debug), "records", rd, enabled=debug)
    records = counted(records, "records", valid=F.col(IS_VALID).cast("long"), size=record_size_or_zero())
    stats = table_stats(records)
    if by_initial:
        written = write_by_initial(stats, f"{rd}/stats-by-initial")
    else:
        written = write_stats(stats, out, program="table-stats", marker="stats", stamp=stamp)
    if counts:
        stage_counts(spark, stages).coalesce(1).write.json(f"{rd}/stage-counts")
    return written


def table_checksum_job(
    spark: SparkSession, input_uri: str | Sequence[str], out: str, *, lenient: bool = False, stamp: str | None = None
) -> str:
    """One checksum a table over all its lines, as JSON lines (``tableName,
    recordCount, checksumSum, checksumXor``): two snapshots with equal ones hold the same
    lines (:func:`snaptally.operators.changed_tables`)."""
    records = parse_records(scan_lines(spark, input_uri), lenient=lenient, keep_record=False, checksum=True)
    path = f"{run_dir(out, 'table-checksum', stamp)}/checksums"
    table_checksum(records).write.mode("errorifexists").json(path)
    return path


def dataset_stats_job(
    spark: SparkSession, input_uri: str, out: str, *, unit: str = "utf16", stamp: str | None = None
) -> str:
    """Line count and total length of one dataset, as a three-line text report."""
    stats = dataset_stats(scan_lines(spark, input_uri), unit=unit)
    return write_report(dataset_report(stats, input_uri), run_dir(out, "dataset-stats", stamp), single_file=True)


def path_stats_job(
    spark: SparkSession, paths: Sequence[str], out: str, *, unit: str = "utf16", stamp: str | None = None
) -> str:
    """Count and size per given path, one ``Stat{…}`` line each, from one scan."""
    st = path_stats(spark, list(paths), unit=unit)
    return write_report(format_stat(st, key="path"), run_dir(out, "path-stats", stamp))


def file_stats_job(
    spark: SparkSession,
    input_uri: str | Sequence[str],
    out: str,
    *,
    unit: str = "utf16",
    whole: bool = False,
    debug: bool = False,
    stamp: str | None = None,
) -> str:
    """Records and size per file, as JSON lines; with ``debug`` also as Parquet."""
    stamp = stamp or run_stamp()
    st = tee(file_stats(spark, input_uri, unit=unit, whole=whole), "files", run_dir(out, "file-stats", stamp), enabled=debug)
    return write_stats(st, out, program="file-stats", marker="stats", stamp=stamp)


def snapshot_counts_job(
    spark: SparkSession,
    root: str,
    out: str,
    *,
    snapshot: str | None = None,
    limit: int | None = None,
    pointer: str | None = LATEST_POINTER,
    stamp_pattern: str | None = STAMP_PATTERN,
    stamp: str | None = None,
) -> str:
    """Line count per table of the latest (or given) snapshot, as JSON lines
    (``table, fileURI, recordCount``), all tables in one job."""
    st = snapshot_table_counts(spark, root, snapshot=snapshot, limit=limit, pointer=pointer, stamp_pattern=stamp_pattern)
    return write_stats(st, out, program="snapshot-counts", marker="stats", stamp=stamp)


def json_to_parquet_job(
    spark: SparkSession,
    input_uri: str | Sequence[str],
    out_path: str,
    *,
    schema=None,
) -> str:
    """JSON lines → Parquet with a Spark-inferred (or given) schema; only good
    lines, whichever it is."""
    return write_parquet(read_json(spark, input_uri, schema=schema), out_path)


def records_to_parquet_job(
    spark: SparkSession, input_uri: str | Sequence[str], out_path: str, *, schema=None, checksum: bool = False, debug: bool = False
) -> str:
    """JSON lines → Parquet from the good records only: bad lines (duplicate
    keys included) are left out before the schema is inferred, so colliding
    columns cannot arise from them. With ``checksum`` every record keeps its
    ``~checksum``. With ``debug`` the parsed records are also written, to
    ``{out_path}-debug/records``."""
    records = tee(parse_records(scan_lines(spark, input_uri), checksum=checksum), "records", f"{out_path.rstrip('/')}-debug", enabled=debug)
    typed = typed_records(records, schema=schema)
    if not typed.columns:
        raise ValueError(f"no good record under {input_uri}: nothing to write")
    return write_parquet(typed, out_path)


def word_count_job(
    spark: SparkSession, input_uri: str | Sequence[str], out: str, *, stamp: str | None = None
) -> str:
    """Word count of text lines (single-space split), as JSON lines."""
    wc = word_count(scan_lines(spark, input_uri))
    path = f"{run_dir(out, 'word-count', stamp)}/counts"
    wc.write.mode("errorifexists").json(path)
    return path


def list_files_job(
    spark: SparkSession, paths: str | Sequence[str], out: str, *, recursive: bool = False, stamp: str | None = None
) -> str:
    """The files of a path (``path, length, modificationTime``), as Parquet;
    no file is opened."""
    return write_parquet(list_files(spark, paths, recursive=recursive), f"{run_dir(out, 'file-list', stamp)}/files")


def contains_counts_job(
    spark: SparkSession,
    input_uri: str | Sequence[str],
    out: str,
    *,
    needles: Sequence[str] = ("a", "b"),
    stamp: str | None = None,
) -> str:
    """Number of lines containing each needle, all counted in one pass, as JSON."""
    counts = contains_counts(scan_lines(spark, input_uri), needles)
    path = f"{run_dir(out, 'contains-counts', stamp)}/counts"
    counts.write.mode("errorifexists").json(path)
    return path


__all__ = [
    "contains_counts_job", "list_files_job",
    "dataset_stats_job", "file_stats_job", "json_to_parquet_job", "path_stats_job", "records_to_parquet_job",
    "snapshot_counts_job", "table_checksum_job", "table_stats_job", "word_count_job",
]
