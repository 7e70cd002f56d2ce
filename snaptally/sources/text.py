"""Line and whole-file scans (text files, directories, globs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptally.functions.text import decode_path
from snaptally.sources.listing import reads_files

FILE_PATH = "file_path"
FILE_BYTES = "file_bytes"
SPLIT_START = "split_start"


def _paths(paths) -> list[str]:
    if isinstance(paths, str):
        return [paths]
    out = list(paths)
    if not out:
        raise ValueError("no input path given")
    return out


def _read_text(spark: SparkSession, paths: list[str], recursive: bool, line_sep: str | None,
               whole: bool = False, name_glob: str | None = None) -> DataFrame:
    # options go through text()'s own arguments: it sets wholetext explicitly
    return spark.read.text(
        paths,
        wholetext=whole,
        lineSep=line_sep,
        pathGlobFilter=name_glob,
        recursiveFileLookup=True if recursive else None,
    )


def require_input(spark: SparkSession, df: DataFrame, paths: Sequence[str], recursive: bool = False) -> DataFrame:
    """Raise when a scan matches no file at all.

    Spark reads a directory that holds only sub-directories, or a hidden
    path (``_x``, ``.x``), as zero rows without an error; a statistics job
    must not report an empty table for a wrong path.

    The scan's own file index answers, which Spark has listed already (in parallel
    jobs where there are many directories): one call, whatever the tree.
    """
    found = reads_files(spark, df, list(paths), recursive)
    if not found:
        raise FileNotFoundError(
            f"no data file under {list(paths)}; a directory holding only sub-directories "
            "needs a deeper glob or recursive=True, and names starting with '_' or '.' are hidden"
        )
    return df


def scan_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    with_path: bool = False,
    recursive: bool = False,
    line_sep: str | None = None,
    require_files: bool = True,
) -> DataFrame:
    """One row per line of every file matched by ``paths`` (files, directories or globs).

    Columns: ``value`` and, with ``with_path``, ``file_path`` — the file each line
    came from, percent-decoded so it equals the ``path`` of :func:`list_files`.
    Decode once per group rather than per row when grouping: see
    :func:`snaptally.operators.stats.file_stats`, which groups by the raw path.

    ``line_sep=None`` breaks lines at ``\\n``, ``\\r\\n`` and ``\\r``; ``'\\n'``
    keeps a ``\\r`` inside the line. Plain text is split into blocks of
    ``spark.sql.files.maxPartitionBytes``, so a single huge file is read in parallel.
    """
    p = _paths(paths)
    df = _read_text(spark, p, recursive, line_sep)
    if require_files:
        require_input(spark, df, p, recursive)
    if with_path:
        return df.select("value", decode_path(F.col("_metadata.file_path")).alias(FILE_PATH))
    return df.select("value")


def scan_lines_raw_path(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    recursive: bool = False,
    line_sep: str | None = None,
    require_files: bool = True,
) -> DataFrame:
    """As :func:`scan_lines` with the still-encoded ``_metadata.file_path`` and
    the file's size in bytes (``file_bytes``).

    The metadata value is constant within a file; grouping by it and decoding
    after the aggregation keeps the per-row work to a hash of the path.
    """
    p = _paths(paths)
    df = _read_text(spark, p, recursive, line_sep)
    if require_files:
        require_input(spark, df, p, recursive)
    return df.select(
        "value", F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_size").alias(FILE_BYTES)
    )


def scan_splits(spark: SparkSession, paths: str | Sequence[str], *, recursive: bool = False, require_files: bool = True) -> DataFrame:
    """As :func:`scan_lines_raw_path` with ``\\n`` breaks, and ``split_start``: the
    byte of the file where the line's split begins. A split's lines come in order."""
    p = _paths(paths)
    df = _read_text(spark, p, recursive, "\n")
    if require_files:
        require_input(spark, df, p, recursive)
    return df.select(
        "value", F.col("_metadata.file_path").alias(FILE_PATH), F.col("_metadata.file_size").alias(FILE_BYTES), F.col("_metadata.file_block_start").alias(SPLIT_START)
    )


def scan_whole(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    recursive: bool = False,
    require_files: bool = True,
    name_glob: str | None = None,
) -> DataFrame:
    """One row per file: ``file_path`` (decoded), its whole ``value`` and its
    size in bytes (``file_bytes``).

    Each file becomes one row held in memory at once, so this suits only files
    well below the 2 GB string limit; prefer :func:`scan_lines`. Zero-byte files
    yield no row. ``name_glob`` keeps files whose name it matches.
    """
    p = _paths(paths)
    df = _read_text(spark, p, recursive, None, whole=True, name_glob=name_glob)
    if require_files:
        require_input(spark, df, p, recursive)
    return df.select(
        decode_path(F.col("_metadata.file_path")).alias(FILE_PATH), "value",
        F.col("_metadata.file_size").alias(FILE_BYTES),
    )
