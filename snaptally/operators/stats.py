"""Counts and sizes per dataset, path, file, table and snapshot table.

Every statistic is one grouped aggregate: a partial (map-side) aggregate per
task, one exchange of at most (groups × tasks) rows, a final aggregate. A hot
table holding a third of all lines therefore costs nothing extra: its lines
collapse to one partial row per task before the shuffle. Nothing is collected
to the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaptally.functions.json import CHECKSUM_FIELD, UNKNOWN_TABLE
from snaptally.functions.text import (
    decode_path,
    java_split,
    text_length,
)
from snaptally.operators.records import TABLE_NAME, record_size_or_zero
from snaptally.sources.listing import LATEST_POINTER, STAMP_PATTERN, escape_glob, expand_glob, glob_regex, is_file, is_glob, list_dirs, qualify, resolve_latest
from snaptally.sources.text import FILE_BYTES, FILE_PATH, SPLIT_START, scan_lines_raw_path, scan_splits, scan_whole

RECORD_COUNT = "recordCount"
TABLE_SIZE = "tableSize"
FILE_SIZE = "fileSize"
FILE_BYTES_OUT = "fileBytes"
FILE_URI = "fileURI"
PATH = "path"
INITIAL = "initial"
OTHER_INITIAL = "other"
MISSING = -1


def _sum0(c):
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def dataset_stats(lines: DataFrame, value_col: str = "value", *, unit: str = "utf16") -> DataFrame:
    """One row: ``recordCount`` (lines) and ``tableSize`` (total length, line
    breaks excluded), both BIGINT; 0 and 0 for an empty input."""
    return lines.agg(
        F.count(F.lit(1)).alias(RECORD_COUNT),
        _sum0(text_length(F.col(value_col), unit)).alias(TABLE_SIZE),
    )


def _per_file(spark: SparkSession, paths, unit: str, recursive: bool, line_sep: str | None, keep=None) -> DataFrame:
    # Grouped by the raw (encoded) path: it is constant within a file, so the
    # per-row cost is a hash; decoding happens once per file afterwards.
    lines = scan_lines_raw_path(spark, paths, recursive=recursive, line_sep=line_sep)
    if keep is not None:  # of file paths alone, so Spark leaves whole files out when it plans the scan
        lines = lines.where(keep)
    return lines.groupBy(FILE_PATH).agg(
        F.count(F.lit(1)).alias(RECORD_COUNT),
        _sum0(text_length(F.col("value"), unit)).alias("chars"),
        _sum0(F.octet_length("value")).alias("octets"),
        F.max(FILE_BYTES).alias(FILE_BYTES),
    )


def file_stats(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    unit: str = "utf16",
    recursive: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Per file: ``fileURI, recordCount, fileSize, fileBytes``.

    Records are the ``\\n``-separated pieces of the file (a ``\\r`` stays in
    its record). ``fileSize`` is the length of the file in ``unit`` with its
    line breaks, as many as there are: the bytes of the file that are in no
    line. That holds for uncompressed files. ``fileBytes`` is the exact size of
    the file from the scan's own metadata (no extra read).

    Files are read as splittable lines, so a large file is processed by many
    tasks. The default keeps blank lines at the end of a file; ``whole=True``
    applies the JVM's ``split("\\n")`` rules to the file as one value: trailing
    empty records are dropped. Only compressed files, which can't be split anyway,
    are then read as one value each, for their exact length. A file without any
    line (no byte, or a byte order mark alone) has no row.
    """
    if whole:
        return _whole_files(spark, paths, unit, recursive)
    per_file = _per_file(spark, paths, unit, recursive, "\n")
    return per_file.select(
        decode_path(F.col(FILE_PATH)).alias(FILE_URI),
        F.col(RECORD_COUNT),
        (F.col("chars") + F.col(FILE_BYTES) - F.col("octets")).alias(FILE_SIZE),
        F.col(FILE_BYTES).alias(FILE_BYTES_OUT),
    )


#: names of files that the reader decompresses
_COMPRESSED = "gz,bz2,deflate,snappy,lz4,zst"


def _whole_files(spark: SparkSession, paths, unit: str, recursive: bool) -> DataFrame:
    """``file_stats`` by the rules for whole files, from the lines of its splits.

    A split's summary is its lines, its length, and how many empty lines it ends
    with. Summaries of a file are merged in the order of their splits: the empty
    lines at the end are those of the last split with text, and all lines after it.
    """
    packed = "*.{" + _COMPRESSED + "}"
    lines = scan_splits(spark, paths, recursive=recursive)
    full = F.octet_length("value") > 0
    # a split's lines have consecutive numbers
    numbered = lines.withColumn("at", F.monotonically_increasing_id()).where(~F.col(FILE_PATH).rlike(r"\.(?:" + _COMPRESSED.replace(",", "|") + ")$"))
    splits = numbered.groupBy(FILE_PATH, SPLIT_START).agg(
        F.count(F.lit(1)).alias("lines"),
        _sum0(text_length(F.col("value"), unit)).alias("chars"),
        _sum0(F.octet_length("value")).alias("octets"),
        F.max(FILE_BYTES).alias(FILE_BYTES),
        (F.max("at") - F.max(F.when(full, F.col("at")))).alias("empty"),  # NULL without text
    )
    last = F.max(F.when(F.col("empty").isNotNull(), F.col(SPLIT_START))).over(Window.partitionBy(FILE_PATH))
    files = splits.withColumn("last", last).groupBy(FILE_PATH).agg(
        F.sum("lines").alias("lines"),
        F.sum("chars").alias("chars"),
        F.sum("octets").alias("octets"),
        F.max(FILE_BYTES).alias(FILE_BYTES),
        F.sum(F.when(F.col(SPLIT_START) > F.col("last"), F.col("lines")).when(F.col(SPLIT_START) == F.col("last"), F.col("empty"))).alias("empty"),
    )
    outside = F.col(FILE_BYTES) - F.col("octets")  # bytes of line breaks, and of a byte order mark, which is in no line
    mark = outside - F.col("lines") >= 2
    mark_units = 3 if unit == "bytes" else 1
    records = F.coalesce(F.col("lines") - F.col("empty"), F.when(mark, 1).otherwise(0))
    whole = scan_whole(spark, paths, recursive=recursive, require_files=False, name_glob=packed)
    return files.select(
        decode_path(F.col(FILE_PATH)).alias(FILE_URI),
        records.cast("bigint").alias(RECORD_COUNT),
        (F.col("chars") + outside - F.when(mark, 3 - mark_units).otherwise(0)).cast("bigint").alias(FILE_SIZE),
        F.col(FILE_BYTES).alias(FILE_BYTES_OUT),
    ).unionByName(whole.select(
        F.col(FILE_PATH).alias(FILE_URI),
        F.size(java_split(F.col("value"), "\n")).cast("bigint").alias(RECORD_COUNT),
        text_length(F.col("value"), unit).alias(FILE_SIZE),
        F.col(FILE_BYTES).alias(FILE_BYTES_OUT),
    ))


def path_stats(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    unit: str = "utf16",
    recursive: bool = False,
) -> DataFrame:
    """One row per given path: ``path`` (as given), ``recordCount``,
    ``tableSize``; 0 and 0 for a path without a line.

    A path is a file, a directory or a glob, and counts every line that a scan
    of it alone would read. All paths are read by ONE scan, in which a file that
    several of them cover is read once and counted for each: globs are expanded to
    the paths they match, as the reader would, and each file's row (not each line) is
    matched with them. A path given twice has one row. Raises if no path at all has a
    file, or a glob matches nothing. Sizes exclude line breaks, as in :func:`dataset_stats`.
    """
    given = list(dict.fromkeys([paths] if isinstance(paths, str) else list(paths)))
    globs = {p: expand_glob(spark, p) for p in given if is_glob(p)}
    if any(found is None for found in globs.values()):  # no file system to ask: a scan for each glob
        alone = [_glob_alone(spark, p, unit, recursive) for p in globs]
        rest = [p for p in given if p not in globs]
        return reduce(DataFrame.unionByName, ([path_stats(spark, rest, unit=unit, recursive=recursive)] if rest else []) + alone)
    for p, found in globs.items():
        if not found:
            raise FileNotFoundError(f"nothing matches {p}")
    plain = {p: _local(qualify(spark, p)) for p in given if p not in globs}
    reader = {_local(q): q for q in [qualify(spark, p) for p in plain]}  # what Spark is asked to read keeps its scheme
    files = set()
    for found in globs.values():
        for path, is_dir in found:
            reader.setdefault(_local(path), path)
            if not is_dir:
                files.add(_local(path))
    at = set(reader)
    # what another path covers is not read a second time
    top = [q for q in sorted(at) if not _covers(at, q, recursive, lambda f: f in files or is_file(spark, reader[f]))]
    # non-null keys: nullable ones would let a join-inferred filter reach the scan
    name = F.coalesce(F.regexp_replace(decode_path(F.col(FILE_PATH)), "^file:/+", "/"), F.lit(""))
    plain_name = r"(?!\.|_[^/=]*(?:/|$))[^/]+"
    below = f"(/{plain_name})*" if recursive else f"(/(?!\\.)[^/=]+=[^/]*)*(/{plain_name})?"
    roots = [escape_glob(reader[q]) for q in top]
    try:
        per_file = _per_file(spark, roots, unit, recursive, None)
    except PySparkException as e:
        if recursive or e.getCondition() != "CONFLICTING_DIRECTORY_STRUCTURES":
            raise
        # name=value directories beside plain ones: Spark can't read them as one table, so
        # everything below is listed, and files that no path reaches are left out
        per_file = _per_file(spark, roots, unit, True, None, name.rlike(f"^(?:{'|'.join(map(re.escape, top))}){below}$"))
    matched = [F.when(name.rlike(f"^{glob_regex(_local(qualify(spark, p)))}{below}$"), F.lit(_GLOB + p)) for p in globs]
    keys = F.concat(_ancestors(name, recursive), F.array_compact(F.array(*matched))) if matched else _ancestors(name, recursive)
    covered = per_file.select(F.explode(keys).alias("at"), RECORD_COUNT, "chars").groupBy("at").agg(
        F.sum(RECORD_COUNT).cast("bigint").alias(RECORD_COUNT), F.sum("chars").cast("bigint").alias(TABLE_SIZE)
    )
    listing = spark.createDataFrame([(p, plain.get(p, _GLOB + p)) for p in given], f"{PATH} string, at string")
    zero = F.lit(0).cast("bigint")
    return listing.join(covered, "at", "left").select(
        PATH, F.coalesce(F.col(RECORD_COUNT), zero).alias(RECORD_COUNT), F.coalesce(F.col(TABLE_SIZE), zero).alias(TABLE_SIZE)
    )


_GLOB = "glob:"  # before a glob's key; the other keys are absolute paths or have a scheme


def _glob_alone(spark: SparkSession, glob: str, unit: str, recursive: bool) -> DataFrame:
    """The row of one glob by a scan of its own."""
    return _per_file(spark, [glob], unit, recursive, None).select(
        F.lit(glob).alias(PATH), RECORD_COUNT, "chars"
    ).groupBy(PATH).agg(F.sum(RECORD_COUNT).cast("bigint").alias(RECORD_COUNT), F.sum("chars").cast("bigint").alias(TABLE_SIZE))


def _local(path: str) -> str:
    """A path of the local file system without its scheme, any other as it is."""
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path


def _covers(paths: set[str], path: str, recursive: bool, file) -> bool:
    """Whether the scan of another of ``paths`` reads all of ``path``: that of a
    directory above with ``recursive``, else that of a file's own directory, or
    of one from which only ``name=value`` directories lead down. ``file`` says
    whether a path is a file; it is asked only if its directory is given too."""
    parent, _, name = path.rpartition("/")
    if re.match(_HIDDEN_STEP, "/" + name):  # a reader passes it by
        return False
    if parent in paths and (recursive or "=" in name or file(path)):
        return True
    # from here on path is taken as a file if its parent is a name=value directory
    at, step = parent, parent.rpartition("/")[2]
    while "/" in at and (recursive or "=" in step) and not re.match(_HIDDEN_STEP, "/" + step):
        at = at.rpartition("/")[0]
        if at in paths and (recursive or "=" in name or file(path)):
            return True
        step = at.rpartition("/")[2]
    return False


_HIDDEN_STEP = r"/(\.|_[^/=]*(/|$))"  # a name below a given path that a reader passes by


def _ancestors(name, recursive: bool):
    """A file's path and the directories whose scan reads it."""
    parts = F.split(name, "/")
    all_ = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    all_ = F.filter(all_, lambda a: ~F.substr(name, F.length(a) + 1).rlike(_HIDDEN_STEP))
    if recursive:
        return all_
    parent = F.regexp_extract(name, "^(.*)/[^/]*$", 1)
    reached = F.filter(
        all_,
        lambda a: (a == name) | (a == parent) | (
            parent.startswith(F.concat(a, F.lit("/"))) & F.substr(parent, F.length(a) + 1).rlike("^(/[^/=]+=[^/]*)+$")
        ),
    )
    return reached


def table_record_count(records: DataFrame) -> DataFrame:
    """``tableName, recordCount`` from :func:`parse_records` output."""
    return records.groupBy(TABLE_NAME).agg(F.count(F.lit(1)).alias(RECORD_COUNT))


def table_size(records: DataFrame) -> DataFrame:
    """``tableName, tableSize``: total size of the good records (bad ones add 0)."""
    return records.groupBy(TABLE_NAME).agg(_sum0(record_size_or_zero()).alias(TABLE_SIZE))


def table_stats(records: DataFrame) -> DataFrame:
    """``tableName, recordCount, tableSize`` in one pass over the records."""
    return records.groupBy(TABLE_NAME).agg(
        F.count(F.lit(1)).alias(RECORD_COUNT),
        _sum0(record_size_or_zero()).alias(TABLE_SIZE),
    )


_LANES = 4  #: pieces of a checksum, of 60 bits each


def table_checksum(records: DataFrame) -> DataFrame:
    """One checksum a table over all its lines, whatever their order and files:
    ``tableName, recordCount, checksumSum, checksumXor`` (hex, 60 hex digits each).

    Every line's SHA-256 (the ``~checksum`` of :func:`parse_records`) gives four numbers of
    60 bits; each is added up, modulo 2**60, and combined by exclusive or. Both are
    associative, so tasks combine their lines before the shuffle, and results of parts
    can be merged (:func:`merge_checksums`). Equal lines count as often as they occur.
    """
    if CHECKSUM_FIELD not in records.columns:
        raise ValueError("no checksums: parse with checksum=True")
    digest = F.col(f"`{CHECKSUM_FIELD}`")
    lanes = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("bigint") for i in range(_LANES)]
    sums = records.select(TABLE_NAME, *[x.alias(f"l{i}") for i, x in enumerate(lanes)]).groupBy(TABLE_NAME).agg(
        F.count(F.lit(1)).alias(RECORD_COUNT),
        *[F.sum(F.col(f"l{i}").cast("decimal(38,0)")).alias(f"sum{i}") for i in range(_LANES)],
        *[F.bit_xor(f"l{i}").alias(f"xor{i}") for i in range(_LANES)],
    )
    return sums.select(TABLE_NAME, RECORD_COUNT, *_joined_lanes())


def merge_checksums(parts: DataFrame) -> DataFrame:
    """The checksums of tables from :func:`table_checksum` rows of their parts."""
    def lane(name, i):
        return F.conv(F.substring(f"checksum{name}", 1 + 15 * i, 15), 16, 10)

    merged = parts.groupBy(TABLE_NAME).agg(
        F.sum(RECORD_COUNT).cast("bigint").alias(RECORD_COUNT),
        *[F.sum(lane("Sum", i).cast("decimal(38,0)")).alias(f"sum{i}") for i in range(_LANES)],
        *[F.bit_xor(lane("Xor", i).cast("bigint")).alias(f"xor{i}") for i in range(_LANES)],
    )
    return merged.select(TABLE_NAME, RECORD_COUNT, *_joined_lanes())


def _joined_lanes():
    def hexed(x):
        return F.lower(F.lpad(F.hex(x.cast("bigint")), 15, "0"))

    return (
        F.concat(*[hexed(F.col(f"sum{i}") % F.lit(2**60).cast("decimal(38,0)")) for i in range(_LANES)]).alias("checksumSum"),
        F.concat(*[hexed(F.col(f"xor{i}")) for i in range(_LANES)]).alias("checksumXor"),
    )


def changed_tables(old: DataFrame, new: DataFrame) -> DataFrame:
    """Tables of two snapshots whose checksums differ: ``tableName, change`` (``added``,
    ``removed`` or ``changed``). Both are one row a table."""
    names = [RECORD_COUNT, "checksumSum", "checksumXor"]
    o = old.select(TABLE_NAME, F.struct(*names).alias("o"))
    n = new.select(TABLE_NAME, F.struct(*names).alias("n"))
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o") != F.col("n"), "changed")
    return o.join(n, TABLE_NAME, "full_outer").select(TABLE_NAME, change.alias("change")).where("change is not null")


def merge_stats(
    counts: DataFrame,
    sizes: DataFrame,
    key: str = TABLE_NAME,
    *,
    missing: int = MISSING,
) -> DataFrame:
    """Join two separately computed results into ``key, recordCount, tableSize``;
    a side without the key gets ``missing`` (-1).

    Both inputs are already one row per key; the full outer join shuffles them
    by key (or reuses their partitioning when they come from aggregates on the
    same key). Use :func:`table_stats` instead when both come from one scan.
    """
    c = counts.select(F.col(key), F.col(RECORD_COUNT))
    s = sizes.select(F.col(key), F.col(TABLE_SIZE))
    return c.join(s, on=key, how="full_outer").select(
        F.col(key),
        F.coalesce(F.col(RECORD_COUNT).cast("bigint"), F.lit(missing).cast("bigint")).alias(RECORD_COUNT),
        F.coalesce(F.col(TABLE_SIZE).cast("bigint"), F.lit(missing).cast("bigint")).alias(TABLE_SIZE),
    )


def initial_of(col) -> "F.Column":
    """First character when it is a lower-case ``a``–``z``, else ``other``.

    Safe as a directory name for every table, including names starting with a
    digit, capital, ``_`` or nothing at all.
    """
    first = F.substring(col, 1, 1)
    return F.when(first.rlike("^[a-z]$"), first).otherwise(F.lit(OTHER_INITIAL))


def with_initial(stats: DataFrame, key: str = TABLE_NAME) -> DataFrame:
    """Add ``initial`` (see :func:`initial_of`) to a statistics table."""
    return stats.withColumn(INITIAL, initial_of(F.col(key)))


def snapshot_table_counts(
    spark: SparkSession,
    root: str,
    *,
    snapshot: str | None = None,
    limit: int | None = None,
    pointer: str | None = LATEST_POINTER,
    stamp_pattern: str | None = STAMP_PATTERN,
) -> DataFrame:
    """Line count per table of a snapshot: ``table, fileURI, recordCount``.

    ``snapshot`` defaults to the latest below ``root``. The tables are the
    snapshot's sub-directories (one name each reaches the driver, no file
    list); every file below a table counts, at any depth. The whole snapshot
    is read by ONE recursive scan of its directory; with ``limit`` only the
    first N tables by name are read. A table without any line is reported
    with 0.
    """
    snap = snapshot or resolve_latest(spark, root, pointer=pointer, stamp_pattern=stamp_pattern)
    base = f"{root.rstrip('/')}/{snap}"
    tables = list_dirs(spark, base)
    if limit is not None:
        tables = tables[: max(int(limit), 0)]
    schema = f"table string, {FILE_URI} string"
    listing = spark.createDataFrame(tables, schema)
    if not tables:
        return listing.withColumn(RECORD_COUNT, F.lit(0).cast("bigint"))
    read = [base] if limit is None else [p for _, p in tables]
    lines = scan_lines_raw_path(spark, [escape_glob(p) for p in read], recursive=True, require_files=False)
    per_file = lines.groupBy(FILE_PATH).agg(F.count(F.lit(1)).alias(RECORD_COUNT))
    # The key is declared non-null: a nullable key would make the optimizer
    # infer a not-null filter from the join and push it into the scan, where
    # it would decode the path of every line instead of once per file.
    # A table is the first component below the snapshot.
    top = _local(qualify(spark, base)) + "/"
    name = decode_path(F.col(FILE_PATH))
    rest = F.substr(name, F.instr(name, top) + len(top))
    table = F.coalesce(F.when(F.instr(rest, "/") > 0, F.substring_index(rest, "/", 1)), F.lit(""))
    per_table = per_file.groupBy(table.alias("table")).agg(
        F.sum(RECORD_COUNT).cast("bigint").alias(RECORD_COUNT)
    )
    return listing.join(per_table, "table", "left").select(
        "table", FILE_URI, F.coalesce(F.col(RECORD_COUNT), F.lit(0).cast("bigint")).alias(RECORD_COUNT)
    )


__all__ = [
    "INITIAL", "MISSING", "OTHER_INITIAL", "RECORD_COUNT", "TABLE_SIZE", "FILE_SIZE", "FILE_URI",
    "PATH", "UNKNOWN_TABLE", "changed_tables", "dataset_stats", "merge_checksums", "table_checksum", "file_stats", "initial_of", "merge_stats",
    "path_stats", "snapshot_table_counts", "table_record_count", "table_size", "table_stats",
    "with_initial",
]
