"""File and directory listings of a snapshot tree.

Layout of a dump::

    {root}/{snapshot}/{table}/{part files of JSON lines}

*Directory* listings (snapshots of a root, tables of a snapshot) ask the file
system for one level only, through the session's Hadoop ``FileSystem``: the
cost is one call per level, O(snapshots) or O(tables), never O(files), and the
driver holds only names. Without a JVM gateway (a remote session) they fall
back to the ``binaryFile`` listing, which sees only directories that hold a
non-empty file.

*File* listings use the ``binaryFile`` source with only ``path``, ``length``
and ``modificationTime`` selected; the ``content`` column is pruned, so no file
is opened. Zero-byte files are not returned by that source.

Hidden names (``_x``, ``.x``) are skipped everywhere, as Spark's file sources
skip them. Only the ``_LATEST`` pointer is opened, by the file system: it names the
last finished snapshot. Without it the latest snapshot is the greatest directory name
of stamp form that holds data.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_log = logging.getLogger(__name__)

# The pointer file of a dump and the form of a snapshot's name.
LATEST_POINTER = "_LATEST"
STAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}-\d{2}-\d{2}-\d{2}$"


def list_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    *,
    recursive: bool = False,
    glob_filter: str | None = None,
) -> DataFrame:
    """``path STRING, length BIGINT, modificationTime TIMESTAMP`` per non-empty file."""
    r = spark.read.format("binaryFile")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if glob_filter:
        r = r.option("pathGlobFilter", glob_filter)
    p = [paths] if isinstance(paths, str) else list(paths)
    df = r.load(p).select("path", "length", "modificationTime")
    # only a directory of sub-directories reads as nothing without an error
    if not glob_filter and not any(map(is_glob, p)) and not reads_files(spark, df, p, recursive):
        raise FileNotFoundError(f"no file directly in {p}; a directory holding only sub-directories needs recursive=True or a deeper glob")
    return df


def file_count(df: DataFrame) -> int:
    """Files that the scan of a reader's frame lists, empty ones included. Spark's file index
    has listed them already; only their number leaves it (a remote session gets the names)."""
    try:
        return len(df._jdf.inputFiles())
    except AttributeError:  # remote (Connect) session
        return len(df.inputFiles())


def reads_files(spark: SparkSession, df: DataFrame, paths: Sequence[str], recursive: bool = False) -> bool:
    """Whether a reader's frame over ``paths`` lists any file that belongs to them: files
    of plain sub-directories don't, though Spark would read ``name=value`` ones below them."""
    if not file_count(df):
        return False
    return recursive or any(map(is_glob, paths)) or not all(_only_directories(spark, p) for p in paths)


def _only_directories(spark: SparkSession, path: str) -> bool:
    """Whether a path is a directory whose visible entries are directories that aren't
    ``name=value`` ones. A few calls, however many there are."""
    fs_path = _hadoop_fs(spark, path)
    if fs_path is None:
        return False
    fs, p = fs_path
    if not fs.getFileStatus(p).isDirectory():
        return False
    entries = [(name.rstrip("/").rsplit("/", 1)[-1], is_dir) for name, is_dir in _statuses(spark, fs.listStatus(p))]
    return all(is_dir and "=" not in name for name, is_dir in entries if not _hidden(name))


def is_glob(path: str) -> bool:
    """Whether a path holds glob syntax (``*?[{``) that a reader would expand."""
    return any(ch in path for ch in "*?[{")


def escape_glob(path: str) -> str:
    """Make a listed path literal for a reader, which would otherwise take
    ``*?[]{}`` in a name as glob syntax (a backslash escapes them)."""
    return "".join("\\" + ch if ch in "*?[]{}\\" else ch for ch in path)


def glob_regex(glob: str) -> str:
    """The regular expression of the whole paths that a reader's glob matches: ``*`` and ``?``
    within a name, ``[a-c]``, ``[^a]`` or ``[!a]``, ``{a,b}`` (also across names and nested),
    and a backslash before a literal character."""
    import re

    out, depth, i = [], 0, 0
    while i < len(glob):
        ch = glob[i]
        if ch == "\\" and i + 1 < len(glob):
            i += 1
            out.append(re.escape(glob[i]))
        elif ch == "*":
            out.append("[^/]*")
        elif ch == "?":
            out.append("[^/]")
        elif ch == "[" and "]" in glob[i + 1 :]:
            end = glob.index("]", i + 1)
            inside = glob[i + 1 : end]
            negated = inside[:1] in ("^", "!")
            members = re.sub(r"([\[\]\\&^])", r"\\\1", inside[negated:])
            out.append(f"[^/{members}]" if negated else f"[{members}]")
            i = end
        elif ch == "{":
            depth += 1
            out.append("(?:")
        elif ch == "}" and depth:
            depth -= 1
            out.append(")")
        elif ch == "," and depth:
            out.append("|")
        else:
            out.append(re.escape(ch))
        i += 1
    return "".join(out)


def expand_glob(spark: SparkSession, glob: str) -> list[tuple[str, bool]] | None:
    """The paths that a glob matches, qualified, and whether each is a directory (also
    hidden ones, which a reader takes if they're matched). One transfer however many
    there are; None without a gateway."""
    fs_path = _hadoop_fs(spark, glob)
    if fs_path is None:
        return None
    fs, p = fs_path
    found = fs.globStatus(p)
    if found is None or not len(found):
        return []
    return sorted({(path.rstrip("/"), is_dir) for path, is_dir in _statuses(spark, found)})


def _hidden(name: str) -> bool:
    return name.startswith("_") or name.startswith(".")


def _hadoop_fs(spark: SparkSession, path: str):
    """(FileSystem, Path) of the session's Hadoop configuration, or None
    when the session has no JVM gateway."""
    try:
        sc = spark.sparkContext
        jvm = sc._jvm
        conf = sc._jsc.hadoopConfiguration()
    except Exception:  # remote (Connect) session
        return None
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def has_file_system(spark: SparkSession) -> bool:
    """Whether the session can ask its file system directly (a remote session can't)."""
    return _hadoop_fs(spark, "/") is not None


def list_dirs(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Immediate, non-hidden sub-directories of ``path`` as (name, qualified path),
    sorted by name. Raises when ``path`` does not exist."""
    fs_path = _hadoop_fs(spark, path)
    if fs_path is None:
        return _list_dirs_by_files(spark, path)
    fs, p = fs_path
    if not fs.exists(p):
        raise FileNotFoundError(path)
    out, plain = [], 0
    for full, is_dir in _statuses(spark, fs.listStatus(p)):
        name = full.rstrip("/").rsplit("/", 1)[-1]
        if _hidden(name):
            continue
        if is_dir:
            out.append((name, full))
        else:
            plain += 1
    if plain:
        _log.warning("%d plain files beside the directories of %s are not tables", plain, path)
    return sorted(out)


def _statuses(spark: SparkSession, statuses) -> list[tuple[str, bool]]:
    """Path and whether it is a directory of each file status, in one transfer
    from the JVM however many there are. A file system whose statuses print
    otherwise is asked one by one."""
    import re

    text = spark.sparkContext._jvm.org.apache.commons.lang3.ArrayUtils.toString(statuses)
    pieces = re.split(r"(?:^\{|,)\w*FileStatus\{path=(?=\w+:)", text)[1:]
    found = [re.match(r"(.*); isDirectory=(true|false); (?:length|modification_time)=", x, re.DOTALL) for x in pieces]
    if len(found) == len(statuses) and all(found):
        return [(m[1], m[2] == "true") for m in found]
    return [(st.getPath().toString(), st.isDirectory()) for st in statuses]


def _list_dirs_by_files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """Fallback of :func:`list_dirs`: the first path component below ``path``
    of every non-empty file under it (one distributed listing)."""
    base = path.rstrip("/")
    if base.startswith("file://"):
        base = base[len("file://"):]
    files = list_files(spark, path, recursive=True)
    start = F.instr("path", base + "/")  # the first occurrence: a table may be named like the base
    rel = F.expr(f"substring(path, instr(path, '{(base + '/').replace(chr(39), chr(39) * 2)}') + {len(base) + 1})")
    first = F.substring_index(rel, "/", 1)
    rows = (
        files.where((start > 0) & (F.instr(rel, "/") > 0))  # inside a sub-directory, not directly in path
        .select(first.alias("name"), F.concat(F.substring("path", 1, start + len(base)), first).alias("dir"))
        .distinct()
        .collect()
    )
    return sorted((r["name"], r["dir"]) for r in rows if not _hidden(r["name"]))


def qualify(spark: SparkSession, path: str) -> str:
    """A plain path as Spark reports file paths (``file:/…``, ``s3a://…``),
    without asking the file system; a session without a gateway keeps the text."""
    fs_path = _hadoop_fs(spark, path)
    if fs_path is None:
        return ("file:" + path[len("file://"):] if path.startswith("file:///") else path).rstrip("/")
    fs, p = fs_path
    return fs.makeQualified(p).toString().rstrip("/")


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether a plain path is an existing file (unknown without a gateway: no)."""
    fs_path = _hadoop_fs(spark, path)
    if fs_path is None:
        return False
    fs, p = fs_path
    return bool(fs.exists(p) and fs.getFileStatus(p).isFile())


def _has_data_file(spark: SparkSession, path: str) -> bool:
    """True when a non-hidden, non-empty file exists somewhere below ``path``;
    stops at the first one found."""
    fs_path = _hadoop_fs(spark, path)
    if fs_path is None:
        return not list_files(spark, path, recursive=True).isEmpty()
    fs, p = fs_path
    return _has_file_below(fs, p, min_len=1)


def has_input_files(spark: SparkSession, paths: Sequence[str], *, recursive: bool = False) -> bool:
    """Whether a scan of ``paths`` (files, directories or globs) would find any
    non-hidden file. Spark lists the tree level by level, in parallel jobs where a level
    has many directories; the number of driver calls doesn't grow with it.

    A matched directory counts through the files directly inside it (at any
    depth with ``recursive``), as in Spark's file sources.
    """
    reader = spark.read.option("recursiveFileLookup", "true") if recursive else spark.read
    try:
        return reads_files(spark, reader.text(list(paths)), list(paths), recursive)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def _has_file_below(fs, path, min_len: int = 0) -> bool:
    base = fs.makeQualified(path).toString().rstrip("/")
    it = fs.listFiles(path, True)
    while it.hasNext():
        st = it.next()
        rel = st.getPath().toString()[len(base):]
        if st.getLen() >= min_len and not any(_hidden(part) for part in rel.split("/") if part):
            return True
    return False


def list_tables(
    spark: SparkSession,
    snapshot_path: str,
    *,
    limit: int | None = None,
) -> DataFrame:
    """Tables (sub-directories) of one snapshot: ``table, path``, sorted by name.

    ``limit`` keeps the first N (0 keeps none). The driver holds one name per
    table, never a file list.
    """
    tables = list_dirs(spark, snapshot_path)
    if limit is not None:
        tables = tables[: max(int(limit), 0)]
    return spark.createDataFrame(tables, "table string, path string")


def latest_snapshot(
    spark: SparkSession,
    root: str,
    *,
    pointer: str | None = LATEST_POINTER,
    stamp_pattern: str | None = STAMP_PATTERN,
) -> DataFrame:
    """One row, ``snapshot STRING``: the latest snapshot below ``root`` (NULL
    when there is none).

    If the file ``pointer`` exists there, its first line names it, whatever
    other directories exist: a dump still being written is not in it yet.
    Otherwise it is the greatest directory name matching ``stamp_pattern`` (a
    regular expression; stamps ``yyyy-MM-dd-HH-mm-ss`` sort as text) that holds at
    least one non-empty file. ``pointer=None`` ignores the file,
    ``stamp_pattern=None`` takes any name.
    """
    return spark.createDataFrame([(_latest_name(spark, root, pointer, stamp_pattern),)], "snapshot string")


def _pointed(spark: SparkSession, root: str, pointer: str) -> str | None:
    """The first line of the pointer file; None without one."""
    fs_path = _hadoop_fs(spark, f"{root.rstrip('/')}/{pointer}")
    if fs_path is None:
        return None
    fs, p = fs_path
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    name = text.split("\n", 1)[0].strip().rstrip("/").rsplit("/", 1)[-1]
    if not name:
        raise ValueError(f"{root}/{pointer} names no snapshot")
    return name


def _latest_name(spark: SparkSession, root: str, pointer: str | None, stamp_pattern: str | None) -> str | None:
    import re

    if pointer and (name := _pointed(spark, root, pointer)):
        return name
    names = [(n, p) for n, p in list_dirs(spark, root) if not stamp_pattern or re.search(stamp_pattern, n)]
    for name, path in sorted(names, reverse=True):
        if _has_data_file(spark, path):
            return name
    return None


def resolve_latest(
    spark: SparkSession, root: str, *, pointer: str | None = LATEST_POINTER, stamp_pattern: str | None = STAMP_PATTERN
) -> str:
    """The latest snapshot name as a string (see :func:`latest_snapshot`)."""
    snap = _latest_name(spark, root, pointer, stamp_pattern)
    if snap is None:
        raise FileNotFoundError(f"no snapshot with data below {root}")
    return snap
