"""Acceptance queries over the driver's Parquet test tables.

The operators read text files, the test data is Parquet. Each query therefore
first has Spark write its input — text or JSON lines derived from a whole test
table — once per session below the shared working folder
(``spark.checkpoint.dir``), then runs the operator on it and returns a lazy
DataFrame. ``ORACLE_SQL`` holds, per query, a DuckDB statement that rebuilds
the same lines from the same tables and computes the expected result.

JSON lines are built by concatenating strings and integers, so both engines
produce identical text (no float or timestamp formatting involved).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptally.functions.text import path_component, text_length
from snaptally.operators.records import (
    ERROR,
    ERROR_KIND,
    IS_VALID,
    TABLE_NAME,
    parse_records,
    record_size_or_zero,
    typed_records,
)
from snaptally.operators.stats import (
    FILE_URI,
    RECORD_COUNT,
    TABLE_SIZE,
    dataset_stats,
    file_stats,
    merge_stats,
    path_stats,
    snapshot_table_counts,
    table_checksum,
    table_record_count,
    table_size,
    table_stats,
)
from snaptally.operators.words import contains_counts, word_count
from snaptally.session import scratch_path
from snaptally.sinks.writers import (
    Stage,
    dataset_report,
    format_stat,
    read_stats,
    stage_counts,
    tee,
    write_by_initial,
    write_parquet,
    write_report,
    write_stats,
)
from snaptally.sources.json import read_json, read_parquet
from snaptally.sources.listing import latest_snapshot, list_dirs, list_files, list_tables
from snaptally.sources.text import scan_lines
from snaptally.streaming.table_stats_stream import current_table_stats, start_table_stats

# --------------------------------------------------------------------------
# Staged inputs (written once per session and test-data folder)
# --------------------------------------------------------------------------

_STAGED: dict[tuple[str, str, str], str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[SparkSession, str, str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = _STAGED.get(key)
    if path is None:
        path = scratch_path(spark, f"stage-{name}")
        build(spark, sf_dir, path)
        _STAGED[key] = path
    return path


def _parts(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Spread staged lines over several part files, as in a real dump table."""
    return df.repartition(spark.sparkContext.defaultParallelism)


def _docs_text(spark, sf_dir, path):
    _parts(spark, _table(spark, sf_dir, "documents").select("text")).write.text(path)


def _docs_by(col):
    def build(spark, sf_dir, path):
        _table(spark, sf_dir, "documents").select(col, "text").write.partitionBy(col).text(path)

    return build


def _pages_by_bucket(spark, sf_dir, path):
    # one file per bucket, pages in page_id order inside it (the writer keeps
    # an order that already satisfies its partitioning)
    pages = _table(spark, sf_dir, "pages")
    (
        pages.select((F.col("page_id") % 10).alias("bucket"), "page_id", "html")
        .repartition("bucket")
        .sortWithinPartitions("bucket", "page_id")
        .select("bucket", "html")
        .write.partitionBy("bucket")
        .text(path)
    )


def _events_snapshots(spark, sf_dir, path):
    """A dump with plain names ``{path}/{stamp}/{table}``. Beside the latest
    snapshot's tables lie an empty one and a nested one; beside the snapshots a
    later one still being written, which ``_LATEST`` doesn't name, and a stray
    directory."""
    ev = _table(spark, sf_dir, "events")
    days = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("-00-00-00"))
    written = f"{path}/_written"
    (
        ev.select(
            days.alias("snap"),
            F.col("event_type").alias("tbl"),
            F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit("}")).alias("value"),
        )
        .write.partitionBy("snap", "tbl")
        .text(written)
    )
    # Spark names partition directories name=value: a dump has plain names
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    fs = at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    latest = ""
    for snap, where in list_dirs(spark, written):
        name = snap.partition("=")[2]
        latest = max(latest, name)
        for tbl, inner in list_dirs(spark, where):
            fs.rename(at(inner), at(f"{where}/{tbl.partition('=')[2]}"))
        fs.rename(at(where), at(f"{path}/{name}"))
    lines = _table(spark, sf_dir, "nation").select((F.col("n_nationkey") % 2).cast("int").alias("half"), F.to_json(F.struct("n_name")).alias("value"))
    lines.write.partitionBy("half").text(f"{path}/{latest}/ab-nested")
    lines.filter("false").select("value").write.text(f"{path}/{latest}/aa-empty")
    lines.select("value").write.text(f"{path}/2999-01-01-00-00-00/unfinished")
    lines.select("value").write.text(f"{path}/zz-tmp/x")
    out = fs.create(at(f"{path}/_LATEST"))
    out.writeBytes(latest + "\n")
    out.close()


def _large_json(spark, sf_dir, path):
    """JSON lines of all documents, their texts escaped. Documents 1 and 2 are repeated
    above 21,000,000 characters, more than the JSON parser takes; 3 and 4 also have two
    keys that differ, or don't, after 64 characters; 5 and 6 are nested 1,200 deep, 6 with
    a key twice at the bottom."""
    docs = _table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    safe = F.regexp_replace("text", r"[\x00-\x1F]", " ")
    safe = F.concat(F.replace(F.replace(safe, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit(" "))
    times = F.when(i.isin(1, 2, 3, 4), (F.lit(21_000_000) / F.length(safe)).cast("int") + 1).otherwise(1)
    key = F.repeat(F.lit("k"), 70)
    keys = F.when(i.isin(3, 4), F.concat(F.lit(',"'), key, F.lit('a":1,"'), key, F.when(i == 3, "b").otherwise("a"), F.lit('":2'))).otherwise("")
    twice = F.when(i == 6, ',"q":2').otherwise("")
    deep = F.when(i.isin(5, 6), F.concat(F.lit(',"deep":'), F.repeat(F.lit('{"a":['), 600), F.lit('{"q":1'), twice, F.lit("}"), F.repeat(F.lit("]}"), 600))).otherwise("")
    line = F.concat(F.lit('{"~table":"'), "lang", F.lit('","id":'), i.cast("string"), keys, deep, F.lit(',"text":"'), F.repeat(safe, times), F.lit('"}'))
    _parts(spark, docs.select("doc_id", "lang", "text")).select(line.alias("value")).write.text(path)


def _events_json(spark, sf_dir, path):
    _write_event_lines(spark, sf_dir, path, single_quoted=False)


def _events_json_quoted(spark, sf_dir, path):
    _write_event_lines(spark, sf_dir, path, single_quoted=True)


def _write_event_lines(spark, sf_dir, path, single_quoted: bool):
    ev = _table(spark, sf_dir, "events")
    i = F.col("event_id")
    base = F.when(
        i % 5 == 0, F.concat(F.lit('{"id":'), i.cast("string"), F.lit("}"))
    ).otherwise(
        F.concat(F.lit('{"~table":"'), F.col("event_type"), F.lit('","id":'), i.cast("string"), F.lit("}"))
    )
    line = (
        F.when(i % 11 == 0, F.lit(""))
        .when(i % 7 == 0, F.expr("substr(base, 1, length(base) - 3)"))
        .when(i % 13 == 0, F.concat(F.col("base"), F.lit(" x")))
        .when(i % 17 == 0, F.concat(F.lit("["), F.col("base"), F.lit("]")))
    )
    if single_quoted:  # good only for a lenient reader
        line = line.when(i % 23 == 0, F.translate(F.col("base"), '"', "'"))
    line = line.when(i % 19 == 0, F.concat(F.lit(" "), F.col("base"), F.lit(" "))).otherwise(F.col("base"))
    _parts(spark, ev.select("event_id", base.alias("base")).select(line.alias("value"))).write.text(path)


def _part_json(spark, sf_dir, path):
    part = _table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    name = F.when(k % 2 == 0, F.col("p_name")).otherwise(F.col("p_type"))
    lines = part.select(
        F.concat(F.lit('{"~table":"'), name, F.lit('","key":'), k.cast("string"), F.lit("}")).alias("value")
    )
    _parts(spark, lines).write.text(path)


def _events_props_json(spark, sf_dir, path):
    ev = _table(spark, sf_dir, "events")
    lines = ev.select(
        F.concat(
            F.lit('{"event_id":'), F.col("event_id").cast("string"),
            F.lit(',"event_type":"'), F.col("event_type"), F.lit('",'),
            F.expr("substr(props, 2)"),
        ).alias("value")
    )
    _parts(spark, lines).write.text(path)


# --------------------------------------------------------------------------
# Queries
# --------------------------------------------------------------------------


def _last(col: str, alias: str = "table"):
    return path_component(F.col(col), -1).alias(alias)


def q_scan_line_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_text", _docs_text)
    return dataset_stats(scan_lines(spark, root))


def q_dataset_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_text", _docs_text)
    report = dataset_report(dataset_stats(scan_lines(spark, root)), "documents.text")
    return spark.read.text(write_report(report, scratch_path(spark, "dataset-report")))


def q_scan_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_by_source", _docs_by("source"))
    # only the sources src1, src10 to src19: a reader that ignores the glob counts more
    st = path_stats(spark, [f"{root}/source=src1*", f"{root}/source=src[4-5]/*"])
    return st.select(F.regexp_extract("path", "source=(.*)$", 1).alias("glob"), RECORD_COUNT, TABLE_SIZE)


def _lang_dirs(spark: SparkSession, sf_dir: str) -> list[str]:
    root = _stage(spark, sf_dir, "docs_by_lang", _docs_by("lang"))
    # the table directories of the tree: a few path strings, not data
    return [r["path"] for r in list_tables(spark, root).collect()]


def q_path_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "pages_by_bucket", _pages_by_bucket)
    # every bucket, one of them twice, the one file of another, the whole tree and a glob
    dirs = [r["path"] for r in list_tables(spark, root).collect()]
    inside = [r["path"] for r in list_files(spark, f"{root}/bucket=7").collect()]
    names = {d: d.rsplit("/", 1)[-1] for d in dirs} | {f: "file" for f in inside} | {root: "all", f"{root}/bucket=[12]": "glob"}
    st = path_stats(spark, [*dirs, dirs[0], *inside, root, f"{root}/bucket=[12]"])
    name = F.coalesce(*[F.when(F.col("path") == p, F.lit(n)) for p, n in names.items()])
    return st.select(name.alias("table"), RECORD_COUNT, TABLE_SIZE)


def q_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "pages_by_bucket", _pages_by_bucket)
    st = file_stats(spark, f"{root}/*/*")
    return st.select(path_component(F.col(FILE_URI), -2).alias("table"), RECORD_COUNT, "fileSize", "fileBytes")


def q_file_stats_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "pages_by_bucket", _pages_by_bucket)
    st = file_stats(spark, f"{root}/*/*", whole=True)
    return st.select(path_component(F.col(FILE_URI), -2).alias("table"), RECORD_COUNT, "fileSize", "fileBytes")


def q_line_size_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "pages_by_bucket", _pages_by_bucket)
    v = F.col("value")
    return scan_lines(spark, f"{root}/*/*").agg(
        F.count(F.lit(1)).alias(RECORD_COUNT),
        *[F.sum(text_length(v, u)).cast("bigint").alias(f"{u}Size") for u in ("utf16", "chars", "bytes")],
    )


def q_list_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_by_lang", _docs_by("lang"))
    listing = write_parquet(list_files(spark, f"{root}/*/*"), scratch_path(spark, "file-list"))
    files = read_parquet(spark, listing)
    return files.groupBy(path_component(F.col("path"), -2).alias("table")).agg(
        F.sum("length").cast("bigint").alias("fileBytes")
    )


def q_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_by_source", _docs_by("source"))
    return list_tables(spark, root, limit=5).select("table")


def q_list_tables_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_by_source", _docs_by("source"))
    return list_tables(spark, root).select("table")


def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "events_snapshots", _events_snapshots)
    return latest_snapshot(spark, root)


def q_snapshot_table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "events_snapshots", _events_snapshots)
    return snapshot_table_counts(spark, root).select("table", RECORD_COUNT)


def q_snapshot_table_counts_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "events_snapshots", _events_snapshots)
    return snapshot_table_counts(spark, root, limit=3).select("table", RECORD_COUNT)


def q_large_record_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "large_json", _large_json)
    return table_stats(parse_records(scan_lines(spark, root), keep_record=False))


def _event_records(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    root = _stage(spark, sf_dir, "events_json", _events_json)
    return parse_records(scan_lines(spark, root), **kw)


def q_json_parse_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _event_records(spark, sf_dir, keep_record=False)
    return rec.groupBy(IS_VALID, ERROR).agg(F.count(F.lit(1)).alias(RECORD_COUNT))


def q_bad_record_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _event_records(spark, sf_dir, keep_record=False)
    return rec.groupBy(IS_VALID, ERROR_KIND).agg(F.count(F.lit(1)).alias(RECORD_COUNT))


def q_record_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _event_records(spark, sf_dir, keep_record=False)
    return rec.groupBy(TABLE_NAME, record_size_or_zero().alias("recordSize")).agg(
        F.count(F.lit(1)).alias(RECORD_COUNT)
    )


def q_table_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_record_count(_event_records(spark, sf_dir, keep_record=False))


def q_table_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_size(_event_records(spark, sf_dir, keep_record=False))


def q_table_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_stats(_event_records(spark, sf_dir, keep_record=False))


def q_table_stats_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "events_json_quoted", _events_json_quoted)
    return table_stats(parse_records(scan_lines(spark, root), lenient=True, keep_record=False))


def q_table_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "events_json", _events_json)
    name = "table_stats_" + uuid.uuid4().hex[:12]
    out = scratch_path(spark, "stream-out")
    q = start_table_stats(spark, root, out, query_name=name, checkpoint=scratch_path(spark, "stream-ckpt"),
                          available_now=True)
    if not q.awaitTermination(900):  # available-now ends by itself; never wait forever
        q.stop()
        raise TimeoutError("streaming table statistics did not finish")
    return current_table_stats(spark, out)


def q_table_stats_by_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "part_json", _part_json)
    stats = table_stats(parse_records(scan_lines(spark, root), keep_record=False))
    out = write_by_initial(stats, scratch_path(spark, "by-initial"))
    return read_stats(spark, out).select(TABLE_NAME, RECORD_COUNT, TABLE_SIZE, "initial")


def q_merge_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    # tables by event type on one side, by part name on the other; "unknown" on both
    counts = table_record_count(_event_records(spark, sf_dir, keep_record=False))
    roots = [_stage(spark, sf_dir, "events_props_json", _events_props_json), _stage(spark, sf_dir, "part_json", _part_json)]
    sizes = table_size(parse_records(scan_lines(spark, roots), keep_record=False))
    return merge_stats(counts, sizes)


def q_stats_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = table_stats(_event_records(spark, sf_dir, keep_record=False))
    path = write_stats(stats, scratch_path(spark, "stats-out"), program="table-stats")
    return read_stats(spark, path)


def q_text_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = path_stats(spark, _lang_dirs(spark, sf_dir)).withColumn("path", path_component(F.col("path"), -1))
    out = write_report(format_stat(st, key="path"), scratch_path(spark, "report"))
    return spark.read.text(out)


def q_tee_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = tee(_event_records(spark, sf_dir), "records", scratch_path(spark, "tee"))
    return rec.groupBy(IS_VALID, TABLE_NAME).agg(
        F.count(F.lit(1)).alias(RECORD_COUNT),
        F.sum(record_size_or_zero()).cast("bigint").alias(TABLE_SIZE),
    )


def q_json_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    # damaged lines, once with a schema and once with the inferred one
    root = _stage(spark, sf_dir, "events_json", _events_json)
    parts = []
    for way, schema in (("given", "`~table` string, id bigint"), ("inferred", None)):
        out = write_parquet(read_json(spark, root, schema=schema), scratch_path(spark, "json-parquet"))
        t = read_parquet(spark, out)
        parts.append(t.groupBy(F.lit(way).alias("way"), F.col("`~table`").alias("event_type")).agg(
            F.count(F.lit(1)).alias(RECORD_COUNT), F.sum("id").cast("bigint").alias("id_sum")
        ))
    return parts[0].unionByName(parts[1])


def q_records_to_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "events_props_json", _events_props_json)
    typed = typed_records(parse_records(scan_lines(spark, root)))
    t = read_parquet(spark, write_parquet(typed, scratch_path(spark, "records-parquet")))
    return t.groupBy("event_type").agg(
        F.count(F.lit(1)).alias(RECORD_COUNT), F.sum("k").cast("bigint").alias("k_sum")
    )


def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_count(_table(spark, sf_dir, "documents"), "text")


def q_word_count_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_text", _docs_text)
    return word_count(scan_lines(spark, root))


def q_contains_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _stage(spark, sf_dir, "docs_text", _docs_text)
    return contains_counts(scan_lines(spark, root), ("a", "b"))


def q_record_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = _event_records(spark, sf_dir, keep_record=False, checksum=True)
    return rec.select(TABLE_NAME, IS_VALID, F.col("`~checksum`").alias("checksum"))


def q_table_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_checksum(_event_records(spark, sf_dir, keep_record=False, checksum=True))


def q_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the stages of one job, observed while it writes its result."""
    root = _stage(spark, sf_dir, "events_json", _events_json)
    lines = Stage(scan_lines(spark, root), "lines", size=text_length("value"))
    records = Stage(parse_records(lines.frame, keep_record=False), "records", valid=F.col(IS_VALID).cast("long"), size=record_size_or_zero())
    write_stats(table_stats(records.frame), scratch_path(spark, "stats-out"), program="table-stats")
    return stage_counts(spark, [lines, records])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "table_stats": q_table_stats,
    "scan_line_stats": q_scan_line_stats,
    "dataset_report": q_dataset_report,
    "scan_glob": q_scan_glob,
    "path_stats": q_path_stats,
    "file_stats": q_file_stats,
    "file_stats_whole": q_file_stats_whole,
    "line_size_units": q_line_size_units,
    "list_files": q_list_files,
    "list_tables": q_list_tables,
    "list_tables_all": q_list_tables_all,
    "latest_snapshot": q_latest_snapshot,
    "snapshot_table_counts": q_snapshot_table_counts,
    "snapshot_table_counts_limit": q_snapshot_table_counts_limit,
    "large_record_stats": q_large_record_stats,
    "json_parse_quality": q_json_parse_quality,
    "bad_record_kinds": q_bad_record_kinds,
    "record_size": q_record_size,
    "table_record_count": q_table_record_count,
    "table_size": q_table_size,
    "table_stats_lenient": q_table_stats_lenient,
    "table_stats_stream": q_table_stats_stream,
    "table_stats_by_initial": q_table_stats_by_initial,
    "merge_stats": q_merge_stats,
    "stats_json_roundtrip": q_stats_json_roundtrip,
    "text_report": q_text_report,
    "tee_roundtrip": q_tee_roundtrip,
    "json_to_parquet": q_json_to_parquet,
    "records_to_parquet": q_records_to_parquet,
    "word_count": q_word_count,
    "word_count_lines": q_word_count_lines,
    "contains_counts": q_contains_counts,
    "record_checksum": q_record_checksum,
    "table_checksum": q_table_checksum,
    "stage_counts": q_stage_counts,
}

# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

# Length in UTF-16 code units: code points plus one per character above U+FFFF.
def _u16(x: str) -> str:
    return f"(length({x}) + length(regexp_replace({x}, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))"


_DOC_LINES = "(SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"
_DOC_LINES_BY = "(SELECT {c}, unnest(string_split(text, chr(10))) AS line FROM documents)"

_EVENT_RECORDS = """
WITH b AS (
  SELECT event_id AS id, event_type,
    CASE WHEN event_id % 5 = 0 THEN '{"id":' || CAST(event_id AS VARCHAR) || '}'
         ELSE '{"~table":"' || event_type || '","id":' || CAST(event_id AS VARCHAR) || '}' END AS base
  FROM events),
l AS (
  SELECT id, event_type,
    CASE WHEN id % 11 = 0 THEN ''
         WHEN id % 7 = 0 THEN substr(base, 1, length(base) - 3)
         WHEN id % 13 = 0 THEN base || ' x'
         WHEN id % 17 = 0 THEN '[' || base || ']'
         WHEN id % 19 = 0 THEN ' ' || base || ' '
         ELSE base END AS line,
    NOT (id % 11 = 0 OR id % 7 = 0 OR id % 13 = 0 OR id % 17 = 0) AS is_valid
  FROM b),
r AS (
  SELECT line, is_valid,
    CASE WHEN is_valid THEN NULL ELSE 'MALFORMED_JSON' END AS error,
    CASE WHEN is_valid AND id % 5 <> 0 THEN event_type ELSE 'unknown' END AS tableName,
    CASE WHEN is_valid THEN CAST(LEN16 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS size
  FROM l)
""".replace("LEN16", _u16("line"))

_PROPS_RECORDS = """
p AS (
  SELECT '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '",'
         || substr(props, 2) AS line FROM events),
q AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS t,
         '{"~table":"' || CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END
           || '","key":' || CAST(p_partkey AS VARCHAR) || '}' AS line FROM part),
ps AS (
  SELECT tableName, CAST(sum(LEN16) AS BIGINT) AS tableSize
  FROM (SELECT 'unknown' AS tableName, line FROM p UNION ALL SELECT t, line FROM q) u GROUP BY tableName)
""".replace("LEN16", _u16("line"))

_TABLE_STATS_SQL = _EVENT_RECORDS + """
SELECT tableName, CAST(count(*) AS BIGINT) AS recordCount, CAST(sum(size) AS BIGINT) AS tableSize
FROM r GROUP BY tableName"""

_LENIENT_STATS_SQL = """
WITH b AS (
  SELECT event_id AS id, event_type,
    CASE WHEN event_id % 5 = 0 THEN '{"id":' || CAST(event_id AS VARCHAR) || '}'
         ELSE '{"~table":"' || event_type || '","id":' || CAST(event_id AS VARCHAR) || '}' END AS base
  FROM events),
l AS (
  SELECT id, event_type,
    CASE WHEN id % 11 = 0 THEN ''
         WHEN id % 7 = 0 THEN substr(base, 1, length(base) - 3)
         WHEN id % 13 = 0 THEN base || ' x'
         WHEN id % 17 = 0 THEN '[' || base || ']'
         WHEN id % 23 = 0 THEN replace(base, '"', chr(39))
         WHEN id % 19 = 0 THEN ' ' || base || ' '
         ELSE base END AS line,
    NOT (id % 11 = 0 OR id % 7 = 0 OR id % 13 = 0 OR id % 17 = 0) AS is_valid
  FROM b)
SELECT CASE WHEN is_valid AND id % 5 <> 0 THEN event_type ELSE 'unknown' END AS tableName,
       CAST(count(*) AS BIGINT) AS recordCount,
       CAST(sum(CASE WHEN is_valid THEN LEN16 ELSE 0 END) AS BIGINT) AS tableSize
FROM l GROUP BY 1""".replace("LEN16", _u16("line"))

# the tables of the latest snapshot by event type; beside them an empty one and one
# whose lines lie in two sub-directories
_SNAPSHOT_COUNTS_SQL = """
SELECT event_type AS "table", CAST(count(*) AS BIGINT) AS recordCount FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) GROUP BY event_type
UNION ALL SELECT 'aa-empty', CAST(0 AS BIGINT)
UNION ALL SELECT 'ab-nested', CAST(count(*) AS BIGINT) FROM nation"""

ORACLE_SQL: dict[str, str] = {
    "table_stats": _TABLE_STATS_SQL,
    "scan_line_stats": f"""
SELECT CAST(count(*) AS BIGINT) AS recordCount, CAST(coalesce(sum({_u16('line')}), 0) AS BIGINT) AS tableSize
FROM {_DOC_LINES} t""",
    "dataset_report": f"""
SELECT 'processing input file : documents.text' AS value
UNION ALL
SELECT 'total data set line recordCount : ' || CAST(count(*) AS VARCHAR) FROM {_DOC_LINES} t
UNION ALL
SELECT 'total data set byte size : ' || CAST(coalesce(sum({_u16('line')}), 0) AS VARCHAR) FROM {_DOC_LINES} t""",
    "scan_glob": f"""
SELECT CASE WHEN source LIKE 'src1%' THEN 'src1*' ELSE 'src[4-5]/*' END AS "glob", CAST(count(*) AS BIGINT) AS recordCount,
       CAST(sum({_u16('line')}) AS BIGINT) AS tableSize
FROM {_DOC_LINES_BY.format(c='source')} t WHERE source LIKE 'src1%' OR source IN ('src4', 'src5') GROUP BY 1""",
    "path_stats": f"""
WITH l AS (SELECT page_id % 10 AS b, unnest(string_split(html, chr(10))) AS line FROM pages),
n AS (SELECT b, CAST(count(*) AS BIGINT) AS c, CAST(sum({_u16('line')}) AS BIGINT) AS s FROM l GROUP BY b)
SELECT 'bucket=' || CAST(b AS VARCHAR) AS "table", c AS recordCount, s AS tableSize FROM n
UNION ALL SELECT 'file', c, s FROM n WHERE b = 7
UNION ALL SELECT 'all', CAST(sum(c) AS BIGINT), CAST(sum(s) AS BIGINT) FROM n
UNION ALL SELECT 'glob', CAST(sum(c) AS BIGINT), CAST(sum(s) AS BIGINT) FROM n WHERE b IN (1, 2)""",
    "file_stats": f"""
SELECT 'bucket=' || CAST(page_id % 10 AS VARCHAR) AS "table",
       CAST(sum(len(string_split(html, chr(10)))) AS BIGINT) AS recordCount,
       CAST(sum({_u16('html')} + 1) AS BIGINT) AS fileSize,
       CAST(sum(strlen(html) + 1) AS BIGINT) AS fileBytes
FROM pages GROUP BY page_id % 10""",
    "file_stats_whole": f"""
WITH f AS (
  SELECT page_id % 10 AS b, string_agg(html || chr(10), '' ORDER BY page_id) AS content
  FROM pages GROUP BY page_id % 10)
SELECT 'bucket=' || CAST(b AS VARCHAR) AS "table",
       CAST(CASE WHEN content = '' THEN 1
                 WHEN rtrim(content, chr(10)) = '' THEN 0
                 ELSE len(string_split(rtrim(content, chr(10)), chr(10))) END AS BIGINT) AS recordCount,
       CAST({_u16('content')} AS BIGINT) AS fileSize,
       CAST(strlen(content) AS BIGINT) AS fileBytes
FROM f""",
    "line_size_units": f"""
SELECT CAST(count(*) AS BIGINT) AS recordCount,
       CAST(sum({_u16('line')}) AS BIGINT) AS utf16Size,
       CAST(sum(length(line)) AS BIGINT) AS charsSize,
       CAST(sum(strlen(line)) AS BIGINT) AS bytesSize
FROM (SELECT unnest(string_split(html, chr(10))) AS line FROM pages) t""",
    "list_files": """
SELECT 'lang=' || lang AS "table", CAST(sum(strlen(text) + 1) AS BIGINT) AS fileBytes
FROM documents GROUP BY lang""",
    "list_tables": """
SELECT DISTINCT 'source=' || source AS "table" FROM documents ORDER BY 1 LIMIT 5""",
    "list_tables_all": """
SELECT DISTINCT 'source=' || source AS "table" FROM documents""",
    "latest_snapshot": """
SELECT strftime(max(ts), '%Y-%m-%d') || '-00-00-00' AS snapshot FROM events""",
    "snapshot_table_counts": _SNAPSHOT_COUNTS_SQL,
    "snapshot_table_counts_limit": f"""
SELECT * FROM ({_SNAPSHOT_COUNTS_SQL}) t ORDER BY "table" LIMIT 3""",
    "large_record_stats": f"""
WITH s AS (
  SELECT doc_id AS i, lang, replace(replace(regexp_replace(text, '[\x00-\x1F]', ' ', 'g'), chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || ' ' AS t FROM documents),
l AS (
  SELECT i, lang, '{{"~table":"' || lang || '","id":' || CAST(i AS VARCHAR)
    || CASE WHEN i IN (3, 4) THEN ',"' || repeat('k', 70) || 'a":1,"' || repeat('k', 70) || CASE WHEN i = 3 THEN 'b' ELSE 'a' END || '":2' ELSE '' END
    || CASE WHEN i IN (5, 6) THEN ',"deep":' || repeat('{{"a":[', 600) || '{{"q":1' || CASE WHEN i = 6 THEN ',"q":2' ELSE '' END || '}}' || repeat(']}}', 600) ELSE '' END
    || ',"text":"' || repeat(t, CASE WHEN i IN (1, 2, 3, 4) THEN 21000000 // length(t) + 1 ELSE 1 END) || '"}}' AS line FROM s),
r AS (SELECT CASE WHEN i IN (4, 6) THEN 'unknown' ELSE lang END AS tableName, CASE WHEN i IN (4, 6) THEN 0 ELSE {_u16('line')} END AS size FROM l)
SELECT tableName, CAST(count(*) AS BIGINT) AS recordCount, CAST(sum(size) AS BIGINT) AS tableSize
FROM r GROUP BY tableName""",
    "json_parse_quality": _EVENT_RECORDS + """
SELECT is_valid, error, CAST(count(*) AS BIGINT) AS recordCount FROM r GROUP BY is_valid, error""",
    "bad_record_kinds": _EVENT_RECORDS + """
SELECT is_valid,
       CASE WHEN is_valid THEN NULL
            WHEN id % 11 = 0 THEN 'EMPTY_LINE'
            WHEN id % 7 = 0 OR id % 13 = 0 THEN 'INVALID_JSON'
            ELSE 'NOT_AN_OBJECT' END AS error_kind,
       CAST(count(*) AS BIGINT) AS recordCount
FROM l GROUP BY 1, 2""",
    "record_size": _EVENT_RECORDS + """
SELECT tableName, size AS recordSize, CAST(count(*) AS BIGINT) AS recordCount FROM r GROUP BY tableName, size""",
    "table_record_count": _EVENT_RECORDS + """
SELECT tableName, CAST(count(*) AS BIGINT) AS recordCount FROM r GROUP BY tableName""",
    "table_size": _EVENT_RECORDS + """
SELECT tableName, CAST(sum(size) AS BIGINT) AS tableSize FROM r GROUP BY tableName""",
    "table_stats_lenient": _LENIENT_STATS_SQL,
    "table_stats_stream": _TABLE_STATS_SQL,
    "table_stats_by_initial": """
WITH l AS (
  SELECT CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END AS t,
         '{"~table":"' || CASE WHEN p_partkey % 2 = 0 THEN p_name ELSE p_type END
           || '","key":' || CAST(p_partkey AS VARCHAR) || '}' AS line
  FROM part)
SELECT t AS tableName, CAST(count(*) AS BIGINT) AS recordCount, CAST(sum(LEN16) AS BIGINT) AS tableSize,
       CASE WHEN regexp_matches(substr(t, 1, 1), '^[a-z]$') THEN substr(t, 1, 1) ELSE 'other' END AS initial
FROM l GROUP BY t""".replace("LEN16", _u16("line")),
    "merge_stats": _EVENT_RECORDS + "," + _PROPS_RECORDS + """,
c AS (SELECT tableName, CAST(count(*) AS BIGINT) AS recordCount FROM r GROUP BY tableName)
SELECT coalesce(c.tableName, ps.tableName) AS tableName,
       coalesce(c.recordCount, CAST(-1 AS BIGINT)) AS recordCount,
       coalesce(ps.tableSize, CAST(-1 AS BIGINT)) AS tableSize
FROM c FULL OUTER JOIN ps ON c.tableName = ps.tableName""",
    "stats_json_roundtrip": _TABLE_STATS_SQL,
    "text_report": f"""
SELECT 'Stat{{emoTable=lang=' || lang || ', recordCount=' || CAST(count(*) AS VARCHAR)
       || ', tableSize=' || CAST(sum({_u16('line')}) AS VARCHAR) || '}}' AS value
FROM {_DOC_LINES_BY.format(c='lang')} t GROUP BY lang""",
    "tee_roundtrip": _EVENT_RECORDS + """
SELECT is_valid, tableName, CAST(count(*) AS BIGINT) AS recordCount, CAST(sum(size) AS BIGINT) AS tableSize
FROM r GROUP BY is_valid, tableName""",
    "json_to_parquet": _EVENT_RECORDS + """,
v AS (SELECT l.id, CASE WHEN l.id % 5 = 0 THEN NULL ELSE event_type END AS event_type FROM l WHERE is_valid),
w AS (SELECT event_type, CAST(count(*) AS BIGINT) AS recordCount, CAST(sum(id) AS BIGINT) AS id_sum FROM v GROUP BY 1)
SELECT 'given' AS way, * FROM w UNION ALL SELECT 'inferred' AS way, * FROM w""",
    "records_to_parquet": """
SELECT event_type, CAST(count(*) AS BIGINT) AS recordCount,
       CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum
FROM events GROUP BY event_type""",
    "word_count": """
SELECT word, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT unnest(CASE WHEN text = '' THEN ['']
                     WHEN rtrim(text, ' ') = '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split(rtrim(text, ' '), ' ') END) AS word
  FROM documents) t GROUP BY word""",
    "word_count_lines": f"""
SELECT word, CAST(count(*) AS BIGINT) AS count FROM (
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN rtrim(line, ' ') = '' THEN CAST([] AS VARCHAR[])
                     ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM {_DOC_LINES} t) w GROUP BY word""",
    "contains_counts": f"""
SELECT CAST(count(*) FILTER (WHERE contains(line, 'a')) AS BIGINT) AS lines_with_a,
       CAST(count(*) FILTER (WHERE contains(line, 'b')) AS BIGINT) AS lines_with_b
FROM {_DOC_LINES} t""",
    "record_checksum": _EVENT_RECORDS + """
SELECT tableName, is_valid, sha256(line) AS checksum FROM r""",
    "table_checksum": _EVENT_RECORDS + """,
d AS (SELECT tableName, unnest([1, 2, 3, 4]) AS lane, sha256(line) AS h FROM r),
n AS (SELECT tableName, lane, CAST('0x' || substr(h, 15 * lane - 14, 15) AS BIGINT) AS x FROM d),
g AS (SELECT tableName, lane, count(*) AS c, CAST(sum(x) % 1152921504606846976 AS BIGINT) AS s, bit_xor(x) AS b FROM n GROUP BY tableName, lane)
SELECT tableName, CAST(max(c) AS BIGINT) AS recordCount, string_agg(format('{:015x}', s), '' ORDER BY lane) AS checksumSum,
       string_agg(format('{:015x}', b), '' ORDER BY lane) AS checksumXor
FROM g GROUP BY tableName""",
    "stage_counts": _EVENT_RECORDS + """,
t AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(LEN16) AS BIGINT) AS chars, CAST(count(*) FILTER (WHERE is_valid) AS BIGINT) AS valid, CAST(sum(size) AS BIGINT) AS size FROM r)
SELECT 'lines' AS stage, 'rows' AS metric, n AS value FROM t UNION ALL SELECT 'lines', 'size', chars FROM t
UNION ALL SELECT 'records', 'rows', n FROM t UNION ALL SELECT 'records', 'valid', valid FROM t UNION ALL SELECT 'records', 'size', size FROM t""".replace("LEN16", _u16("line")),
}
