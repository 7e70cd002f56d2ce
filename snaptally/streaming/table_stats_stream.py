"""Table statistics of a dump that grows while part files arrive.

Each new file is parsed once, and each batch of files leaves one row a table: its lines
and their size, written to a folder of the batch's own. A batch that is repeated after a
failure writes the same folder again, so no line is counted twice, and the dump itself is
never read again. The rows are tables x batches; :func:`compact_table_stats` merges those
of finished batches into tables. No row passes the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from snaptally.operators.records import TABLE_NAME, parse_records, record_size_or_zero
from snaptally.operators.stats import RECORD_COUNT, TABLE_SIZE
from snaptally.session import shared_dir
from snaptally.sources.listing import has_file_system, is_file, list_dirs

_SCHEMA = f"{TABLE_NAME} string, {RECORD_COUNT} bigint, {TABLE_SIZE} bigint"
_BATCH, _UPTO = "batch-", "upto-"  # folders: one batch; all batches up to a number, merged


def record_sizes_stream(
    spark: SparkSession,
    input_dir: str,
    *,
    lenient: bool = False,
    unit: str = "utf16",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming ``tableName, size`` of every line of the files that appear in
    ``input_dir`` (a directory or glob of JSON-lines files)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    records = parse_records(reader.load(input_dir), lenient=lenient, unit=unit, keep_record=False)
    return records.select(TABLE_NAME, record_size_or_zero().alias("size"))


def start_table_stats(
    spark: SparkSession,
    input_dir: str,
    out: str,
    *,
    query_name: str = "table_stats",
    checkpoint: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    **kw,
) -> StreamingQuery:
    """Add the statistics of new files to ``out``; :func:`current_table_stats` of it
    gives the statistics at any time.

    Progress is kept under ``checkpoint`` (default: a folder below
    ``spark.checkpoint.dir``), so a restarted query resumes from the files not
    yet read. ``available_now`` processes what is there and stops. One query writes to
    one ``out``.
    """
    ckpt = checkpoint or f"{shared_dir(spark)}/{query_name}-stream"

    def add(batch: DataFrame, number: int) -> None:
        totals = batch.groupBy(TABLE_NAME).agg(F.count(F.lit(1)).alias(RECORD_COUNT), F.sum("size").alias(TABLE_SIZE))
        totals.write.mode("overwrite").parquet(f"{out.rstrip('/')}/{_BATCH}{number:012d}")

    w = (
        record_sizes_stream(spark, input_dir, **kw)
        .writeStream.foreachBatch(add)
        .queryName(query_name)
        .option("checkpointLocation", ckpt)
    )
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def _finished(spark: SparkSession, out: str) -> tuple[list[str], int]:
    """The folders that together hold every finished batch once, and the last batch's
    number. A folder without its success mark is still being written."""
    try:
        names = dict(list_dirs(spark, out))
    except FileNotFoundError:
        return [], -1
    merged = sorted((n for n in names if n.startswith(_UPTO) and _is_done(spark, names[n])), reverse=True)
    upto = int(merged[0][len(_UPTO) :]) if merged else -1
    batches = {int(n[len(_BATCH) :]): p for n, p in names.items() if n.startswith(_BATCH)}
    newer = [b for b in sorted(batches) if b > upto and _is_done(spark, batches[b])]
    return [names[m] for m in merged[:1]] + [batches[b] for b in newer], max([upto, *newer])


def _is_done(spark: SparkSession, path: str) -> bool:
    return not has_file_system(spark) or is_file(spark, f"{path}/_SUCCESS")


def current_table_stats(spark: SparkSession, out: str) -> DataFrame:
    """``tableName, recordCount, tableSize`` over all finished batches in ``out``."""
    paths, _ = _finished(spark, out)
    rows = spark.read.schema(_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], _SCHEMA)
    return rows.groupBy(TABLE_NAME).agg(F.sum(RECORD_COUNT).alias(RECORD_COUNT), F.sum(TABLE_SIZE).alias(TABLE_SIZE))


def compact_table_stats(spark: SparkSession, out: str) -> str | None:
    """Merge the finished batches of ``out`` into one row a table, in a new folder beside
    them; readers take it as soon as it's finished, and the query may go on meanwhile.
    Returns the folder, None if there is nothing to merge. Older folders are no longer
    read and may be removed."""
    paths, last = _finished(spark, out)
    if len(paths) < 2:
        return None
    folder = f"{out.rstrip('/')}/{_UPTO}{last:012d}"
    current_table_stats(spark, out).coalesce(1).write.mode("overwrite").parquet(folder)
    return folder
