"""Result writers. Executors write; no result row passes through the driver."""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from snaptally.operators.stats import INITIAL, RECORD_COUNT, TABLE_SIZE, with_initial

# Report texts of the line statistics job and of a path statistic.
REPORT_INPUT = "processing input file : "
REPORT_LINES = "total data set line recordCount : "
REPORT_SIZE = "total data set byte size : "
STAT_FORMAT = "Stat{emoTable=%s, recordCount=%d, tableSize=%d}"


def run_stamp(now: _dt.datetime | None = None) -> str:
    """UTC run stamp to the millisecond, e.g. ``2026-12-02T11-15-45-013``."""
    t = now or _dt.datetime.now(_dt.timezone.utc)
    return t.strftime("%Y-%m-%dT%H-%M-%S-") + f"{t.microsecond // 1000:03d}"


def run_dir(out: str, program: str, stamp: str | None = None) -> str:
    """``{out}/{program}-{stamp}``: the directory of one run's outputs."""
    return f"{out.rstrip('/')}/{program}-{stamp or run_stamp()}"


def dataset_report(stats: DataFrame, input_path: str) -> DataFrame:
    """Three report lines (``value``) from a :func:`dataset_stats` row, in order."""
    return stats.select(
        F.explode(
            F.array(
                F.lit(REPORT_INPUT + input_path),
                F.concat(F.lit(REPORT_LINES), F.col(RECORD_COUNT).cast("string")),
                F.concat(F.lit(REPORT_SIZE), F.col(TABLE_SIZE).cast("string")),
            )
        ).alias("value")
    )


def format_stat(stats: DataFrame, key: str = "path") -> DataFrame:
    """``value`` = ``Stat{emoTable=…, recordCount=…, tableSize=…}`` per row."""
    return stats.select(
        F.format_string(STAT_FORMAT, F.col(key), F.col(RECORD_COUNT), F.col(TABLE_SIZE)).alias("value")
    )


def write_report(lines: DataFrame, directory: str, *, single_file: bool = False) -> str:
    """Write report lines as text. ``single_file`` is for the three lines of a
    dataset report, which come from one row and keep their order; reports of
    many paths or tables have no order and are written by many tasks."""
    df = lines.coalesce(1) if single_file else lines
    df.write.mode("errorifexists").text(directory)
    return directory


def write_stats(
    stats: DataFrame,
    out: str,
    *,
    program: str = "table-stats",
    marker: str = "stats",
    stamp: str | None = None,
    keep_nulls: bool = False,
) -> str:
    """Statistics as JSON lines under ``{out}/{program}-{stamp}/{marker}``.

    NULL fields are left out of each line unless ``keep_nulls``. Existing
    output is never overwritten.
    """
    path = f"{run_dir(out, program, stamp)}/{marker}"
    w = stats.write.mode("errorifexists")
    if keep_nulls:
        w = w.option("ignoreNullFields", "false")
    w.json(path)
    return path


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """Read statistics written by :func:`write_stats` with their fixed schema."""
    return spark.read.schema(
        f"tableName STRING, {RECORD_COUNT} BIGINT, {TABLE_SIZE} BIGINT"
    ).json(path)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    partition_by: Sequence[str] | None = None,
) -> str:
    """Parquet write; by default fails if ``path`` exists."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_by_initial(stats: DataFrame, path: str, *, key: str = "tableName", fmt: str = "json") -> str:
    """Statistics split into one directory per initial (``initial=a`` …
    ``initial=z``, ``initial=other``) in a single write, so every table is
    delivered whatever its first character."""
    with_initial(stats, key).write.mode("errorifexists").partitionBy(INITIAL).format(fmt).save(path)
    return path


class Stage:
    """Counts of an intermediate stage, taken while the job that it's part of runs.

    ``frame`` is the stage's rows, unchanged; use it in place of the input. After an action
    over it, :meth:`counts` gives ``rows`` and the totals asked for, without a
    write, a read or a job of their own. Rows of every action are the rows of one."""

    def __init__(self, df: DataFrame, marker: str, **totals: Column):
        self.marker, self._seen = marker, Observation(f"{marker}-{uuid.uuid4().hex[:12]}")
        self.frame = df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for n, c in totals.items()])

    def counts(self) -> dict[str, int]:
        """Waits for the first action over ``frame``."""
        return {"stage": self.marker, **self._seen.get}


def stage_counts(spark: SparkSession, stages: Sequence[Stage]) -> DataFrame:
    """``stage, metric, value`` of stages whose job has run: a few rows."""
    rows = [(c["stage"], name, int(value)) for c in (s.counts() for s in stages) for name, value in c.items() if name != "stage"]
    return spark.createDataFrame(rows, "stage string, metric string, value bigint")


def tee(
    df: DataFrame,
    marker: str,
    directory: str,
    *,
    enabled: bool = True,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Write an intermediate stage to ``{directory}/{marker}`` (Parquet) when
    ``enabled`` and continue from the written copy.

    Continuing from the copy means the stage is computed once for both the
    debug output and the rest of the job, and the lineage is cut there.
    Disabled, the DataFrame is returned unchanged.
    """
    if not enabled:
        return df
    path = f"{directory.rstrip('/')}/{marker}"
    df.write.mode("errorifexists").parquet(path)
    return (spark or df.sparkSession).read.parquet(path)
