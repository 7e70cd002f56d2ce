"""Helpers shared by the operators: written intermediate tables, one row per id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptally.session import scratch_path


def written(df: DataFrame, *, codec: str = "zstd") -> DataFrame:
    """The frame written as Parquet to the shared folder and read back.

    Cuts the lineage in a place that survives the loss of executors.
    """
    path = scratch_path(df.sparkSession, "llm")
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SEND_IDS = 2_000_000  #: rows of ids (16 MB) that a join may broadcast


def sendable(ids: DataFrame) -> DataFrame:
    """A written table of ids, marked for broadcast if its counted rows are few
    enough; otherwise as it is, and the join shuffles."""
    return F.broadcast(ids) if ids.count() <= SEND_IDS else ids


def has_repeats(df: DataFrame, key: str) -> bool:
    """Whether a non-null key occurs twice. Reads the key column alone."""
    return bool(df.filter(F.col(key).isNotNull()).groupBy(key).count().filter("count > 1").limit(1).count())


def one_row_per_id(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key, value`` with one row per non-null key.

    A key that repeats keeps its smallest value (null counts as smallest only if
    all are null). The check for repeats reads the key column alone; only when
    it finds some are the values grouped.
    """
    rows = df.select(F.col(key), F.col(value)).filter(F.col(key).isNotNull())
    return rows.groupBy(key).agg(F.min(value).alias(value)) if has_repeats(df, key) else rows

