"""Session helpers: a local session for tests and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "snaptally") -> SparkSession:
    """A local session for tests and benchmarks (UI off, adaptive execution on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SNAPTALLY_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared working folder: ``spark.checkpoint.dir``.

    It is read from the session. Only a local session (tests) without one gets
    a fresh local folder, registered as its checkpoint folder; on a cluster a
    missing setting is an error, since executors cannot share a local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception as e:  # a remote session: a folder of the client is not the cluster's
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster") from e
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(_local_fallback())
    return sc.getCheckpointDir().rstrip("/")


_FALLBACK: list[str] = []


def _local_fallback() -> str:
    """One local folder per process, for sessions without a configured one."""
    if not _FALLBACK:
        _FALLBACK.append(tempfile.mkdtemp(prefix="snaptally-ckpt-"))
    return _FALLBACK[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below :func:`shared_dir` for one written table."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_MB = 1 << 20


def recommended_conf(input_bytes: int, total_cores: int) -> dict[str, str]:
    """Session settings for a statistics job over ``input_bytes`` of text on a
    cluster with ``total_cores`` task slots.

    Scan splits are sized for about three waves of tasks, between 128 MB and
    1 GB each. Per-task memory stays flat whatever the split size, since the
    statistics aggregate partially inside the task. Shuffle partitions are two
    per slot; adaptive execution coalesces the small post-aggregate partitions
    and splits skewed ones.
    """
    if input_bytes <= 0 or total_cores <= 0:
        raise ValueError("input_bytes and total_cores must be positive")
    split = input_bytes // (3 * total_cores)
    split = max(128 * _MB, min(1024 * _MB, split))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.files.openCostInBytes": str(4 * _MB),
        "spark.sql.shuffle.partitions": str(2 * total_cores),
    }
