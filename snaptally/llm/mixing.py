"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of rows. With weight w, block i (from 0) of a source
is released at slot floor(i / w) and due by slot ceil((i + 1) / w). Earliest deadline
first over the released blocks keeps every source less than one block away from its
target at any slot.

Weights are exact fractions, so no rounding adds up however long the input is. The
driver walks over the blocks that exist, by their sources' counted rows, and keeps the
state at the start of each period; tasks schedule the periods from there. Rows get
their number within a source from per-bucket counts, so no source passes through one
task.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction
from itertools import islice

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PERIOD = 4_096  #: blocks that one task schedules at once
BLOCK_ROWS = 64
SEND_BLOCKS = 100_000  #: rows of the schedule that a join may broadcast
BUCKETS = 4_096  #: of each source, for numbering its rows
MAX_SOURCES = 2_048


def shares(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole slots of each source: its part of the period by largest remainder,
    one at least, so they sum to the period."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    if len(weights) > period:
        raise ValueError("more sources than slots in a period")
    total = sum(Fraction(w) for w in weights.values())
    exact = {s: Fraction(w) / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    by_rest = sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))
    i = 0
    while sum(out.values()) != period:
        if sum(out.values()) < period:
            out[by_rest[i % len(by_rest)]] += 1
        else:
            top = max(out, key=lambda s: (out[s], s))
            out[top] -= 1
        i += 1
    return out


def schedule(slots: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """One period: ``source, block, release, deadline, slot`` with blocks counted
    from 0. Equal deadlines go to the earlier release, then by name."""
    period = sum(slots.values())
    return list(_steps(slots, period, slots, {}, 0))


def _steps(weights: dict[str, int], total: int, ends: dict[str, int], had: dict[str, int], slot: int, states: int = 0, kept: list | None = None):
    """``source, block, release, deadline, slot`` from a slot on, for weights in parts
    of ``total``, until each source has had its blocks. A slot for which no block is
    released stays empty. Every ``states`` blocks the slot and the blocks had go to
    ``kept``."""
    had = {s: had.get(s, 0) for s in weights}
    released: list[tuple[int, int, str, int]] = []
    coming = [(had[s] * total // weights[s], s, had[s]) for s in weights if had[s] < ends.get(s, 0)]
    heapq.heapify(coming)
    n = 0
    while coming or released:
        if not released:
            slot = max(slot, coming[0][0])
        while coming and coming[0][0] <= slot:
            release, s, i = heapq.heappop(coming)
            heapq.heappush(released, (-(-(i + 1) * total // weights[s]), release, s, i))
        if states and n % states == 0:
            kept.append((slot, dict(had)))
        deadline, release, s, i = heapq.heappop(released)
        yield s, i, release, deadline, slot
        had[s], n, slot = i + 1, n + 1, slot + 1
        if i + 1 < ends[s]:
            heapq.heappush(coming, ((i + 1) * total // weights[s], s, i + 1))


def parts_of(weights: dict[str, float]) -> tuple[dict[str, int], int]:
    """The exact weights as whole parts, and their sum."""
    if not weights or min(weights.values()) <= 0:
        raise ValueError("weights must be positive")
    exact = {s: Fraction(w) for s, w in weights.items()}
    scale = math.lcm(*(x.denominator for x in exact.values()))
    whole = {s: int(x * scale) for s, x in exact.items()}
    return whole, sum(whole.values())


_PLAN = "mix_source string, mix_block long, mix_release long, mix_deadline long, mix_slot long"


def _planned(spark, weights: dict[str, float], blocks: dict[str, int], period: int) -> DataFrame:
    """The slot of every block."""
    if not blocks:
        return spark.createDataFrame([], _PLAN)
    whole, total = parts_of(weights)
    states: list = []
    for _ in _steps(whole, total, blocks, {}, 0, period, states):
        pass
    names = list(whole)
    shared = spark.sparkContext.broadcast((whole, total, blocks, names))
    starts = [(slot, [had[s] for s in names]) for slot, had in states]

    def run(start):
        whole, total, blocks, names = shared.value
        return islice(_steps(whole, total, blocks, dict(zip(names, start[1], strict=True)), start[0]), period)

    return spark.createDataFrame(spark.sparkContext.parallelize(starts, max(1, min(len(starts), 200))).flatMap(run), _PLAN)


def source_weights(documents: DataFrame, *, source: str = "source", power: float = 0.7, max_sources: int = MAX_SOURCES) -> dict[str, float]:
    """Target weights from the sources' own sizes, evened out: rows to ``power``.
    A null source is the source ``""``. At most ``max_sources`` may exist, since
    their names and weights pass the driver."""
    return _powers(_counts(documents, source, max_sources), power, max_sources)


def _counts(documents: DataFrame, source: str, most: int) -> dict[str, int]:
    """Rows of each source, of one more than ``most`` at most."""
    return {r["s"]: r["count"] for r in documents.groupBy(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("s")).count().limit(most + 1).collect()}


def _powers(counts: dict[str, int], power: float = 0.7, max_sources: int = MAX_SOURCES) -> dict[str, float]:
    if len(counts) > max_sources:
        raise ValueError(f"more than {max_sources} sources: give the weights of groups of them")
    return {s: float(n) ** power for s, n in counts.items()}


def interleave(documents: DataFrame, weights: dict[str, float] | None = None, *, id: str = "doc_id", source: str = "source", block_rows: int = BLOCK_ROWS, period: int = PERIOD, buckets: int = BUCKETS) -> DataFrame:
    """Every row with its place in the mix: the row's columns, then ``mix_block``
    (of its source), ``mix_release``, ``mix_deadline``, ``mix_slot`` and
    ``mix_row`` (within its block). Sorted by ``mix_slot, mix_row`` the rows are the
    interleaved order.

    No row is dropped or repeated. While all sources have rows left, the blocks of
    each source among the first t slots differ from t times its weight by less than
    one. A source that has run out leaves its slots empty. ``weights`` has a weight
    for each source (default: :func:`source_weights`); a source without one is an
    error. Rows of a source are numbered by a hash of their id, then id; equal rows in any
    order. A null source counts as ``""``; a null id is an id like any other. An empty
    table gives an empty result. Input columns named like the added ones are replaced.
    """
    added = {"mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_row"}
    documents = documents.select(*[F.col(f"`{c}`") for c in documents.columns if c.lower() not in added])
    spark = documents.sparkSession
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    counts = _counts(documents, source, MAX_SOURCES if weights is None else len(weights))
    given = weights if weights is not None else _powers(counts)
    for s in counts:
        if s not in given:
            raise ValueError(f"no weight for source {s}")
    blocks = {s: -(-n // block_rows) for s, n in counts.items()}
    table = _planned(spark, given, blocks, period)
    if sum(blocks.values()) <= SEND_BLOCKS:
        table = F.broadcast(table)
    # number the rows of a source: buckets by hash, then rows within a bucket
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])  # whatever its names, nothing below clashes with them
    keyed = documents.select(whole.alias("row"), name.alias("mix_source"), F.col(id).alias("mix_id"), F.xxhash64(F.col(id), F.lit(17)).alias("mix_hash"))
    keyed = keyed.withColumn("mix_bucket", F.pmod("mix_hash", F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy("mix_source", "mix_bucket").count()
    before = F.sum("count").over(Window.partitionBy("mix_source").orderBy("mix_bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("mix_source", "mix_bucket", F.coalesce(before, F.lit(0)).alias("mix_before"))
    inside = Window.partitionBy("mix_source", "mix_bucket").orderBy("mix_hash", "mix_id")
    numbered = (
        keyed.withColumn("mix_inside", F.row_number().over(inside) - 1)
        .join(sizes, ["mix_source", "mix_bucket"])
        .withColumn("mix_number", F.col("mix_before") + F.col("mix_inside"))
        .withColumns({"mix_block": F.floor(F.col("mix_number") / block_rows), "mix_row": F.col("mix_number") % block_rows})
    )
    placed = numbered.join(table, ["mix_source", "mix_block"])
    return placed.select(
        *[F.col(f"row.`{c}`").alias(c) for c in documents.columns],
        *[F.col(c).cast("long").alias(c) for c in ("mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_row")],
    )


def in_mix_order(documents: DataFrame, weights: dict[str, float] | None = None, **options) -> DataFrame:
    """The rows of :func:`interleave` in the order of the mix, with the columns
    they came with: partitions hold successive ranges of slots, sorted."""
    order = ["mix_slot", "mix_row"]
    return interleave(documents, weights, **options).repartitionByRange(*order).sortWithinPartitions(*order).select(*[f"`{c}`" for c in documents.columns])


def op3_pfair_mix(spark, sf_dir: str) -> DataFrame:
    """The place of all documents in the mix of their sources."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source")
    return interleave(docs)
