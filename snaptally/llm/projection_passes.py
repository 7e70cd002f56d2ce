"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every vector to the signs of its products with random planes,
orders the vectors by that code and compares each with its neighbours. Vectors at
a small angle share long prefixes of some codes. Unit vectors are centred on the mean
of their label first, so a label that lies in a cone spreads over the codes too; links
are verified on the vectors themselves.

The first passes follow from the number of vectors, the threshold and the recall
wanted (:func:`passes_for`). They measure on every row how many bits of its code the
comparison covered; labels where that is too few get more passes (:func:`_more_passes`).

A neighbour window is a block of rows. While a block still holds a link with the
block compared last, the comparison goes on to the block before, so dense groups
are covered to their end. Windows go on over the borders of partitions
(:func:`_across`). Equal vectors are one row with a count.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._components import components
from ._flat import record
from ._shared import one_row_per_id, written

BITS = 62
BLOCK = 64  #: rows compared as one block; each also meets the block before
RECALL = 0.9995
MOST_PASSES = 4_096  #: of a label, however dense it lies
BIN = 8  #: bins of a factor of two in the chance of a pass


def passes_for(rows: int, threshold: float, recall: float = RECALL, block: int = BLOCK) -> int:
    """Passes that find a pair at the threshold with the wanted probability, if
    ``rows`` vectors spread evenly over the codes."""
    same = 1 - math.acos(min(1.0, threshold)) / math.pi
    bits = max(1.0, math.log2(max(2, rows) / block) + 1)
    once = same**bits
    return max(2, math.ceil(math.log(1 - recall) / math.log(1 - min(once, 0.999))))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), offsets - offsets[0]


def _code_rows(bits: int, seed: int):
    """Each row in its passes: from ``since`` of the row to ``passes``. The planes of a
    pass don't depend on how many there are."""
    schema = pa.schema([("pass", pa.int32()), ("code", pa.int64()), ("dim", pa.int32()), ("radius", pa.float32()), ("label", pa.string()), ("class", pa.int64()), ("vector", pa.list_(pa.float64()))])

    def run(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column("vector")
            flat, offsets = _lists(column)
            dims = np.diff(offsets)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                v = _unit(None, flat[offsets[rows][:, None] + np.arange(dim)])[2]
                part = batch.take(pa.array(rows))
                v = v - _lists(part.column("center"))[0].reshape(len(rows), dim)
                radius = np.sqrt(np.einsum("ij,ij->i", v, v)).astype(np.float32)
                first, last = part.column("since").to_numpy(), part.column("passes").to_numpy()
                for p in range(int(first.min()), int(last.max())):
                    if (dim, p) not in planes:
                        planes[dim, p] = np.random.default_rng([seed, dim, p]).standard_normal((dim, bits))
                    at = np.flatnonzero((first <= p) & (p < last))
                    codes = (v[at] @ planes[dim, p] > 0).astype(np.int64) @ weights
                    own = part.take(pa.array(at))
                    yield record(schema, np.full(len(at), p, dtype=np.int32), codes, np.full(len(at), dim, dtype=np.int32), radius[at], own.column("label"), own.column("class"), own.column("vector"))

    return run


def _center_rows(batches):
    """Sums of the unit vectors of each label and length in a batch."""
    schema = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.float64()))])
    for batch in batches:
        flat, offsets = _lists(batch.column("vector"))
        dims = np.diff(offsets)
        for dim in np.unique(dims).tolist():
            rows = np.flatnonzero(dims == dim)
            v = _unit(None, flat[offsets[rows][:, None] + np.arange(dim)])[2]
            labels = batch.column("label").take(pa.array(rows)).dictionary_encode()
            at = labels.indices.to_numpy()
            sums = np.zeros((len(labels.dictionary), dim))
            np.add.at(sums, at, v)
            yield record(schema, labels.dictionary, [dim] * len(sums), np.bincount(at, minlength=len(sums)), sums.tolist())


def _centers(classes: DataFrame) -> DataFrame:
    """``label, dim, center``: the mean of the unit vectors."""
    sums = classes.select("label", "vector").mapInArrow(_center_rows, "label string, dim int, n long, sums array<double>")
    each = sums.select("label", "dim", "n", F.posexplode("sums").alias("i", "x")).groupBy("label", "dim", "i").agg((F.sum("x") / F.sum("n")).alias("x"))
    return each.groupBy("label", "dim").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("c")).select("label", "dim", F.col("c.x").alias("center"))


def _more_passes(measured: DataFrame, passes: int, recall: float) -> DataFrame:
    """``label, dim, passes`` of the labels that need more than ``passes``, by the
    chances of a pass counted over their rows: the least number, in steps of a quarter,
    that leaves out no more than the recall allows, ``MOST_PASSES`` at most."""
    steps = [passes]
    while steps[-1] < MOST_PASSES:
        steps.append(min(MOST_PASSES, steps[-1] + max(1, steps[-1] // 4)))
    counted = measured.groupBy("label", "dim", "bin").agg(F.sum("n").alias("n"))
    missed = F.col("n") * F.pow(1 - F.pow(F.lit(2.0), -F.col("bin") / BIN), F.col("step"))
    fit = counted.select("*", F.explode(F.array(*map(F.lit, steps))).alias("step")).groupBy("label", "dim", "step").agg((F.sum(missed) <= (1 - recall) * F.sum("n")).alias("ok"))
    need = fit.groupBy("label", "dim").agg(F.coalesce(F.min(F.expr("if(ok, step, null)")), F.max("step")).cast("int").alias("passes"))
    return need.filter(F.col("passes") > passes)


def _unit(ids, vectors):
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return ids, scaled, scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _compare(one, two, same: bool, threshold: float):
    """Links between two blocks, or inside one."""
    s = one[2] @ two[2].T >= threshold - 1e-9
    if same:
        s = np.triu(s, 1)
    i, j = np.nonzero(s)
    x, y = one[1][i], two[1][j]
    cos = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
    ok = cos >= threshold
    return one[0][i[ok]], two[0][j[ok]]


def _neighbours(threshold: float, block: int, bits: int):
    """Of rows sorted by pass, label, dim and code: links between neighbours in a
    partition, and a row for each block with its ids. ``open`` blocks linked back to
    the partition's first block of their group, so more may follow before it; others
    hold the chances of their rows (:func:`_more_passes`)."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("pass", pa.int32()), ("label", pa.string()), ("dim", pa.int32()), ("part", pa.int32()), ("seq", pa.int64()), ("ids", pa.list_(pa.int64())), ("open", pa.bool_()), ("bins", pa.list_(pa.int32()))])
    apart = math.sqrt(max(0.0, 2 - 2 * threshold))

    def bins(code, radius, start):
        """Of the chance of each row that a pass compares it with a vector at the
        threshold before it: they share all bits that its window shares."""
        angle = 2 * np.arcsin(np.minimum(1, apart / 2 / np.maximum(radius, 1e-300)))
        same = np.maximum(1 - angle / math.pi, 0.5)
        needed = bits - np.frexp((code ^ start).astype(np.float64))[1] + 1
        return np.ceil(-np.log2(same) * np.clip(needed, 1, bits) * BIN).astype(np.int32)

    def links(a, b):
        none = [pa.nulls(len(a), f.type) for f in list(schema)[2:]]
        return record(schema, np.minimum(a, b), np.maximum(a, b), *none)

    def run(batches):
        group, held, part, seq = None, [], None, 0  # held: numbered blocks of the group that may still link

        def flush(ids, vectors, code, radius):
            nonlocal held, seq
            new = _unit(ids, vectors)
            found = [_compare(new, new, True, threshold)]
            keep, first = [], seq == 0
            for n, start, old in reversed(held):
                keep.append((n, start, old))
                found.append(_compare(new, old, False, threshold))
                if not len(found[-1][0]):
                    break
                first = n == 0
            held = [*reversed(keep), (seq, code[0], new)]
            yield links(*(np.concatenate(x) for x in zip(*found, strict=True)))
            yield record(schema, *[pa.nulls(1, pa.int64())] * 2, *[[x] for x in group], [part], [seq], [ids.tolist()], [first], [None if first else bins(code, radius, held[0][1]).tolist()])
            seq += 1

        waiting: list[tuple] = []

        def rest():
            nonlocal waiting
            if waiting:
                yield from flush(*(np.array(x) for x in zip(*waiting, strict=True)))
                waiting = []

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            flat, offsets = _lists(batch.column("vector"))
            ids, codes, radius = (batch.column(c).to_numpy() for c in ("class", "code", "radius"))
            keys = list(zip(batch.column("pass").to_pylist(), batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True))
            for i, key in enumerate(keys):
                if key != group or len(waiting) == block:
                    yield from rest()
                    if key != group:
                        group, held, seq = key, [], 0
                waiting.append((ids[i], flat[offsets[i] : offsets[i + 1]], codes[i], radius[i]))
        yield from rest()

    return run


def _between(threshold: float):
    """Links between the two blocks of each row, and its place if it has any."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("pass", pa.int32()), ("label", pa.string()), ("dim", pa.int32()), ("no", pa.int64())])

    def side(batch, i, c, dim):
        ids = batch.column(f"{c}_ids").slice(i, 1).flatten().to_numpy()
        flat, _ = _lists(batch.column(f"{c}_vectors").slice(i, 1))
        return _unit(ids, flat.reshape(-1, dim))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                a, b = _compare(side(batch, i, "x", dim), side(batch, i, "y", dim), False, threshold)
                if len(a):
                    yield record(schema, np.minimum(a, b), np.maximum(a, b), *[pa.nulls(len(a), f.type) for f in list(schema)[2:]])
                    yield record(schema, *[pa.nulls(1, pa.int64())] * 2, *[batch.column(c).slice(i, 1) for c in ("pass", "label", "dim", "no")])

    return run


def _across(blocks: DataFrame, classes: DataFrame, threshold: float) -> list[DataFrame]:
    """Links over the borders of the partitions. Each open block is compared with
    the last block before its partition; one that links goes on with the two blocks
    before that, then four, as Spark rounds until none links."""
    key = ["pass", "label", "dim"]
    runs = blocks.groupBy(*key, "part").count()
    before = F.sum("count").over(Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(*key, "part", F.coalesce(before, F.lit(0)).alias("first"))
    placed = written(blocks.join(runs, [*key, "part"]).select(*key, "ids", "open", "first", (F.col("first") + F.col("seq")).alias("no")))
    left, width, out = placed.filter("open").select(*key, "no", (F.col("first") - 1).alias("last")).filter("last >= 0"), 1, []
    while True:
        left = written(left)
        if left.isEmpty():
            return out
        pairs = left.select(*key, "no", F.explode(F.sequence(F.greatest(F.col("last") - (width - 1), F.lit(0)), F.col("last"))).alias("other"))
        used = pairs.select(*key, "no").union(pairs.select(*key, "other")).distinct()
        members = placed.select(*key, "no", F.explode("ids").alias("class")).join(used, [*key, "no"], "left_semi").join(classes.select("class", "vector"), "class")
        whole = written(members.groupBy(*key, "no").agg(F.collect_list(F.struct("class", "vector")).alias("rows")).select(*key, "no", F.col("rows.class").alias("ids"), F.flatten("rows.vector").alias("vectors")))
        x = whole.withColumnsRenamed({"ids": "x_ids", "vectors": "x_vectors"})
        y = whole.withColumnsRenamed({"no": "other", "ids": "y_ids", "vectors": "y_vectors"})
        met = pairs.join(x, [*key, "no"]).join(y, [*key, "other"]).select(*key, "no", "x_ids", "x_vectors", "y_ids", "y_vectors")
        found = written(met.mapInArrow(_between(threshold), "a long, b long, pass int, label string, dim int, no long"))
        out.append(found.filter("a is not null").select("a", "b"))
        left = left.join(found.filter("a is null").select(*key, "no").distinct(), [*key, "no"], "left_semi").withColumn("last", F.col("last") - width).filter("last >= 0")
        width *= 2


def near_duplicates(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", label: str | None = "label", threshold: float = 0.98, recall: float = RECALL, block: int = BLOCK, bits: int = BITS, seed: int = 7) -> DataFrame:
    """Link vectors of equal label with cosine of at least ``threshold`` and
    group them.

    Returns one row per id: ``id``, ``n_links`` (other vectors linked directly),
    ``component_id`` (least id reachable by links, itself included) and ``kept``
    (whether it is that id). Every link is verified in double precision; the
    passes find a pair at the threshold with a probability of ``recall`` or more.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors whose label is null, link with nothing and are kept. Vectors of
    different length don't link. A row without id is left out; rows that repeat an
    id count once (the smallest row). Other columns are ignored. An empty table
    gives an empty result. With ``label=None`` all vectors are compared.
    """
    tag = F.lit("") if label is None else F.col(label).cast("string")
    rows = vectors.select(F.col(id).cast("long").alias("vec"), F.struct(tag.alias("label"), F.col(vector).cast("array<double>").alias("vector")).alias("row"))
    rows = one_row_per_id(rows, "vec", "row").select("vec", "row.label", "row.vector")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    rows = rows.withColumns({"k1": F.when(F.col("usable"), F.xxhash64("label", "vector")), "k2": F.when(F.col("usable"), F.xxhash64(F.lit(1), "vector", "label"))})
    classes = written(
        rows.filter("usable").groupBy("k1", "k2").agg(F.min("vec").alias("class"), F.count("*").alias("copies"), F.first("label").alias("label"), F.first("vector").alias("vector"))
    )
    passes = passes_for(classes.count(), threshold, recall, block)
    centers = written(_centers(classes))
    whole = classes.select("class", "label", "vector", F.size("vector").alias("dim")).join(centers, ["label", "dim"])
    order = ["pass", "label", "dim", "code", "class"]

    def links_of(rows):
        codes = rows.select("class", "label", "vector", "center", "since", "passes").mapInArrow(_code_rows(bits, seed), "pass int, code long, dim int, radius float, label string, class long, vector array<double>")
        found = written(
            codes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
            .mapInArrow(_neighbours(threshold, block, bits), "a long, b long, pass int, label string, dim int, part int, seq long, ids array<long>, open boolean, bins array<int>")
        )
        blocks = found.filter("a is null").drop("a", "b")
        measured = blocks.select("label", "dim", F.explode("bins").alias("bin")).groupBy("label", "dim", "bin").agg(F.count("*").alias("n"))
        out = found.filter("a is not null").select("a", "b")
        for more in _across(blocks.drop("bins"), classes, threshold):
            out = out.union(more)
        return out, measured

    pairs, measured = links_of(whole.withColumns({"since": F.lit(0), "passes": F.lit(passes)}))
    more = written(_more_passes(measured, passes, recall))
    if not more.isEmpty():
        pairs = pairs.union(links_of(whole.join(more, ["label", "dim"]).withColumn("since", F.lit(passes)))[0])
    links = written(pairs.distinct())
    groups = components(links)
    copies = classes.select(F.col("class").alias("b"), "copies")
    ways = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = ways.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("others"))
    table = (
        classes.select("k1", "k2", "class", "copies")
        .join(counts.withColumnRenamed("a", "class"), "class", "left")
        .join(groups.withColumnRenamed("node", "class"), "class", "left")
        .select("k1", "k2", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "class").alias("component_id"))
    )
    return (
        rows.select("vec", "k1", "k2").join(table, ["k1", "k2"], "left")
        .select(F.col("vec").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec").alias("component_id"))
        .withColumn("kept", F.col(id) == F.col("component_id"))
    )


def op10_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings of equal label at cosine 0.98."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
