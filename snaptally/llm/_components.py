"""Connected components of a link table, as Spark rounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._flat import record
from ._shared import written

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _contract(batches):
    """Links of a batch replaced by links to the least node that they reach."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
        nodes, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        x, y = at[: len(a)], at[len(a) :]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, root[x], low)
            np.minimum.at(root, root[y], low)
            root = root[root]
            if (root == before).all():
                break
        moved = root != np.arange(len(nodes))
        yield record(_EDGES, nodes[root[moved]], nodes[moved])


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of the links ``a, b``; the component is
    the least node reachable. Nodes without a link are not listed.

    Alternates two steps until nothing changes: every node sends its larger
    neighbours to its least one, then its smaller neighbours. Rounds grow with the
    logarithm of the longest path. Each round is written to the shared folder, so
    a lost executor repeats one round at most. A node with very many neighbours is
    a skewed join key whose other side is one row.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b")
    edges = written(ordered.mapInArrow(_contract, "a long, b long").distinct())
    state = None
    while True:
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(cast(xxhash64(b, a) as decimal(38, 0)))")).first()
        if now == state or not now[0]:
            break
        state = now
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("x"), F.col("m").alias("y"))
        low = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(low, "x").filter("y <> m").select(F.col("m").alias("a"), F.col("y").alias("b"))
        edges = written(small.union(low.select(F.col("m").alias("a"), F.col("x").alias("b"))).distinct())
    roots = edges.groupBy("a").agg(F.lit(1)).select(F.col("a").alias("node"), F.col("a").alias("component"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots)
