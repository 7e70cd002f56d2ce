"""Near-duplicate vectors against all pairs."""

import math

import numpy as np

from snaptally.llm import projection_passes as passes


def direct(rows, threshold):
    ok = {}
    for i, v, label in rows:
        if i is None:
            continue
        good = label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        ok[i] = (label, np.array(v, dtype=np.float64)) if good else None
    root, n = {i: i for i in ok}, dict.fromkeys(ok, 0)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(i for i in ok if ok[i])
    for k, a in enumerate(ids):
        for b in ids[:k]:
            (la, va), (lb, vb) = ok[a], ok[b]
            if la == lb and len(va) == len(vb) and va @ vb / math.sqrt((va @ va) * (vb @ vb)) >= threshold:
                n[a] += 1
                n[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (n[i], find(i), find(i) == i) for i in ok}


def test_odd_vectors_and_recall(spark):
    rng = np.random.default_rng(1)
    rows = []
    for g in range(40):
        center = rng.standard_normal(16)
        for j in range(1 + g % 9):
            v = center + rng.standard_normal(16) * 0.03 * (j + 1) / 2
            rows.append((len(rows), [float(x) for x in np.float32(v)], g % 3))
    for _ in range(400):
        rows.append((len(rows), [float(x) for x in np.float32(rng.standard_normal(16))], 1))
    rows += [(len(rows) + i, rows[3][1], 0) for i in range(70)]  # more equal vectors than a block
    k = 10_000
    odd = [None, [], [0.0] * 16, [None] + [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e30] * 16, [1e-30] * 16]
    rows += [(k + i, v, 1) for i, v in enumerate(odd)]
    rows += [(k + 50, rows[0][1], None), (None, rows[0][1], 0)]
    df = spark.createDataFrame(rows + [rows[0]], "vec_id long, embedding array<float>, label int").repartition(4)
    df = df.selectExpr("*", "1 as class", "2 as code", "3 as k1")
    got = passes.near_duplicates(df).collect()
    expected = direct(rows, 0.98)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == expected and len(got) == len(expected)
    empty = df.limit(0)
    assert passes.near_duplicates(empty).collect() == []


def test_passes_grow_with_rows_and_recall():
    assert passes.passes_for(10**9, 0.98) > passes.passes_for(10**5, 0.98) >= 2
    assert passes.passes_for(10**5, 0.98, 0.99) < passes.passes_for(10**5, 0.98, 0.9999)
    once = (1 - math.acos(0.98) / math.pi) ** (math.log2(10**6 / passes.BLOCK) + 1)
    assert 1 - (1 - once) ** passes.passes_for(10**6, 0.98) >= passes.RECALL


def test_windows_cross_partition_borders(spark):
    rng = np.random.default_rng(5)
    center = rng.standard_normal(16)
    rows = [(i, [float(x) for x in center + rng.standard_normal(16) * 1e-6], 0) for i in range(900)]
    rows += [(2000 + i, [float(x) for x in rng.standard_normal(16)], i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "37")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = passes.near_duplicates(df, block=16).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == direct(rows, 0.98)


def test_links_in_a_dense_cone(spark):
    rng = np.random.default_rng(9)
    center = rng.standard_normal(32)
    center /= np.linalg.norm(center)
    away = rng.standard_normal((3000, 32))
    cone = center + 0.33 * away / np.linalg.norm(away, axis=1)[:, None]  # about cosine 0.9 to each other
    noise = rng.standard_normal((3000, 32))
    twins = cone + 0.19 * noise / np.linalg.norm(noise, axis=1)[:, None]  # about 0.98 to their own
    v = np.concatenate((cone, twins))
    u = v / np.linalg.norm(v, axis=1)[:, None]
    links = int((np.triu(u @ u.T, 1) >= 0.98).sum())
    df = spark.createDataFrame([(i, x, 1) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>, label int")
    found = sum(r.n_links for r in passes.near_duplicates(df).collect()) // 2
    print("links", found, "of", links)
    assert links > 1000 and found >= 0.999 * links
