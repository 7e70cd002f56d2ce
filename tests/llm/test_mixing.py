"""The schedule's deviation, and that every row is placed once."""

from collections import Counter

import pytest

from snaptally.llm import mixing

from .conftest import DOCS


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 5, "b": 3, "c": 1}, {f"s{i}": 1 + i * i for i in range(30)}, {"a": 1000, "b": 0.001}])
def test_less_than_one_block_from_target(weights):
    slots = mixing.shares(weights, 512)
    assert sum(slots.values()) == 512 and min(slots.values()) >= 1
    had = Counter()
    plan = mixing.schedule(slots)
    assert [p[4] for p in plan] == list(range(512))
    for s, block, release, deadline, slot in plan:
        assert release <= slot < deadline
        assert block == had[s]
        had[s] += 1
        assert all(abs(had[x] - (slot + 1) * n / 512) < 1 for x, n in slots.items())


def test_rows_are_placed_once_and_in_order(spark, odd, none):
    rows = [(i, f"t{i}", "en", ["hot", "hot", "hot", "x", None][i % 5], i) for i in range(3000)] + [(7, "t7", "en", "hot", 7), (None, "n", "en", "x", 1)]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    got = mixing.interleave(df, {"hot": 2, "x": 1, "": 1}, block_rows=16, period=64, buckets=8).collect()
    assert Counter((r.doc_id, r.source) for r in got) == Counter((r[0], r[3]) for r in rows)
    assert len({(r.mix_slot, r.mix_row) for r in got}) == len(got)
    blocks = sorted({(r.mix_slot, r.source, r.mix_release, r.mix_deadline) for r in got}, key=lambda b: b[0])
    assert len({b[0] for b in blocks}) == len(blocks) and all(b[2] <= b[0] < b[3] for b in blocks)
    first = [b[1] for b in blocks if b[0] < 64]
    assert Counter(first)["hot"] == 32
    ordered = mixing.in_mix_order(df, {"hot": 2, "x": 1, "": 1}, block_rows=16, period=64, buckets=8)
    assert ordered.columns == df.columns
    place = {(r.doc_id, r.source): (r.mix_slot, r.mix_row) for r in got if r.doc_id != 7}
    parts = ordered.rdd.glom().collect()
    run = [place[(r.doc_id, r.source)] for p in parts for r in p if r.doc_id != 7]
    assert run == sorted(run)
    assert mixing.interleave(none).collect() == []
    wide = mixing.interleave(odd)
    assert wide.count() == odd.count() and wide.columns.count("mix_slot") == 1 and "mix_source" in wide.columns


def test_a_source_without_weight_is_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, source string")
    with pytest.raises(Exception, match="no weight for source"):
        mixing.interleave(df, {"a": 1}).collect()
    with pytest.raises(ValueError):
        mixing.shares({"a": 0})


@pytest.mark.parametrize("weights", [{"a": 1000, "b": 0.37}, {"a": 3**0.7, "b": 5**0.7, "c": 11**0.7}])
def test_target_is_held_over_many_periods(spark, weights):
    df = spark.range(6000).selectExpr("id as doc_id", "'a' as source")
    for s in list(weights)[1:]:
        df = df.union(spark.range(20_000, 26_000).selectExpr("id as doc_id", f"'{s}' as source"))
    got = mixing.interleave(df, weights, block_rows=4, period=64, buckets=16).select("source", "mix_block", "mix_slot").distinct().collect()
    total = sum(weights.values())
    assert len({r.mix_slot for r in got}) == len(got) == 1500 * len(weights)
    assert max(r.mix_slot for r in got) > 20 * 64
    for r in got:  # before and after each block
        w = weights[r.source] / total
        assert abs(r.mix_block - r.mix_slot * w) < 1 + 1e-6 and abs(r.mix_block + 1 - (r.mix_slot + 1) * w) < 1 + 1e-6
