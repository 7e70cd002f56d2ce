"""Plan shape checks: one scan, one exchange, no Python evaluation."""

import random

from pyspark.sql import functions as F

from snaptally.operators import parse_records, table_stats
from snaptally.sources import scan_lines


def _plan(df):
    df.collect()  # final adaptive plan; keep only its "Final Plan" part
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_table_stats_single_pass(spark, tmp_path):
    p = tmp_path / "lines"
    p.mkdir()
    (p / "a.json").write_text('{"~table":"t"}\n{"x":1}\nbad\n')
    plan = _plan(table_stats(parse_records(scan_lines(spark, str(p)))))
    assert plan.count("FileScan text") == 1
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan  # map-side combine before the shuffle
    assert "*(1)" in plan  # whole-stage code generation around scan and parse
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert python_node not in plan


def test_parse_runs_once_per_line(spark):
    df = spark.createDataFrame([('{"~table":"t"}',)], "value string")
    plan = table_stats(parse_records(df, keep_record=False))._jdf.queryExecution().optimizedPlan().toString()
    # each form of the line once; the parses of peeled lines stand behind a test of the length
    assert plan.count('concat({"w":, value#') == 1 and plan.count("concat([, value#") == 1
    assert plan.split("aggregate(")[0].count("octet_length(value#") >= 1


def test_seeded_mixture_totals(spark):
    rnd = random.Random(7)
    lines, valid_len = [], 0
    for i in range(3000):
        kind = rnd.randrange(4)
        if kind == 0:
            s = '{"~table":"t%d","n":%d}' % (rnd.randrange(5), i)
            valid_len += len(s)
        elif kind == 1:
            s = '{"n":%d,"s":"%s"}' % (i, "é" * rnd.randrange(4))
            valid_len += len(s)
        elif kind == 2:
            s = '{"~table":"t1","n":%d' % i  # cut
        else:
            s = rnd.choice(["", "null", "[1]", '{"a":1} x', '{"a":1}}'])
        lines.append((s,))
    df = spark.createDataFrame(lines, "value string")
    r = table_stats(parse_records(df)).agg(F.sum("recordCount").alias("n"), F.sum("tableSize").alias("s")).first()
    assert r.n == len(lines)
    assert r.s == valid_len


def test_hot_table_is_combined_before_the_shuffle(spark, tmp_path):
    # one table holds a third of all records; spread over several part files
    d = tmp_path / "skew"
    d.mkdir()
    n = 0
    for part in range(6):
        with open(d / f"part-{part}", "w") as f:
            for i in range(3000):
                t = "hot" if i % 3 == 0 else f"t{i % 50}"
                f.write('{"~table":"%s","i":%d}\n' % (t, i))
                n += 1
    stats = table_stats(parse_records(scan_lines(spark, str(d)), keep_record=False))
    rows = {r.tableName: r.recordCount for r in stats.collect()}
    assert rows["hot"] == n // 3 and sum(rows.values()) == n
    plan = _plan(stats)
    # the exchange carries per-task partial rows, not records
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
