import datetime as dt
import os

import pytest

from conftest import final_plan
from pyspark.sql import functions as F

from snaptally.operators import dataset_stats, merge_stats, parse_records
from snaptally.sinks import (
    dataset_report,
    format_stat,
    read_stats,
    run_dir,
    run_stamp,
    tee,
    write_by_initial,
    write_parquet,
    write_report,
    write_stats,
)
from snaptally.sources import read_json, read_parquet, scan_lines


def test_run_stamp_and_dir():
    t = dt.datetime(2015, 5, 1, 7, 8, 9, 123456, tzinfo=dt.timezone.utc)
    assert run_stamp(t) == "2015-05-01T07-08-09-123"
    assert run_dir("s3://b/out/", "table-stats", "X") == "s3://b/out/table-stats-X"


def test_write_stats_roundtrip_and_no_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("t", 3, 66), ("u", 1, 2)], "tableName string, recordCount long, tableSize long")
    path = write_stats(df, str(tmp_path), program="p", stamp="S")
    assert path.endswith("/p-S/stats")
    assert sorted(tuple(r) for r in read_stats(spark, path).collect()) == [("t", 3, 66), ("u", 1, 2)]
    with pytest.raises(Exception):
        write_stats(df, str(tmp_path), program="p", stamp="S")


def test_null_fields_left_out(spark, tmp_path):
    df = spark.createDataFrame([("t", None, 1)], "tableName string, recordCount long, tableSize long")
    path = write_stats(df, str(tmp_path), stamp="A")
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert "recordCount" not in text
    path = write_stats(df, str(tmp_path), stamp="B", keep_nulls=True)
    text = "".join(r.value for r in spark.read.text(path).collect())
    assert '"recordCount":null' in text


def test_reports(spark, tmp_path):
    df = spark.createDataFrame([("x",), ("yy",)], "value string")
    out = write_report(dataset_report(dataset_stats(df), "in/path"), str(tmp_path / "r1"))
    assert [r.value for r in spark.read.text(out).collect()] == [
        "processing input file : in/path",
        "total data set line recordCount : 2",
        "total data set byte size : 3",
    ]
    st = spark.createDataFrame([("b1", 2, 3)], "path string, recordCount long, tableSize long")
    assert format_stat(st).first().value == "Stat{emoTable=b1, recordCount=2, tableSize=3}"


def test_by_initial_keeps_every_table(spark, tmp_path):
    names = ["apple", "avocado", "zeta", "Zed", "9lives", "_x", "", "émile"]
    df = spark.createDataFrame([(n, 1, 1) for n in names], "tableName string, recordCount long, tableSize long")
    out = write_by_initial(df, str(tmp_path / "init"))
    back = read_stats(spark, out)
    got = {r.tableName: r.initial for r in back.collect()}
    assert got == {"apple": "a", "avocado": "a", "zeta": "z", "Zed": "other", "9lives": "other",
                   "_x": "other", "": "other", "émile": "other"}
    assert sorted(d for d in os.listdir(out) if d.startswith("initial=")) == ["initial=a", "initial=other", "initial=z"]


def test_merge_stats_defaults(spark):
    c = spark.createDataFrame([("a", 1), ("b", 2)], "tableName string, recordCount long")
    s = spark.createDataFrame([("b", 20), ("c", 30)], "tableName string, tableSize long")
    got = sorted(tuple(r) for r in merge_stats(c, s).collect())
    assert got == [("a", 1, -1), ("b", 2, 20), ("c", -1, 30)]


def test_tee_writes_and_continues_from_copy(spark, tmp_path):
    df = spark.createDataFrame([('{"~table":"t"}',), ("bad",)], "value string")
    rec = tee(parse_records(df), "records", str(tmp_path / "run"))
    assert os.path.isdir(tmp_path / "run" / "records")
    assert sorted((r.tableName, r.is_valid) for r in rec.collect()) == [("t", True), ("unknown", False)]
    plan = final_plan(rec)
    assert "Scan parquet" in plan or "FileScan parquet" in plan
    same = tee(df, "x", str(tmp_path / "off"), enabled=False)
    assert same is df and not os.path.exists(tmp_path / "off")


def test_json_to_parquet(spark, tmp_path):
    src = tmp_path / "j"
    src.mkdir()
    (src / "p.json").write_text('{"a":1,"b":{"c":"x"}}\n{"a":2,"d":[1,2]}\nnot json\n')
    df = read_json(spark, str(src))
    assert sorted(df.columns) == ["a", "b", "d"]
    out = write_parquet(df, str(tmp_path / "pq"))
    back = read_parquet(spark, out)
    assert sorted(r.a for r in back.collect()) == [1, 2]
    with pytest.raises(Exception):
        write_parquet(df, out)


def test_json_colliding_names_raise(spark, tmp_path):
    src = tmp_path / "case"
    src.mkdir()
    (src / "p.json").write_text('{"a":1,"A":2}\n')
    with pytest.raises(ValueError):
        read_json(spark, str(src))


def test_json_duplicate_keys_filtered_first(spark, tmp_path):
    src = tmp_path / "dup"
    src.mkdir()
    (src / "p.json").write_text('{"a":1,"a":2}\n{"a":3}\n')
    (src / "q.json").write_text('{"b":1} x\n{"a":2,"b":\nnot json\n')
    # the duplicate-key line and the damaged ones add neither rows nor columns
    assert read_json(spark, str(src)).collect() == [(3,)]
    assert read_json(spark, str(src), schema="a long, b long").collect() == [(3, None)]
    (src / "q.json").unlink()
    # the record check rejects the duplicate-key line, so only good lines go on
    good = parse_records(scan_lines(spark, str(src))).where(F.col("is_valid"))
    assert [r.value for r in good.collect()] == ['{"a":3}']


def test_merge_stats_matches_dict_merge(spark):
    import random

    rnd = random.Random(9)
    counts = {f"t{i}": rnd.randrange(1, 100) for i in rnd.sample(range(60), 35)}
    sizes = {f"t{i}": rnd.randrange(0, 10**9) for i in rnd.sample(range(60), 35)}
    c = spark.createDataFrame(list(counts.items()), "tableName string, recordCount long")
    s = spark.createDataFrame(list(sizes.items()), "tableName string, tableSize long")
    got = {r.tableName: (r.recordCount, r.tableSize) for r in merge_stats(c, s).collect()}
    want = {k: (counts.get(k, -1), sizes.get(k, -1)) for k in set(counts) | set(sizes)}
    assert got == want


def test_json_all_lines_bad(spark, tmp_path):
    src = tmp_path / "bad"
    src.mkdir()
    (src / "p.json").write_text("not json\n{cut\n")
    df = read_json(spark, str(src))
    assert df.columns == [] and df.count() == 0


def test_table_checksums_are_free_of_order_and_mergeable(spark, tmp_path):
    from pyspark.sql import functions as F

    from snaptally.operators import changed_tables, merge_checksums, parse_records, table_checksum

    lines = [f'{{"~table":"t{i % 3}","i":{i}}}' for i in range(300)] + ["bad", "bad", '{"~table":"t0","i":0}']
    df = parse_records(spark.createDataFrame([(x,) for x in lines], "value string"), keep_record=False, checksum=True)
    one = {r.tableName: tuple(r) for r in table_checksum(df.repartition(7)).collect()}
    assert one == {r.tableName: tuple(r) for r in table_checksum(df.orderBy(F.desc("value"))).collect()}
    import hashlib

    sums, xors = [0] * 4, [0] * 4
    for x in (x for x in lines if '"t0"' in x):
        h = hashlib.sha256(x.encode()).hexdigest()
        for k in range(4):
            v = int(h[15 * k : 15 * k + 15], 16)
            sums[k], xors[k] = (sums[k] + v) % 2**60, xors[k] ^ v
    assert one["t0"] == ("t0", 101, "".join(f"{x:015x}" for x in sums), "".join(f"{x:015x}" for x in xors))
    halves = table_checksum(df.where("hash(value) % 2 = 0")).unionByName(table_checksum(df.where("hash(value) % 2 <> 0")))
    assert {r.tableName: tuple(r) for r in merge_checksums(halves).collect()} == one
    other = parse_records(spark.createDataFrame([(x.replace("299", "298"),) for x in lines if "bad" not in x] + [('{"~table":"new"}',)], "value string"), checksum=True)
    assert {tuple(r) for r in changed_tables(table_checksum(df), table_checksum(other)).collect()} == {("t2", "changed"), ("unknown", "removed"), ("new", "added")}
    assert table_checksum(df.limit(0)).collect() == []
    import pytest

    with pytest.raises(ValueError):
        table_checksum(df.drop("~checksum"))


def test_records_to_parquet_keeps_checksums(spark, tmp_path):
    import hashlib

    from snaptally.plans.jobs import records_to_parquet_job, table_checksum_job

    lines = ['{"a":1}', "bad", '{"a":2,"~checksum":"mine"}']
    (tmp_path / "in").write_text("\n".join(lines) + "\n")
    out = records_to_parquet_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), checksum=True)
    got = {r.a: r["~checksum"] for r in spark.read.parquet(out).collect()}
    assert got == {i: hashlib.sha256(lines[k].encode()).hexdigest() for i, k in ((1, 0), (2, 2))}
    sums = spark.read.json(table_checksum_job(spark, str(tmp_path / "in"), str(tmp_path / "sums"))).collect()
    assert [(r.tableName, r.recordCount, len(r.checksumSum)) for r in sums] == [("unknown", 3, 60)]


def test_stage_counts_need_no_pass_of_their_own(spark, tmp_path):
    from snaptally.plans.jobs import table_stats_job

    (tmp_path / "in").write_text('{"~table":"t"}\nbad\n\n{"b":2}\n')
    out = table_stats_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), counts=True)
    got = {(r.stage, r.metric): r.value for r in spark.read.json(out.replace("/stats", "/stage-counts")).collect()}
    assert got == {("lines", "rows"): 4, ("lines", "size"): 24, ("records", "rows"): 4, ("records", "valid"): 2, ("records", "size"): 21}
    assert {r.tableName: r.recordCount for r in spark.read.json(out).collect()} == {"t": 1, "unknown": 3}


def test_json_table_is_parsed_once(spark, tmp_path, monkeypatch):
    """Types as Spark infers them, from good lines alone, in one parse and one text scan."""
    import snaptally.operators.records as records
    from snaptally.sources import read_json

    lines = ['{"a":1,"b":{"c":1.5,"d":null},"e":[1,2.5],"s p":1,"x`y":2,"q.r":3}', '{"a":2,"b":{"c":1},"f":{},"g":[],"h":12345678901234567890}',
             '{"a":9.25,"i":1e3,"j":[{"k":1},{"k":null,"l":true}],"m":"2020-01-01"}', '{"n":{"o":{}},"p":[[1],[]],"q":[null],"A1":1}', "bad", '{"zz":1,"zz":2}', "[1]"]
    mixed = ['{"a":1,"b":[1]}', '{"a":"x","b":["y"]}', '{"a":{"z":1,"c":1.50}}']
    calls = []
    real = records.parse_records
    monkeypatch.setattr(records, "parse_records", lambda *a, **k: calls.append(1) or real(*a, **k))
    for name, text, parses in (("plain", lines, 1), ("mixed", mixed, 2)):
        (tmp_path / name).write_text("\n".join(text) + "\n")
        good = [x for x in text if x.startswith("{") and "zz" not in x]
        (tmp_path / f"{name}-good").write_text("\n".join(good) + "\n")
        calls.clear()
        got, want = read_json(spark, str(tmp_path / name)), spark.read.json(str(tmp_path / f"{name}-good"))
        assert got.schema == want.schema
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert len(calls) == parses and ("FileScan json" in plan) == (parses == 2) and "FileScan text" not in plan
