import os

import pytest
from pyspark.errors import PySparkException

from conftest import INPUT1_LINES, final_plan, write_file
from snaptally.operators import (
    dataset_stats,
    file_stats,
    path_stats,
    snapshot_table_counts,
)
from snaptally.operators.words import contains_counts
from snaptally.sources import (
    latest_snapshot,
    list_files,
    list_tables,
    resolve_latest,
    scan_lines,
    scan_whole,
)


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    """FIXTURES §4 directory tree."""
    base = str(tmp_path_factory.mktemp("tree"))
    root = f"{base}/root"
    write_file(f"{root}/2015/t1/p0", b"a\rb\r\nc\n")
    write_file(f"{root}/2015/t1/p1", b"x\n")
    write_file(f"{root}/2015/t2/p0", b"")
    write_file(f"{root}/2015/t2/p1", b"\n\n")
    write_file(f"{root}/2015/top", b"top\n")
    write_file(f"{root}/_LATEST", b"2015\n")
    write_file(f"{base}/enc/a b%c/p", b"z\n")
    snaps = f"{base}/snaps"
    write_file(f"{snaps}/2015-04-28-00-00-00/answer-a/p.json", '{"~table":"answer-a"}\n')
    write_file(f"{snaps}/2015-04-29-00-00-00/answer-b/p.json", '{"~table":"answer-b"}\n{"x":1}\n')
    write_file(f"{snaps}/2015-04-29-00-00-00/answer-c/p0.json", "1\n2\n3\n")
    write_file(f"{snaps}/2015-04-29-00-00-00/answer-c/p1.json", "4\n")
    write_file(f"{snaps}/2015-04-29-00-00-00/answer-d/p.json", b"")  # table without lines
    write_file(f"{snaps}/2015-04-29-00-00-00/_temporary/x", b"hidden\n")
    write_file(f"{snaps}/2015-04-30-00-00-00/answer-e/p.json", b"")  # newer, but no data yet
    write_file(f"{snaps}/_LATEST", b"2015-04-28-00-00-00\n")
    return base


def _values(df):
    return sorted(r.value for r in df.collect())


def test_input1_line_stats(spark, tmp_path):
    p = write_file(str(tmp_path / "input1.txt"), "\n".join(INPUT1_LINES) + "\n")
    lines = scan_lines(spark, p)
    r = dataset_stats(lines).first()
    assert (r.recordCount, r.tableSize) == (17, 74)
    c = contains_counts(lines, ("a", "b")).first()
    assert (c.lines_with_a, c.lines_with_b) == (7, 5)


def test_empty_dataset_stats_is_zero(spark, tmp_path):
    p = write_file(str(tmp_path / "e" / "empty.txt"), b"")
    r = dataset_stats(scan_lines(spark, str(tmp_path / "e"))).first()
    assert (r.recordCount, r.tableSize) == (0, 0)


def test_line_breaks_and_globs(spark, tree):
    root = f"{tree}/root"
    assert _values(scan_lines(spark, f"{root}/2015/*/*")) == ["", "", "a", "b", "c", "x"]
    assert _values(scan_lines(spark, f"{root}/2015/*")) == ["", "", "a", "b", "c", "top", "x"]
    assert _values(scan_lines(spark, f"{root}/2015")) == ["top"]
    # with a \n separator a \r stays inside the line
    assert _values(scan_lines(spark, f"{root}/2015/t1/p0", line_sep="\n")) == ["a\rb\r", "c"]
    assert _values(scan_lines(spark, root, recursive=True)) == ["", "", "a", "b", "c", "top", "x"]


def test_no_files_raises(spark, tree):
    with pytest.raises(FileNotFoundError):
        scan_lines(spark, f"{tree}/root")  # only sub-directories and a hidden file
    with pytest.raises(FileNotFoundError):
        scan_lines(spark, f"{tree}/root/_LATEST")  # hidden: would read as no rows
    with pytest.raises(Exception):
        scan_lines(spark, f"{tree}/does-not-exist")


def test_file_stats_lines_and_whole(spark, tree):
    root = f"{tree}/root/2015"
    def key(uri):
        return os.path.basename(os.path.dirname(uri)) + "/" + os.path.basename(uri)

    lines = {key(r.fileURI): (r.recordCount, r.fileSize) for r in file_stats(spark, f"{root}/*/*").collect()}
    # zero-byte t2/p0 has no line; \r stays in its record; sizes include breaks
    assert lines == {"t1/p0": (2, 7), "t1/p1": (1, 2), "t2/p1": (2, 2)}
    whole = {key(r.fileURI): (r.recordCount, r.fileSize) for r in file_stats(spark, f"{root}/*/*", whole=True).collect()}
    # JVM split drops trailing empty records: "\n\n" has none
    assert whole == {"t1/p0": (2, 7), "t1/p1": (1, 2), "t2/p1": (0, 2)}
    for mode in (False, True):
        sizes = sorted(r.fileBytes for r in file_stats(spark, f"{root}/*/*", whole=mode).collect())
        assert sizes == [2, 2, 7]  # exact bytes, from the scan's own metadata


def test_scan_whole(spark, tree):
    rows = scan_whole(spark, f"{tree}/root/2015/t1").collect()
    assert sorted(r.value for r in rows) == ["a\rb\r\nc\n", "x\n"]


def test_path_stats_one_scan(spark, tree):
    root = f"{tree}/root/2015"
    df = path_stats(spark, [f"{root}/t1", f"{root}/t2"])
    got = {os.path.basename(r.path): (r.recordCount, r.tableSize) for r in df.collect()}
    assert got == {"t1": (4, 4), "t2": (2, 0)}
    # a given directory without any line still gets its row
    os.makedirs(f"{root}/t3", exist_ok=True)
    write_file(f"{root}/t3/empty", b"")
    got = {os.path.basename(r.path): r.recordCount
           for r in path_stats(spark, [f"{root}/t1", f"{root}/t3"]).collect()}
    assert got == {"t1": 4, "t3": 0}
    # every given path has its own row, named as given; lines that several cover are read once
    given = [f"{root}/t1", f"{root}/t1/p0", f"{root}/t1", f"{root}/t[12]", f"{root}/t1/p1", f"{root}/t2/"]
    rows = path_stats(spark, given).collect()
    assert {r.path: (r.recordCount, r.tableSize) for r in rows} == {
        given[0]: (4, 4), given[1]: (3, 3), given[3]: (6, 4), given[4]: (1, 1), given[5]: (2, 0)}
    assert len(rows) == 5
    # one scan node for all paths
    plan = final_plan(df)
    assert plan.count("FileScan text") == 1


def test_percent_encoded_paths(spark, tree):
    listed = {os.path.dirname(r.path) for r in list_files(spark, f"{tree}/enc/*").collect()}
    assert [os.path.basename(p) for p in listed] == ["a b%c"]
    got = {r.path: r.recordCount for r in path_stats(spark, [f"{tree}/enc/a b%c", *listed, f"{tree}/enc/*"]).collect()}
    assert got == {p: 1 for p in [f"{tree}/enc/a b%c", *listed, f"{tree}/enc/*"]}


def test_list_files_prunes_content(spark, tree):
    df = list_files(spark, f"{tree}/root/2015/*/*")
    assert df.columns == ["path", "length", "modificationTime"]
    assert sorted(r.length for r in df.collect()) == [2, 2, 7]  # zero-byte file unseen
    assert "content" not in final_plan(df).split("ReadSchema")[1]


def test_latest_and_tables(spark, tree):
    snaps = f"{tree}/snaps"
    # the pointer names the last finished one; without it the greatest stamp with data
    assert latest_snapshot(spark, snaps).first().snapshot == "2015-04-28-00-00-00"
    assert resolve_latest(spark, snaps, pointer=None) == "2015-04-29-00-00-00"
    os.makedirs(f"{snaps}/zz-tmp", exist_ok=True)
    write_file(f"{snaps}/zz-tmp/t/p", "x\n")
    assert latest_snapshot(spark, snaps, pointer=None).first().snapshot == "2015-04-29-00-00-00"
    assert resolve_latest(spark, snaps, pointer=None, stamp_pattern=None) == "zz-tmp"
    t = [r.table for r in list_tables(spark, f"{snaps}/2015-04-29-00-00-00", limit=10).collect()]
    assert t == ["answer-b", "answer-c", "answer-d"]
    assert list_tables(spark, f"{snaps}/2015-04-29-00-00-00", limit=1).count() == 1
    assert list_tables(spark, f"{snaps}/2015-04-29-00-00-00", limit=0).count() == 0


def test_snapshot_table_counts(spark, tree):
    snaps = f"{tree}/snaps"
    got = {r.table: r.recordCount for r in snapshot_table_counts(spark, snaps).collect()}
    assert got == {"answer-a": 1}  # the snapshot that _LATEST names
    got = {r.table: r.recordCount for r in snapshot_table_counts(spark, snaps, pointer=None).collect()}
    assert got == {"answer-b": 2, "answer-c": 4, "answer-d": 0}
    got = {r.table: r.recordCount for r in snapshot_table_counts(spark, snaps, pointer=None, limit=1).collect()}
    assert got == {"answer-b": 2}
    got = {r.table: r.recordCount
           for r in snapshot_table_counts(spark, snaps, snapshot="2015-04-28-00-00-00").collect()}
    assert got == {"answer-a": 1}
    assert snapshot_table_counts(spark, snaps, limit=0).count() == 0


def test_snapshot_counts_of_nested_and_partitioned_tables(spark, tmp_path):
    snap = f"{tmp_path}/2015-01-01-00-00-00"
    for path, text in {"flat/p": "a\nb\n", "parts/dt=1/p": "a\n", "parts/dt=2/p": "b\nc\n", "deep/sub/er/p": "x\n", "both/p": "1\n", "both/s/p": "2\n", "none/p": ""}.items():
        write_file(f"{snap}/{path}", text)
    expected = {"flat": 2, "parts": 3, "deep": 1, "both": 2, "none": 0}
    assert {r.table: r.recordCount for r in snapshot_table_counts(spark, str(tmp_path)).collect()} == expected
    got = {r.table: r.recordCount for r in snapshot_table_counts(spark, str(tmp_path), limit=3).collect()}
    assert got == {"both": 2, "deep": 1, "flat": 2}


def test_many_tables_are_listed_quickly(spark, tmp_path):
    import time

    for i in range(3000):
        os.makedirs(f"{tmp_path}/t, {i:04d} x; isDirectory=false,")
    list_tables(spark, str(tmp_path), limit=1).count()
    start = time.time()
    assert list_tables(spark, str(tmp_path)).count() == 3000
    assert time.time() - start < 10


def test_scans_read_what_spark_reads(spark, tmp_path):
    write_file(f"{tmp_path}/t1/dt=1/p", "a\nb\n")
    write_file(f"{tmp_path}/t1/dt=2/p", "c\n")
    assert scan_lines(spark, f"{tmp_path}/t1").count() == 3
    assert [r.recordCount for r in path_stats(spark, [f"{tmp_path}/t1", f"{tmp_path}/t1/dt=2", f"{tmp_path}/t1/dt=2/p"]).orderBy("path").collect()] == [3, 1, 1]
    with pytest.raises(FileNotFoundError):
        list_files(spark, f"{tmp_path}")  # only sub-directories


def test_count_plan_single_exchange_per_level(spark, tree):
    df = snapshot_table_counts(spark, f"{tree}/snaps", pointer=None)
    plan = final_plan(df)
    assert plan.count("FileScan text") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # paths are decoded once per file, after the aggregate, never in a row filter
    assert "Filter" not in plan.split("FileScan text")[0].split("HashAggregate(keys=[file_path")[-1]
    assert "UrlCodec" not in plan.split("HashAggregate(keys=[file_path")[-1]


WHOLE = ["", "\n", "\n\n\n", "a", "a\n", "a\n\n", "\na", "\n\na\n\n", "a\n\n\nb\n\n\n", "\r\n\r\n", "é😀\n漢\n\n", " \n \n\n", "\ufeffa\nb\n", "\ufeff\n\n",
         "x" * 500 + "\n" * 700, "\n" * 700 + "y\n" + "\n" * 300, "ab\n" * 400, ("ab\n" * 100 + "\n" * 100) * 3, "\n" * 1000]


@pytest.mark.parametrize("unit", ["utf16", "chars", "bytes"])
@pytest.mark.parametrize("split", ["64", "1000", "128m"])
def test_whole_file_rules_on_split_files(spark, tmp_path, unit, split):
    """Files read by many tasks count as one value each by the JVM's split."""
    import gzip

    for i, text in enumerate(WHOLE):
        write_file(f"{tmp_path}/w/f{i:02d}.txt", text.encode())
        write_file(f"{tmp_path}/w/f{i:02d}.gz", gzip.compress(text.encode()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = file_stats(spark, f"{tmp_path}/w", unit=unit, whole=True)
        got = {os.path.basename(r.fileURI): (r.recordCount, r.fileSize) for r in df.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    want = {}
    for i, text in enumerate(WHOLE):
        records = text.split("\n")
        while len(records) > 1 and not records[-1]:
            records.pop()
        n = 0 if records == [""] and text else len(records)
        size = len(text.encode()) if unit == "bytes" else len(text) if unit == "chars" else len(text.encode("utf-16-be")) // 2
        want |= {f"f{i:02d}.{e}": (n, size) for e in ("txt", "gz") if text}
    for name in want:
        if name.endswith(".txt"):
            assert got[name] == want[name], (name, WHOLE[int(name[1:3])][:20])
    assert {k: v for k, v in got.items() if v[1]} == want


GLOBS = ["*", "a*", "?", "[ab]*", "[!a]*", "[^a]?", "{a,b}1", "{a1,b1/x=1}", "a1/*", "*/x=*", "{a{1,2},c[0-9]}", "*/x=1/p?", "a\\*1", "b1/{p0,x=[12]/p1}", "+.1"]


@pytest.mark.parametrize("recursive", [False, True])
def test_many_globs_one_scan(spark, tmp_path, recursive):
    """Each glob counts what a scan of it alone counts; all are read by one scan."""
    root = str(tmp_path / "g g")
    for i, name in enumerate(["a1/p0", "a1/p1", "a2/p0", "a*1/p0", "ab/p0", "b1/p0", "b1/x=1/p0", "b1/x=2/p1", "c1/p0", "c1/d/p0", "+.1/p0", "e", "_h/p0", "b1/_t/p0", "c1/.z/p"]):
        write_file(f"{root}/{name}", "line\n" * (2**i))
    globs = [f"{root}/{g}" for g in GLOBS] + [f"file:{root}/a*"]
    paths = [*globs, f"{root}/b1", f"{root}/a1/p0", root]
    df = path_stats(spark, paths, recursive=recursive)
    got = {r.path: (r.recordCount, r.tableSize) for r in df.collect()}
    assert list(got) and set(got) == set(paths)
    alone = 0
    for p in [*globs, root]:
        try:
            n = scan_lines(spark, p, recursive=recursive).count()
        except PySparkException as e:  # name=value directories beside others: no scan of its own can read it
            assert e.getCondition() == "CONFLICTING_DIRECTORY_STRUCTURES" and not recursive
        else:
            alone += 1
            assert got[p] == (n, 4 * n), p
    assert alone >= 8
    assert got[f"{root}/*"][0] == (8191 if recursive else 8191 - 2**9)
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == 1 and plan.count("Exchange hashpartitioning") <= 3
    with pytest.raises(FileNotFoundError):
        path_stats(spark, [f"{root}/a1", f"{root}/nothing*"])


def test_fifty_globs_have_one_scan_and_two_exchanges(spark, tmp_path):
    for i in range(50):
        write_file(str(tmp_path / "t" / f"table{i:02d}" / "p"), "x\n" * (i + 1))
    paths = [f"{tmp_path}/t/*{i:02d}/*" for i in range(50)]
    df = path_stats(spark, paths)
    assert {r.path: r.recordCount for r in df.collect()} == {p: i + 1 for i, p in enumerate(paths)}
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan text") == 1 and plan.count("Exchange hashpartitioning") == 2


def test_table_names_with_glob_characters(spark, tmp_path):
    root = str(tmp_path / "g")
    write_file(f"{root}/2015-01-01-00-00-00/t[1]/p", "a\nb\n")
    write_file(f"{root}/2015-01-01-00-00-00/t1/p", "c\n")
    write_file(f"{root}/2015-01-01-00-00-00/a{{b}}/p", "d\n")
    got = {r.table: r.recordCount for r in snapshot_table_counts(spark, root).collect()}
    assert got == {"t[1]": 2, "t1": 1, "a{b}": 1}


def test_glob_inputs_checked_without_second_expansion(spark, tree):
    # snapshot directories hold only table directories: no file matched
    with pytest.raises(FileNotFoundError):
        scan_lines(spark, f"{tree}/snaps/2015-04-2*")
    # a glob matching only an empty file: files exist, zero lines, no error
    assert scan_lines(spark, f"{tree}/root/2015/t2/p0*").count() == 0
    assert scan_lines(spark, f"{tree}/root/2015/t*/p1").count() == 3


def test_listing_a_large_tree_takes_few_driver_calls(spark, tmp_path, monkeypatch):
    """Thousands of empty directories: Spark lists them; the gateway is asked a handful of times."""
    from snaptally.sources import listing

    for i in range(2000):
        os.makedirs(f"{tmp_path}/e/d{i % 20}/s{i}")
    calls = []
    client = type(spark.sparkContext._gateway._gateway_client)
    real = client.send_command
    monkeypatch.setattr(client, "send_command", lambda self, *a, **k: calls.append(1) or real(self, *a, **k))
    counts = []
    for path in ("e/d0/s0", "e/d0/s0", "e/d1", "e"):  # 1 directory (the first time loads classes), 101 and 2,021
        calls.clear()
        assert listing.has_input_files(spark, [f"{tmp_path}/{path}"], recursive=True) is False
        counts.append(len(calls))
    assert max(counts[2:]) <= counts[1] + 20
    write_file(f"{tmp_path}/e/d3/s3/p", b"")
    assert listing.has_input_files(spark, [f"{tmp_path}/e"], recursive=True) is True
    assert listing.has_input_files(spark, [f"{tmp_path}/e"]) is False
    assert listing.has_input_files(spark, [f"{tmp_path}/nothing"]) is False
    with pytest.raises(FileNotFoundError):
        scan_lines(spark, f"{tmp_path}/e/d4", recursive=True)


def test_fallbacks_without_file_system_gateway(spark, tree, monkeypatch):
    import snaptally.sources.listing as listing

    monkeypatch.setattr(listing, "_hadoop_fs", lambda spark, path: None)
    snaps = f"{tree}/snaps"
    # binaryFile listings: only directories holding a non-empty file are seen
    assert [r.table for r in list_tables(spark, f"{snaps}/2015-04-29-00-00-00").collect()] == ["answer-b", "answer-c"]
    assert resolve_latest(spark, snaps) == "2015-04-29-00-00-00"
    got = {r.table: r.recordCount for r in snapshot_table_counts(spark, snaps).collect()}
    assert got == {"answer-b": 2, "answer-c": 4}
    named = [f"{snaps}/2015-04-29-00-00-00/answer-b", f"file:{snaps}/2015-04-29-00-00-00/answer-c"]
    assert {r.path: r.recordCount for r in path_stats(spark, named).collect()} == {named[0]: 2, named[1]: 4}
    assert listing.has_input_files(spark, [f"{tree}/root/2015/t1"]) is True
    # the scan-based check takes over
    with pytest.raises(FileNotFoundError):
        scan_lines(spark, f"{tree}/root")
    assert scan_lines(spark, f"{tree}/root/2015/t1").count() == 4


def test_small_options(spark, tree, tmp_path):
    from snaptally.sinks import write_parquet
    from snaptally.sources import read_json

    rows = scan_lines(spark, f"{tree}/enc/*", with_path=True).collect()
    assert [(r.value, os.path.basename(os.path.dirname(r.file_path))) for r in rows] == [("z", "a b%c")]
    rec = {"/".join(r.fileURI.split("/")[-2:]): r.recordCount
           for r in file_stats(spark, f"{tree}/root/2015", recursive=True).collect()}
    assert rec == {"t1/p0": 2, "t1/p1": 1, "t2/p1": 2, "2015/top": 1}  # t2/p0 is empty: no row
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    out = write_parquet(df, str(tmp_path / "pq"), partition_by=["k"])
    assert sorted(d for d in os.listdir(out) if d.startswith("k=")) == ["k=a", "k=b"]
    j = tmp_path / "j"
    j.mkdir()
    (j / "p.json").write_text("".join('{"i":%d}\n' % i for i in range(50)))
    assert read_json(spark, str(j)).count() == 50
