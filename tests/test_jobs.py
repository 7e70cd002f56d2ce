import json
import os

from conftest import write_file
from snaptally.plans.jobs import (
    contains_counts_job,
    list_files_job,
    dataset_stats_job,
    file_stats_job,
    json_to_parquet_job,
    path_stats_job,
    records_to_parquet_job,
    snapshot_counts_job,
    table_stats_job,
    word_count_job,
)


def _json_lines(spark, path):
    return [json.loads(r.value) for r in spark.read.text(path).collect()]


def test_table_stats_job_with_debug(spark, tmp_path):
    src = str(tmp_path / "in")
    write_file(f"{src}/part-0", '{"~table":"t","a":1}\n{"a":1}\nbad\n')
    write_file(f"{src}/part-1", '{"~table":"u"}\n\n')
    out = str(tmp_path / "out")
    path = table_stats_job(spark, src, out, debug=True, stamp="S")
    got = {d["tableName"]: (d["recordCount"], d["tableSize"]) for d in _json_lines(spark, path)}
    assert got == {"t": (1, 20), "u": (1, 14), "unknown": (3, 7)}
    assert sorted(os.listdir(f"{out}/table-stats-S")) == ["lines", "records", "stats"]


def test_table_stats_job_by_initial(spark, tmp_path):
    src = write_file(str(tmp_path / "in" / "p"), '{"~table":"alpha"}\n{"~table":"Beta"}\n')
    path = table_stats_job(spark, src, str(tmp_path / "out"), by_initial=True, stamp="S")
    assert sorted(d for d in os.listdir(path) if d.startswith("initial=")) == ["initial=a", "initial=other"]


def test_other_jobs(spark, tmp_path):
    src = write_file(str(tmp_path / "d" / "t1" / "p"), "a b\nc\n")
    write_file(str(tmp_path / "d" / "t2" / "p"), "xx\n")
    out = str(tmp_path / "out")
    rep = dataset_stats_job(spark, str(tmp_path / "d" / "*"), out, stamp="A")
    assert [r.value for r in spark.read.text(rep).collect()][1:] == [
        "total data set line recordCount : 3", "total data set byte size : 6"]
    rep = path_stats_job(spark, [str(tmp_path / "d" / "t1"), str(tmp_path / "d" / "t2")], out, stamp="B")
    lines = sorted(r.value for r in spark.read.text(rep).collect())
    assert len(lines) == 2 and lines[0].endswith("t1, recordCount=2, tableSize=4}")
    fs = _json_lines(spark, file_stats_job(spark, str(tmp_path / "d" / "*" / "*"), out, stamp="C"))
    assert sorted((d["recordCount"], d["fileSize"]) for d in fs) == [(1, 3), (2, 6)]
    wc = {d["word"]: d["count"] for d in _json_lines(spark, word_count_job(spark, src, out, stamp="D"))}
    assert wc == {"a": 1, "b": 1, "c": 1}
    assert src


def test_snapshot_and_parquet_jobs(spark, tmp_path):
    root = str(tmp_path / "dump")
    write_file(f"{root}/2015-01-01-00-00-00/a/p", '{"k":1}\n')
    write_file(f"{root}/2015-01-02-00-00-00/a/p", '{"k":1}\n{"k":2}\n')
    write_file(f"{root}/2015-01-02-00-00-00/b/p", '{"k":3}\n')
    out = str(tmp_path / "out")
    got = {d["table"]: d["recordCount"] for d in _json_lines(spark, snapshot_counts_job(spark, root, out, stamp="E"))}
    assert got == {"a": 2, "b": 1}
    pq = json_to_parquet_job(spark, f"{root}/2015-01-02-00-00-00/*/*", str(tmp_path / "pq"))
    assert sorted(r.k for r in spark.read.parquet(pq).collect()) == [1, 2, 3]


def test_records_to_parquet_job(spark, tmp_path):
    src = write_file(str(tmp_path / "in" / "p"), '{"k":1,"s":"a"}\n{"k":2,"k":3}\nbad\n{"k":4}\n')
    out = records_to_parquet_job(spark, src, str(tmp_path / "pq"))
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 4]


def test_table_stats_job_options(spark, tmp_path):
    src = write_file(str(tmp_path / "in" / "p"), "{'~table':'t','s':'\U0001F600'}\n{\"~table\":\"t\"}\n")
    strict = {d["tableName"]: (d["recordCount"], d["tableSize"])
              for d in _json_lines(spark, table_stats_job(spark, src, str(tmp_path / "o1"), stamp="A"))}
    assert strict == {"unknown": (1, 0), "t": (1, 14)}
    lenient = {d["tableName"]: (d["recordCount"], d["tableSize"])
               for d in _json_lines(spark, table_stats_job(spark, src, str(tmp_path / "o2"), lenient=True,
                                                           unit="bytes", stamp="B"))}
    assert lenient == {"t": (2, 14 + 25)}  # the emoji line is 25 UTF-8 bytes


def test_list_files_and_contains_jobs(spark, tmp_path):
    from conftest import INPUT1_LINES

    src = write_file(str(tmp_path / "in" / "input1.txt"), "\n".join(INPUT1_LINES) + "\n")
    out = str(tmp_path / "out")
    files = spark.read.parquet(list_files_job(spark, str(tmp_path / "in"), out, stamp="A")).collect()
    assert [r.length for r in files] == [os.path.getsize(src)]
    counts = _json_lines(spark, contains_counts_job(spark, src, out, stamp="B"))
    assert counts == [{"lines_with_a": 7, "lines_with_b": 5}]


def test_records_to_parquet_job_without_good_records(spark, tmp_path):
    import pytest

    src = write_file(str(tmp_path / "in" / "p"), "bad\n\n")
    with pytest.raises(ValueError):
        records_to_parquet_job(spark, src, str(tmp_path / "pq"))
