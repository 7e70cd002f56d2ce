from conftest import write_file
from snaptally.streaming import current_table_stats, start_table_stats


def _stats(spark, out):
    return {r.tableName: (r.recordCount, r.tableSize) for r in current_table_stats(spark, out).collect()}


def test_stream_accumulates_across_files(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    write_file(f"{src}/p0", '{"~table":"t"}\nbad\n')
    q = start_table_stats(spark, src, out, query_name="ts_a", checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    assert _stats(spark, out) == {"t": (1, 14), "unknown": (1, 0)}
    # a new part file arrives: only it is read
    write_file(f"{src}/p1", '{"~table":"t","a":1}\n')
    q = start_table_stats(spark, src, out, query_name="ts_b", checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    assert _stats(spark, out) == {"t": (2, 34), "unknown": (1, 0)}
    assert sum(p["numInputRows"] for p in q.recentProgress) == 1


def test_state_is_tables_by_batches_then_tables(spark, tmp_path):
    from snaptally.streaming import compact_table_stats
    from snaptally.streaming.table_stats_stream import _finished

    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    assert current_table_stats(spark, out).collect() == [] and compact_table_stats(spark, out) is None
    for i in range(3):
        write_file(f"{src}/p{i}", '{"~table":"t"}\n' * 500 + '{"~table":"u"}\nbad\n' * 200)
        q = start_table_stats(spark, src, out, query_name=f"ts_c{i}", checkpoint=ckpt, available_now=True)
        q.awaitTermination(120)

    def held():
        return spark.read.parquet(*_finished(spark, out)[0]).count()

    want = {"t": (1500, 21000), "u": (600, 8400), "unknown": (600, 0)}
    assert _stats(spark, out) == want and held() == 9  # not 2,700 lines
    folder = compact_table_stats(spark, out)
    assert _stats(spark, out) == want and held() == 3 and folder.endswith("upto-000000000002")
    assert compact_table_stats(spark, out) is None
    write_file(f"{src}/p9", '{"~table":"u"}\n')
    q = start_table_stats(spark, src, out, query_name="ts_c9", checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    assert _stats(spark, out) == want | {"u": (601, 8414)} and held() == 4
    # a batch written a second time, after a failure, replaces itself; an unfinished one isn't read
    spark.createDataFrame([("u", 1, 14)], "tableName string, recordCount bigint, tableSize bigint").write.mode("overwrite").parquet(f"{out}/batch-000000000003")
    write_file(f"{out}/batch-000000000004/part-0.parquet", b"cut")
    assert _stats(spark, out) == want | {"u": (601, 8414)}
    assert compact_table_stats(spark, out).endswith("upto-000000000003")
    assert _stats(spark, out) == want | {"u": (601, 8414)} and held() == 3
