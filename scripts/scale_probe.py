"""Throughput probe on a larger dump derived from the ``events`` test table.

Each event row is repeated ``--copies`` times (``explode(sequence)``, no join)
as a JSON line carrying the copy number, with the acceptance damage pattern
(cut, blank, trailing text, wrapped, padded lines), written as part files into
a new folder below ``--scratch``. Then the line and record statistics are timed
on it (best of ``--repeat``), and one JSON line is printed.

    python scripts/scale_probe.py --sf-dir /root/testdata/sf0.1 --copies 200 --scratch /tmp
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from snaptally.operators import dataset_stats, file_stats, parse_records, table_stats  # noqa: E402
from snaptally.session import local_session  # noqa: E402
from snaptally.sources import scan_lines  # noqa: E402


def build(spark, sf_dir: str, copies: int, out: str, parts: int) -> int:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", "user_id")
    rep = ev.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("copy"))
    i = F.col("event_id") * copies + F.col("copy")
    base = F.concat(
        F.lit('{"~table":"'), F.col("event_type"), F.lit('","id":'), i.cast("string"),
        F.lit(',"user":'), F.col("user_id").cast("string"), F.lit(',"copy":'), F.col("copy").cast("string"),
        F.lit(',"props":{"k":[1,2,3],"s":"x"}}'),
    )
    i = F.col("i")
    line = (
        F.when(i % 11 == 0, F.lit(""))
        .when(i % 7 == 0, F.expr("substr(base, 1, length(base) - 3)"))
        .when(i % 13 == 0, F.concat(F.col("base"), F.lit(" x")))
        .when(i % 17 == 0, F.concat(F.lit("["), F.col("base"), F.lit("]")))
        .otherwise(F.col("base"))
    )
    df = rep.select((F.col("event_id") * copies + F.col("copy")).alias("i"), base.alias("base"))
    df = df.select(line.alias("value"))
    df.repartition(parts).write.text(out)
    return spark.read.text(out).count()


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.1")
    ap.add_argument("--copies", type=int, default=200)
    ap.add_argument("--parts", type=int, default=64)
    ap.add_argument("--scratch", default=tempfile.gettempdir())
    ap.add_argument("--repeat", type=int, default=2)
    a = ap.parse_args()
    spark = local_session(8, app="snaptally-scale")
    spark.sparkContext.setLogLevel("ERROR")
    out = tempfile.mkdtemp(prefix="scale-", dir=a.scratch) + "/dump"
    n = build(spark, a.sf_dir.rstrip("/"), a.copies, out, a.parts)
    size = sum(os.path.getsize(os.path.join(out, f)) for f in os.listdir(out) if f.startswith("part-"))
    lines = scan_lines(spark, out)

    def timed(df) -> float:
        best = float("inf")
        for _ in range(a.repeat):
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - t0)
        return round(best, 2)

    t = {
        "line_count_and_size": timed(dataset_stats(lines)),
        "file_stats": timed(file_stats(spark, out)),
        "table_stats_exact": timed(table_stats(parse_records(lines, keep_record=False))),

    }
    spark.stop()
    print(json.dumps({
        "lines": n, "bytes": size, "path": out, "sec": t,
        "lines_per_sec": {k: round(n / v) for k, v in t.items()},
    }))


if __name__ == "__main__":
    main()
