"""Length units and the JVM split rule against direct Python computations."""

import random

from pyspark.sql import functions as F

from snaptally.functions import java_split, text_length

ALPHABET = ["a", "b", " ", "  ", "é", "中", "\U0001F600", "\U00010348", "\t", "\r", ",", "\\", '"']


def jvm_split(s: str, sep: str) -> list[str]:
    """String.split(sep) of the JVM for a one-character literal separator."""
    if s == "":
        return [""]
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_lengths_and_split_match_python(spark):
    rnd = random.Random(5)
    values = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randrange(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    v = F.col("v")
    rows = df.select(
        "i",
        text_length(v, "utf16").alias("u16"), text_length(v, "chars").alias("ch"),
        text_length(v, "bytes").alias("by"), java_split(v, " ").alias("sp"), java_split(v, ",").alias("sc"),
    ).collect()
    for r in rows:
        s = values[r.i]
        assert r.u16 == len(s.encode("utf-16-le")) // 2, s
        assert r.ch == len(s), s
        assert r.by == len(s.encode("utf-8")), s
        assert r.sp == jvm_split(s, " "), s
        assert r.sc == jvm_split(s, ","), s
