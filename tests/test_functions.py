from pyspark.sql import functions as F

from snaptally.functions import decode_path, java_split, text_length


def _one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr.alias("r")).first()["r"]


def test_length_units(spark):
    s = "a\U0001F600é"
    assert _one(spark, text_length(F.col("v"), "chars"), s) == 3
    assert _one(spark, text_length(F.col("v"), "utf16"), s) == 4
    assert _one(spark, text_length(F.col("v"), "bytes"), s) == 7
    # fast path (ASCII) and a non-ASCII value without surrogate pairs
    assert _one(spark, text_length(F.col("v")), "abc") == 3
    assert _one(spark, text_length(F.col("v")), "éèê") == 3
    assert _one(spark, text_length(F.col("v")), "") == 0


def test_length_unit_rejected(spark):
    import pytest

    with pytest.raises(ValueError):
        text_length(F.col("v"), "words")


def test_java_split_rules(spark):
    cases = {
        "a b  c  ": ["a", "b", "", "c"],
        "": [""],
        " a": ["", "a"],
        "   ": [],
        "a": ["a"],
        "a  b": ["a", "", "b"],
    }
    for value, expected in cases.items():
        assert _one(spark, java_split(F.col("v")), value) == expected, value


def test_java_split_other_separator(spark):
    assert _one(spark, java_split(F.col("v"), "\n"), "a\n\nb\n\n") == ["a", "", "b"]
    assert _one(spark, java_split(F.col("v"), "|"), "a|b||") == ["a", "b"]


def test_decode_path(spark):
    assert _one(spark, decode_path(F.col("v")), "file:/x/a%20b%25c/p+q") == "file:/x/a b%c/p+q"


def test_recommended_conf_scales_splits():
    from snaptally.session import recommended_conf

    big = recommended_conf(100 * 10**12, 8000)  # 100 TB on 8,000 slots
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 1 << 30
    small = recommended_conf(10**9, 8)
    assert int(small["spark.sql.files.maxPartitionBytes"]) == 128 << 20
    assert big["spark.sql.shuffle.partitions"] == "16000"
