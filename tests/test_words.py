from conftest import SENTENCES
from snaptally.operators import split_words, word_count


def test_word_count_literal_sentences(spark):
    df = spark.createDataFrame([(s,) for s in SENTENCES], "value string")
    got = {r.word: r["count"] for r in word_count(df).collect()}
    assert got == {"this": 5, "is": 5, "test": 5, "a": 2, "the": 2, "another": 1, "about": 1, "not": 1}
    assert sum(got.values()) == 22


def test_split_words_java_rules(spark):
    df = spark.createDataFrame([("a b  c  ",), ("",), (" a",), ("   ",)], "value string")
    words = sorted(r.word for r in split_words(df).collect())
    assert words == ["", "", "", "a", "a", "b", "c"]


def test_word_count_is_case_sensitive(spark):
    df = spark.createDataFrame([("The the THE",)], "value string")
    assert word_count(df).count() == 3
