"""Word count and substring counts over text lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptally.functions.text import java_split

WORD = "word"
COUNT = "count"


def split_words(lines: DataFrame, value_col: str = "value", sep: str = " ") -> DataFrame:
    """One row per word (``word``), split on a single literal separator with
    JVM ``split`` rules: no case folding, interior empty words kept, trailing
    ones dropped; an empty line is one empty word."""
    return lines.select(F.explode(java_split(F.col(value_col), sep)).alias(WORD))


def word_count(lines: DataFrame, value_col: str = "value", sep: str = " ") -> DataFrame:
    """``word, count`` over all lines. Frequent words are pre-counted per task
    before the shuffle, so a very common word is no hot spot."""
    return split_words(lines, value_col, sep).groupBy(WORD).agg(F.count(F.lit(1)).alias(COUNT))


def contains_counts(
    lines: DataFrame,
    needles: Sequence[str] = ("a", "b"),
    value_col: str = "value",
) -> DataFrame:
    """One row, one column ``lines_with_<needle>`` per needle: the number of
    lines containing it (case-sensitive), all counted in a single pass."""
    v = F.col(value_col)
    return lines.agg(
        *[F.count_if(F.contains(v, F.lit(n))).alias(f"lines_with_{n}") for n in needles]
    )
