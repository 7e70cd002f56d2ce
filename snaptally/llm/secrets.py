"""Secret scan: a random forest removes false positives, in DataFrame expressions only.

Candidates are long tokens of key-like characters. The forest judges each by its
length, character transitions, coverage by common words, standing in a path and the
words before it. Labelled findings come from provider formats and assignments to a
secret's name (positive) and from tokens that are mail addresses, plain words,
numbers or paths (negative); candidates of neither kind are judged, not learned from.
The fitted trees become one SQL expression; scoring needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._native import forest_probability, spans, text_literal
from ._shared import written

MIN_LENGTH = 16
CANDIDATE = rf"(?<![A-Za-z0-9+/_.@-])[A-Za-z0-9+/_.@-]{{{MIN_LENGTH},}}+={{0,2}}+"
FEATURES = ("length", "transitions", "classes", "covered", "path", "cue", "quoted", "distinct", "digits", "hexish")
TRAIN_ROWS = 20_000  #: labelled findings that the forest is fitted on at most
DICTIONARY = 100  #: common words of at least four letters that count as covering
THRESHOLD = 0.5

_CUE = "(?i)(pass(word|wd)?|pwd|secret|token|api[_-]?key|key|auth|credential|bearer)[^a-z0-9]{0,6}$"
# Provider formats: fixed prefixes of access keys and tokens.
_FORMAT = "^(?:AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^sk_live_[A-Za-z0-9]{16,}$|^AIza[A-Za-z0-9_-]{35}$"
_PLAIN = "^[A-Z]?[a-z]+$|^[0-9.+/-]+$|@|^[A-Za-z][a-z]*(?:[._/-][A-Za-z]?[a-z]*)+$"


def common_words(documents: DataFrame, n: int = DICTIONARY) -> list[str]:
    """The most frequent ASCII words of at least four letters, over all texts."""
    words = documents.select(F.explode(F.expr("regexp_extract_all(lower(text), '(?<![a-z])[a-z]{4,12}(?![a-z])', 0)")).alias("w"))
    return [r["w"] for r in words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(n).collect()]


def _candidates(documents: DataFrame, keep: tuple[str, ...], words: list[str]) -> DataFrame:
    docs = documents.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    found = docs.withColumn("__all", spans("__text", CANDIDATE))
    around = "transform(__all, x -> struct(x.s as s, x.e as e, x.v as v, substring(__text, greatest(x.s - 23, 1), least(x.s, 24)) as before, substring(__text, x.e + 1, 1) as after))"
    # longer words first, so the leftmost match of the alternation is the longest
    known = "|".join(sorted(words, key=lambda w: (-len(w), w))) or "(?!)"
    kinds = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(x.v, '[a-z]+', 'a'), '[A-Z]+', 'B'), '[0-9]+', '0'), '[^aB0]+', '-')"
    features = {
        "length": "cast(x.e - x.s as double)",
        "transitions": f"(length({kinds}) - 1) / cast(x.e - x.s as double)",
        "classes": f"cast(size(array_distinct(split({kinds}, ''))) as double)",
        "covered": f"1.0D - length(regexp_replace(lower(x.v), {text_literal(known)}, '')) / cast(x.e - x.s as double)",
        "path": "if(x.v rlike '^[.]{0,2}/|[A-Za-z]/[A-Za-z]|[.][a-z]{2,4}$', 1.0D, 0.0D)",
        "cue": f"if(x.before rlike '{_CUE}', 1.0D, 0.0D)",
        "quoted": "if(x.before rlike '[\"\\'=:]$', 1.0D, 0.0D)",
        "distinct": "size(array_distinct(split(x.v, ''))) / cast(x.e - x.s as double)",
        "digits": "length(regexp_replace(x.v, '[^0-9]', '')) / cast(x.e - x.s as double)",
        "hexish": "if(x.v rlike '^[0-9a-f]+$', 1.0D, 0.0D)",
    }
    fields = ", ".join(f"{e} as {n}" for n, e in features.items())
    label = f"case when x.v rlike '{_FORMAT}' or (x.before rlike '{_CUE}' and x.v rlike '[0-9]' and x.v rlike '[A-Za-z]') then 1.0D when x.v rlike '{_PLAIN}' then 0.0D end"
    return (
        found.withColumn("__all", F.expr(around))
        .withColumn("candidates", F.expr(f"transform(__all, x -> struct(x.s as s, x.e as e, {fields}, {label} as label))"))
        .drop("__all", "__text")
    )


def fit(candidates: DataFrame, *, rows: int = TRAIN_ROWS, seed: int = 5) -> str | None:
    """The forest's probability as an SQL expression on a struct ``x``, fitted on
    at most ``rows`` of the labelled candidates (the least by a hash, half of each
    label at most); None unless both labels occur."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    labelled = candidates.filter("label is not null").withColumn("h", F.xxhash64("id", "s", *FEATURES))
    half = [labelled.filter(F.col("label") == y).orderBy("h", "id", "s").limit(rows // 2) for y in (0.0, 1.0)]
    sample = written(half[0].union(half[1]).coalesce(1))
    if sample.select("label").distinct().count() < 2:
        return None
    shaped = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample).select("features", "label")
    model = RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed).fit(shaped)
    return forest_probability(model, list(FEATURES), "x")


def scan(documents: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD, rows: int = TRAIN_ROWS) -> DataFrame:
    """The columns named in ``keep``, then ``n_candidates``, ``n_secrets``,
    ``secrets`` (``start:end`` in code points, comma-joined) and ``found`` (an array
    of ``s, e, p``) of every whole ``text``.

    Secrets are the candidates to which the forest gives at least ``threshold``;
    without findings of both labels, those that a labelling rule calls positive. A
    null or empty text has none. Rows may repeat; an empty table gives an empty result.
    """
    held = written(_candidates(documents, keep, common_words(documents)))
    each = held.select(F.col("k_0").alias("id"), F.explode("candidates").alias("c")).select("id", "c.*")
    score = fit(each, rows=rows) or "coalesce(x.label, 0.0D)"
    found = F.expr(f"filter(transform(candidates, x -> struct(x.s as s, x.e as e, {score} as p)), x -> x.p >= {threshold!r}D)")
    return held.withColumn("found", found).select(
        *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)],
        F.size("candidates").cast("long").alias("n_candidates"),
        F.size("found").cast("long").alias("n_secrets"),
        F.expr("array_join(transform(found, x -> concat(x.s, ':', x.e)), ',')").alias("secrets"),
        "found",
    )


def op2_secret_forest(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")
