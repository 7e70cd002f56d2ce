"""A corpus pipeline over ``documents``: filter, remove near duplicates, redact,
mix, tokenize. Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which
is written as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaptally.llm import bpe, count_vector_join, mixing, personal_data, quality
from snaptally.llm._shared import has_repeats, sendable, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence from their language accept. A null
    or empty text has no words and goes; rows that repeat are judged each."""
    return quality.judge(docs, keep=COLUMNS).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a Jaccard similarity of 0.8 of five-word
    shingles: the one with the least doc_id. A row without doc_id stays; of rows
    that repeat one, the least row stays."""
    groups = count_vector_join.jaccard_groups(docs, words=5, num=80, den=100)
    gone = written(groups.filter("doc_id <> component_id").select("doc_id"))
    left = docs.select(*COLUMNS).join(sendable(gone), "doc_id", "left_anti").select(*COLUMNS)
    if not has_repeats(docs, "doc_id"):
        return left
    rest = [c for c in COLUMNS if c != "doc_id"]
    known = left.filter("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("text", *[c for c in rest if c != "text"])).alias("row"))
    return known.select("doc_id", *[F.col(f"row.{c}").alias(c) for c in rest]).union(left.filter("doc_id is null"))


def personal_data_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by ``[KIND]``, and ``n_chars`` counted anew. A null text stays
    null with its ``n_chars``; every row stays, rows that repeat each."""
    found = personal_data.find(docs, keep=COLUMNS)
    return found.withColumn("text", personal_data.redact()).withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), "n_chars")).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the part files hold successive
    slots, each file sorted. Every row stays exactly once; a null source is one source."""
    return mixing.in_mix_order(docs.select(*COLUMNS))


def in_file_order(docs: DataFrame) -> DataFrame:
    """The columns, and ``mix_position``: the row's number over the part files in
    their order, whatever splits they are read in. The one ordered list is a row for
    each part file."""
    rows = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    part = F.regexp_extract("file", r"part-(\d+)[^/]*$", 1)
    before = F.sum("count").over(Window.orderBy(F.length(part), part, "file").rowsBetween(Window.unboundedPreceding, -1))
    files = written(rows.groupBy("file").count().select("file", F.coalesce(before, F.lit(0)).alias("before")))
    return rows.join(sendable(files), "file").select(*COLUMNS, (F.col("before") + F.col("at")).alias("mix_position"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of the ids and of the text that they decode to, with
    the row's ``mix_position``: its number in the order of the mix. A null or empty text
    has no tokens; every row stays."""
    return bpe.encode(in_file_order(docs), keep=("source", "lang", "mix_position"), with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data_redacted),
    ("mixing sources to target weights", mixed_sources),
    ("BPE encoding and decoding", encoded),
]

#: SQL can't express divergence rules, boosted trees or BPE; tests compare run() with a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
