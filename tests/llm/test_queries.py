"""The registered queries over whole small tables: against DuckDB where there is a
statement, else against the direct versions."""

import hashlib
import os
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry

from .test_models import base
from .test_native import direct as direct_spans
from .test_repeats import BYTES, direct_bytes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, prefix):
    name = next(x for x in entry.queries() if x.startswith(prefix))
    return entry.queries()[name](spark, SF)


@pytest.mark.parametrize("prefix", ["op4_", "op8_", "op10_", "op13_"])
def test_against_duckdb(spark, prefix):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    name = next(x for x in entry.queries() if x.startswith(prefix))
    rel = con.sql(entry.oracle_sql()[name])
    df = run(spark, prefix)
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    got = sorted(tuple(repr(r[c]) for c in order) for r in df.collect())
    assert got == sorted(tuple(repr(r[rel.columns.index(c)]) for c in order) for r in rel.fetchall())


def test_op1(spark, texts):
    rows = run(spark, "op1_").collect()
    assert len(rows) == len(texts)
    for r in rows:
        b = base(texts[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0]) and not (r.base_failed and r.kept)


def test_op2_finds_planted_secrets(spark, texts):
    import re

    pattern = re.compile(r'(?i)(?:password=|token = ")([0-9a-f]{16,})|(AKIA[0-9A-Z]{16})')
    for r in run(spark, "op2_").collect():
        got = {tuple(map(int, x.split(":"))) for x in r.secrets.split(",") if x}
        assert got == {m.span(1) if m[1] else m.span(2) for m in pattern.finditer(texts[r.doc_id].text)}


def test_op3_places_every_document_once(spark, texts):
    rows = run(spark, "op3_").collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert len({(r.mix_slot, r.mix_row) for r in rows}) == len(rows)


def test_op5(spark, texts):
    got = {r.doc_id: tuple(r[c] for c in BYTES) for r in run(spark, "op5_").collect()}
    assert got == direct_bytes({i: r.text for i, r in texts.items()}, 100)


def test_op6(spark, texts):
    rows = run(spark, "op6_").collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = direct_spans(texts[r.doc_id].text)
        joined = ",".join(f"{n}:{s}:{e}" for s, _, e, n in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans == joined  # nothing else in these documents looks like personal data


def test_op7_held_out_accuracy(spark, texts):
    rows = run(spark, "op7_").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(texts) and {r.doc_id for r in held} == {i for i in texts if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == texts[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_op9(spark, texts):
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    library = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    rows = run(spark, "op9_").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id].text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
