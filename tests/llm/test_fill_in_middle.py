"""Fill-in-middle against a direct version over code points, and its round trip."""

import hashlib
import os
import re

import numpy as np
import pytest

import __spark_entry__ as entry
from snaptally.llm.fill_in_middle import Exceptions, fill_in_middle, restore

from .conftest import DOCS

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
COLUMNS = ["n", "form", "prefix_chars", "middle_chars", "output"]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def direct(doc_id, text, level="unit", fim=50, spm=80, seed=42):
    text = text or ""
    units = UNIT.findall(text) if level == "unit" else list(text)
    assert "".join(units) == text
    x = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(x[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


ODD = ["a <P> b", "x<S>y z", "<M>", "é", "😀😀 😀", " x y z", "tab\there \n\n end \r\n", " lead", "trail  ", "汉字 かな 한글 " * 50, "a" * 3000, "é" * 2000 + " b"]


@pytest.mark.parametrize("level", ["unit", "char"])
@pytest.mark.parametrize("fim, spm", [(50, 80), (100, 0), (100, 100)])
def test_direct(spark, odd, level, fim, spm):
    more = spark.createDataFrame([(1000 + i, t, None, None, 0) for i, t in enumerate(ODD * 4)], DOCS)
    for rows in (odd.select("doc_id", "text"), more.select("doc_id", "text")):
        got = sorted(tuple(r) for r in fill_in_middle(rows, level=level, fim_percent=fim, spm_percent=spm).select("doc_id", *COLUMNS).fillna(-1).collect())
        want = sorted((-1 if r.doc_id is None else r.doc_id, *(-1 if v is None else v for v in direct(r.doc_id, r.text, level, fim, spm))) for r in rows.collect())
        assert got == want


def test_round_trip_and_clashing_names(spark, odd):
    rows = odd.withColumnsRenamed({"lang": "form"})
    out = fill_in_middle(rows, digests=True, keep=("source", "form", "n", "doc"), fim_percent=100)
    assert out.columns == ["doc_id", "source", "doc", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"]
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, set()).add(sha(r.text or ""))
    for r in out.collect():
        assert r.restored_sha256 in texts[r.doc_id] and sha(restore(r.output.encode(), r.form).decode()) == r.restored_sha256
        assert sha(r.output) == r.output_sha256


def test_exceptions_convert_both_ways():
    text = "aé😀 汉b" * 40
    index = Exceptions(np.frombuffer(text.encode(), dtype=np.uint8))
    chars = np.arange(len(text) + 1)
    cuts = np.array([len(text[:i].encode()) for i in chars])
    assert (index.to_bytes(chars) == cuts).all() and (index.to_chars(cuts) == chars).all()
    assert len(Exceptions(np.frombuffer(b"only ascii", dtype=np.uint8)).at_byte) == 0


def test_empty_table_and_one_pass(spark, none):
    out = fill_in_middle(none, digests=True)
    assert out.collect() == []
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_query(spark):
    rows = entry.queries()["op13_fill_in_middle"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n, form, prefix, middle, output = direct(r.doc_id, texts[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) == (n, form, prefix, middle, sha(output), sha(texts[r.doc_id] or ""))
