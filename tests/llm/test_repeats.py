"""Byte and word repeats against direct versions."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from snaptally.llm import _flat, _repeats, recompression, suffix_dedup

from .conftest import by_id, odd_documents


def direct_bytes(texts, length):
    seen, out = set(), {}
    for i in sorted(texts):
        b = (texts[i] or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            if w in seen:
                gone[s : s + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest())
    return out


def direct_words(texts, window):
    seen, out = set(), {}
    for i in sorted(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[i] or "")
        gone, own = [False] * len(w), set()
        for s in range(len(w) - window + 1):
            x = tuple(w[s : s + window])
            own.add(x)
            if x in seen:
                gone[s : s + window] = [True] * window
        seen |= own
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def result(df, columns):
    rows = df.collect()
    out = {r.doc_id: tuple(r[c] for c in columns) for r in rows}
    assert len(out) == len(rows)
    return out


BYTES = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize(("hot", "least"), [(20_000, 64), (0, 64), (20_000, 2)])
def test_bytes_odd(odd, monkeypatch, hot, least):
    # hot=0 deals every open cell by window, least=2 spreads most buckets: the same result
    monkeypatch.setattr(_repeats, "HOT_LEAST", least)
    docs = _repeats.keyed(odd)
    spans = _repeats.seen_earlier(docs, 100, suffix_dedup.byte_cells(100, 32), suffix_dedup.byte_windows(100), within=True, hot=hot)
    got = result(_repeats.with_texts(docs, spans, suffix_dedup._results(False), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), BYTES)
    assert got == direct_bytes(by_id(odd_documents()), 100)


def test_words_odd(odd):
    rows = recompression.remove_passages(odd, with_text=True)
    assert result(rows, WORDS) == direct_words(by_id(odd_documents()), 50)
    for r in rows.collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_short_windows_of_few_symbols(spark):
    # long runs, periods and tight alphabets: the hard cases for names and anchors
    rng = random.Random(4)
    texts = {i: " ".join(rng.choice(["a", "b", "a a a", "a b a b", "c"]) for _ in range(rng.randint(0, 90))) for i in range(60)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert result(recompression.remove_passages(df), WORDS) == direct_words(texts, 50)
    assert result(suffix_dedup.remove_repeats(df, length=24, q=8), BYTES) == direct_bytes(texts, 24)


def test_empty_tables(none):
    assert suffix_dedup.remove_repeats(none).collect() == []
    assert recompression.remove_passages(none).collect() == []


def test_inner_symbols_are_the_same_in_every_context():
    # recompression's promise: symbols further than the margin from an edge agree
    rng = random.Random(1)
    lost, longest = recompression.margin()
    for _ in range(200):
        shared = [rng.choice("abc") for _ in range(60)]
        found = []
        for _ in range(2):
            text = [rng.choice("abc") for _ in range(rng.randint(0, 20))]
            at = len(text)
            text += shared + [rng.choice("abc") for _ in range(rng.randint(0, 20))]
            names = np.array([_flat.BYTE_VALUE[ord(c)] for c in text])
            got, size, _ = recompression.compress(names, np.ones(len(text), dtype=np.int64), np.zeros(len(text), dtype=np.int32))
            begin = np.cumsum(size) - size - at
            found.append([(b, n, s) for b, n, s in zip(begin.tolist(), got.tolist(), size.tolist(), strict=True) if b >= lost and b + s <= 60 - lost])
            assert size.max() <= longest
        assert found[0] == found[1] and found[0]


def test_flat_words_and_hashes():
    texts = ["a  bc\x0bd", "", "é x", "bc"]
    t = _flat.texts_of(pa.array(texts))
    w = t.words()
    raw = t.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(w.starts, w.ends, strict=True)] == ["a", "bc", "d", "é", "x", "bc"]
    assert w.counts.tolist() == [3, 0, 2, 1]
    h = w.hashes(t.data)
    assert h[1] == h[5] and len(set(h.tolist())) == 5


def test_parameters(none):
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(none, length=10, q=10)
    with pytest.raises(ValueError):
        recompression.remove_passages(none, window=20)
