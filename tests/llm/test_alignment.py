"""Token alignment against a direct version: the libraries on whole texts, and plain loops."""

import collections
import hashlib
import os
import random

import numpy as np
import pytest

import __spark_entry__ as entry
from snaptally.llm.bpe import byte_chars
from snaptally.llm.token_alignment import Aligner, Tokenizers, align, groups, labels, pair_counts, vocabularies

from .conftest import DOCS

pytest.importorskip("tiktoken")
pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
ODD = [
    "a ▁ b", "x▁y", "  x  y", "a　 b", "tab\t x\r y {\r z", "\x00 nul \x00", "<|endoftext|> <s> </s> <unk> <0x41>", "  two  spaces   three ", "é é ﬁ Å", "😀 👩‍👩‍👧 汉字かな",
    "x" * 3000, "a" + " \n" * 900 + "b c" + "\n" * 2000, "\t" * 5000 + "x", "é" + "　" * 1500 + "é  y", "don't we'll I'm  it's", "\n\n\n a\n\n b", "ab\u0085 c  d  e", " ", "\t", "12345 678,90 -- !!!", "한글 텍스트 ภาษาไทย العربية",
]


class Direct:
    def __init__(self):
        import sentencepiece

        self.a = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))
        of = {c: i for i, c in enumerate(byte_chars())}
        self.bytes_a = {i: bytes(of[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in of for c in t)}

    def piece(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def cut(self, text):
        """Groups of both ids."""
        if not text:
            return []
        raw = (" " + text).encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        cut_a, cut_b = [self.bytes_a[i] for i in a], [self.piece(i) for i in b]
        if b"".join(cut_a) != raw or b"".join(cut_b) != raw:
            return []
        ends_a, ends_b = list(np.cumsum([len(x) for x in cut_a])), list(np.cumsum([len(x) for x in cut_b]))
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            out.append((a[i:x], b[j:y]))
            i, j = x, y
        return out

    def rows(self, docs):
        cuts = [(i, self.cut(t)) for i, t in docs]
        counts = collections.Counter((x[-1], y[-1]) for _, c in cuts for x, y in c)
        best = collections.Counter()
        for (_, y), n in counts.items():
            best[y] = max(best[y], n)
        out = []
        for i, c in cuts:
            pairs = [(x[-1], y[-1]) for x, y in c]
            text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in c)
            out.append((i, sum(len(x) for x, _ in c), sum(len(y) for _, y in c), len(c), len(c), sum(counts[p] == best[p[1]] for p in pairs), sum(counts[p] for p in pairs), text))
        return out, counts


@pytest.fixture(scope="module")
def direct():
    return Direct()


def key(row):
    return tuple(-1 if v is None else v for v in row)


@pytest.mark.parametrize("sent", [2_000_000, 200, 0])
def test_direct(spark, odd, direct, sent):
    rows = odd.select("doc_id", "text").union(spark.createDataFrame([(1000 + i, t, None, None, 0) for i, t in enumerate(ODD)], DOCS).select("doc_id", "text"))
    want, _ = direct.rows([(r.doc_id, r.text) for r in rows.collect()])
    got = align(rows, pairs_sent=sent).select(COLUMNS).collect()
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_pair_counts(spark, odd, direct):
    _, counts = direct.rows([(r.doc_id, r.text) for r in odd.collect()])
    got = {(r.a_id, r.b_id): (r["count"], r.best) for r in pair_counts(groups(odd)).collect()}
    assert {k: n for k, (n, _) in got.items()} == dict(counts)
    assert all(best == (n == max(m for (_, y), m in counts.items() if y == k[1])) for k, (n, best) in got.items())


def test_units_equal_whole_texts(direct):
    """Random texts of awkward characters: joined units give the ids of the whole text."""
    import pyarrow as pa

    from snaptally.llm._flat import texts_of

    rng = random.Random(5)
    pool = [*"ab1.'{}\t\n\r\x0b\x0c  ", " ", "\u0085", " ", " ", "　", " ", "é", "汉", "😀", "▁", "'s", "\x00", "<s>", "​", "́", "the", "ing"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(0, 14))) for _ in range(4000)]
    aligner = Aligner(Tokenizers(*vocabularies()))
    data, ends = aligner.look(texts_of(pa.array(texts))).forms()
    raw = data.tobytes().decode()
    for i, t in enumerate(texts):
        want = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in direct.cut(t))
        assert raw[ends[i] : ends[i + 1]] == want, t


def test_labels_of_long_chains():
    """A and B never end together but at the last byte: one component of 20,001 tokens."""
    a, b = np.append(np.arange(2, 20001, 2), 20001), np.append(np.arange(1, 20000, 2), 20001)
    x, y = labels(a, b)
    assert set(x.tolist()) == {len(b) - 1} == set(y.tolist())


def test_empty_table_and_clashing_names(spark, odd, none):
    assert align(none).collect() == []
    out = align(odd.withColumnsRenamed({"lang": "n_a"}), keep=("source", "n_a", "doc"), digest=True)
    assert out.columns == ["doc_id", "source", "doc", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256"]
    assert out.count() == odd.count()


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_query(spark, direct):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want, _ = direct.rows(docs)
    hashed = [(*w[:7], hashlib.sha256(w[7].encode()).hexdigest() if w[7] else "") for w in want]
    got = entry.queries()["op11_token_alignment"](spark, SF).select(*COLUMNS[:7], "groups_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(hashed)
