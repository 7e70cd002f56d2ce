"""Quality rules and language identification."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa

from snaptally.llm import _flat, language_filter, quality

from .conftest import DOCS, odd_documents, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    w = WORD.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    count = collections.Counter(zip(w, w[1:], w[2:]))  # noqa: B905
    inside = {j for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeated, len(inside)


def test_base_counts_of_odd_documents(odd, none):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = quality.judge(odd, keep=("doc_id", "text")).collect()
    assert len(rows) == len(odd_documents())
    for r in rows:
        b = base(r.text)
        assert tuple(r[n] for n in names) == b, r.text
        assert r.base_failed == (b[0] < 50 or 100 * b[4] > 50 * b[0])
        assert not (r.base_failed and r.kept)
    assert quality.judge(none).collect() == []


def js_distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    h = lambda x: -sum(v * math.log2(v) for v in x if v > 0)
    return math.sqrt(max(0.0, h(m) - (h(p) + h(q)) / 2))


def test_distances_equal_the_definition(spark):
    rows = [(i, " ".join(words(i, 120, 60)), "xy"[i % 2], "s", 1) for i in range(30)] + [(99, "Ab, 1# é 漢 " * 30, None, "s", 1)]
    df = spark.createDataFrame(rows, DOCS)
    refs = quality.learn_references(df, common_words=20)
    got = {r.doc_id: r for r in quality.judge(df, refs).collect()}

    def classes(t):
        kind = lambda c: 0 if c in "abcdefghijklmnopqrstuvwxyz" else 1 if c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" else 2 if c in "0123456789" else 3 if c in " \t\n\v\f\r" else 4 if c in ".,;:!?'\"()-" else 5 if ord(c) < 128 else 6 if ord(c) < 0x800 else 7
        return collections.Counter(map(kind, t))

    plain = lambda t: [re.sub(r"(?<=.)[.,;:!?)\"']{1,3}$", "", w.lower()) for w in WORD.findall(t)]
    for lang in "xy":
        own = [r[1] for r in rows if r[2] == lang]
        ref_c = sum((classes(t) for t in own), collections.Counter())
        ref_w = collections.Counter(w for t in own for w in plain(t))
        total = sum(ref_w.values())
        ends = sorted(ref_w.values(), reverse=True)
        for i, t, docs_lang, _, _ in rows:
            if docs_lang != lang:
                continue
            c, n = classes(t), len(t)
            assert math.isclose(got[i].class_distance, js_distance([c[k] / n for k in range(8)], [ref_c[k] / sum(ref_c.values()) for k in range(8)]), abs_tol=1e-9)
            if ends[19] > ends[20]:  # no tie at the cut: the 20 words are known
                top = [w for w, _ in ref_w.most_common(20)]
                mine, k = collections.Counter(plain(t)), len(plain(t))
                p, q = [mine[w] / k for w in top], [ref_w[w] / total for w in top]
                assert math.isclose(got[i].word_distance, js_distance([*p, 1 - sum(p)], [*q, 1 - sum(q)]), abs_tol=1e-6)


def test_junk_is_rejected_and_clean_text_kept(spark):
    rows = [(i, " ".join(words(i, 200, 150)), "en", "s", 1) for i in range(80)]
    rows += [(1000 + i, " ".join(f"{w}### $$$" for w in words(i, 200, 150)), "en", "s", 1) for i in range(6)]
    kept = {r.doc_id: r.kept for r in quality.judge(spark.createDataFrame(rows, DOCS)).collect() if not r.base_failed}
    assert all(v for k, v in kept.items() if k < 1000) and not any(v for k, v in kept.items() if k >= 1000)


SAMPLES = {
    "en": "the cat sat on the mat and thought about where that other thing went with them",
    "de": "der hund und die katze schlafen nicht weil das wetter schlecht ist und sie warten auf uns",
    "fr": "le chat et le chien ne dorment pas parce que les voisins font du bruit dans la cour",
}


def language_rows():
    import random

    rng, rows = random.Random(4), []
    for i in range(400):
        lang = [*SAMPLES][i % 3]
        w = SAMPLES[lang].split()
        rows.append((i, " ".join(rng.choice(w) for _ in range(rng.randint(8, 60))), lang, "s", 1))
    return rows


def test_held_out_accuracy_and_odd_texts(spark, odd, none):
    rows = language_rows()
    extra = [(1000 + i, t, lang, "s", 1) for i, (t, lang) in enumerate([(None, "en"), ("", "en"), (" \n", "de"), ("123 !?", "fr"), ("a", None), ("😀", "en"), ("漢字", "en"), ("THE CAT AND THE MAT", None), ("x" * 200_000, "en")])]
    got = {r.doc_id: r for r in language_filter.identify(spark.createDataFrame(rows + extra, DOCS)).collect()}
    assert len(got) == len(rows) + len(extra)
    for i, r in got.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.lang_pred in {*SAMPLES, "und"}
    held = [r for r in rows if got[r[0]].held_out]
    assert len(held) > 50 and sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.98 * len(held)
    assert [got[1000 + i].lang_pred for i in (0, 1, 2, 3, 5)] == ["und"] * 5
    assert got[1004].lang_pred != "und" and got[1006].lang_pred != "und" and got[1007].lang_pred == "en"
    assert language_filter.identify(odd).count() == len(odd_documents())
    assert language_filter.identify(none).collect() == []
    # nothing to learn from: everything is und
    assert {r.lang_pred for r in language_filter.predict(spark.createDataFrame(rows[:5], DOCS), None).collect()} == {"und"}


def test_prediction_ignores_lang_source_and_id(spark):
    rows = language_rows()
    model = language_filter.learn(spark.createDataFrame(rows, DOCS))
    a = spark.createDataFrame(rows, DOCS)
    b = spark.createDataFrame([(r[0] + 10**6, r[1], "zz", "other", 1) for r in rows], DOCS)
    pick = lambda df: sorted((r.text, r.lang_pred, r.score) for r in language_filter.predict(df, model, keep=("text",)).select("text", "lang_pred", "score").collect())
    assert pick(a) == pick(b)


def test_filter_names_all_languages_of_a_gram():
    rows = [("a", 5), ("b", 5), ("b", 9), ("c", 77)] + [("d", 1000 + i) for i in range(900)]
    model = language_filter.LanguageFilter(["a", "b", "c", "d"], rows, top=1000)
    counts = model.counts(np.array([5, 9, 77, 12345], dtype=np.uint64), np.array([1, 1, 1, 1]))
    assert (counts > 0.5).tolist()[:3] == [[True, True, False, False], [False, True, False, False], [False, False, True, False]]
    many = language_filter.LanguageFilter([f"l{i}" for i in range(70)], [(f"l{i}", i) for i in range(70)], top=10)
    hit = many.counts(np.array([69], dtype=np.uint64), np.array([1]))
    assert hit[0].argmax() == 69


def test_grams_stay_inside_texts():
    code, n = language_filter.grams(_flat.texts_of(pa.array(["ab", "", "abc", " a  b"])), 4)
    show = ["".join(chr(int(c) >> s & 255) for s in (24, 16, 8, 0)) for c in code]
    assert show == [" ab ", " abc", "abc "] and n.tolist() == [1, 0, 2, 0]
