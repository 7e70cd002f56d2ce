"""Quality rules: base counts, and the divergence of a document from its language.

The reference of a language is the histogram of character classes and of its most
common words over all its documents. A document's own histograms are compared to
it by Jensen-Shannon distance (base 2, so 0 to 1), each only from a least length
on: short texts differ from any reference by chance alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._flat import BYTE_VALUE, LOWER, SEPARATOR, Prefix, Texts, chunks, group_starts, mix2, record, texts_of

COMMON_WORDS = 100
MAX_LANGUAGES = 256
MIN_CHARS, MIN_WORDS = 400, 100  #: least lengths for the two comparisons
MAX_CLASS_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.52

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_TRAILING = np.zeros(256, dtype=bool)
_TRAILING[[ord(c) for c in ".,;:!?)\"'"]] = True

CLASSES = 8  # lower, upper, digit, white space, punctuation, other ASCII, two-byte, longer
_CLASS = np.full(256, 5, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[SEPARATOR] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[0x80:0xC0] = 255  # inside a character
_CLASS[0xC0:0xE0], _CLASS[0xE0:] = 6, 7


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """Words, code points in words, symbols, repeated lines and words in 3-word
    windows that a text holds twice or more."""
    data, n = texts.data, len(texts)
    words = texts.words()
    inside = ~SEPARATOR[data] & ((data & 0xC0) != 0x80)
    owner = words.owner()
    names = words.hashes(data)

    # lines end at \n or with their text
    breaks = data == 0x0A
    at = np.flatnonzero(breaks)
    line_of_text = np.zeros(len(data) + 1, dtype=bool)
    line_of_text[texts.offsets[:-1][texts.lengths > 0]] = True
    line_of_text[at + 1] = True
    starts = np.flatnonzero(line_of_text[: len(data)])
    ends = np.concatenate((starts[1:], [len(data)])) if len(starts) else starts
    ends = ends - (breaks[ends - 1] if len(starts) else 0)
    text = np.searchsorted(texts.offsets, starts, side="right") - 1
    held = np.concatenate(([0], np.cumsum(~SEPARATOR[data])))
    some = held[ends] > held[starts]
    key = mix2(Prefix(BYTE_VALUE[data]).spans(starts[some], ends[some]), text[some].astype(np.uint64))
    text = text[some]
    distinct = np.unique(key, return_index=True)[1]
    n_dup_lines = np.bincount(text, minlength=n) - np.bincount(text[distinct], minlength=n)

    repeated = np.zeros(len(names), dtype=bool)
    if len(names) > 2:
        first = np.flatnonzero(owner[:-2] == owner[2:])
        key = mix2(mix2(mix2(names[first], names[first + 1]), names[first + 2]), owner[first].astype(np.uint64))
        order = np.argsort(key)
        runs = group_starts(key[order])
        size = np.diff(np.concatenate((runs, [len(key)])))
        twice = first[order[np.repeat(size > 1, size)]]
        for i in range(3):
            repeated[twice + i] = True
    return {
        "n_words": words.counts,
        "word_chars": texts.counts(inside),
        "n_symbols": texts.counts(_SYMBOL[data]),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": np.bincount(owner[repeated], minlength=n),
    }


def class_counts(texts: Texts) -> np.ndarray:
    """Characters of each class, a row for each text."""
    kind = _CLASS[texts.data]
    real = kind < CLASSES
    cell = texts.owner()[real].astype(np.int64) * CLASSES + kind[real]
    return np.bincount(cell, minlength=len(texts) * CLASSES).reshape(len(texts), CLASSES)


def plain_words(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Names of the words in lower case (A-Z) without closing punctuation, and
    the text of each."""
    words = texts.words()
    ends = words.ends.copy()
    for _ in range(3):
        cut = (ends - words.starts > 1) & _TRAILING[texts.data[ends - 1]]
        ends[cut] -= 1
    return Prefix(BYTE_VALUE[LOWER[texts.data]]).spans(words.starts, ends), words.owner()


def _histograms(batches):
    schema = pa.schema([("lang", pa.string()), ("kind", pa.int32()), ("name", pa.int64()), ("n", pa.int64())])
    for part in chunks(batches, "text"):
        langs = part.column("lang").dictionary_encode()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            texts = texts_of(part.column("text").take(pa.array(np.flatnonzero(langs.indices.to_numpy() == i))))
            name, n = np.unique(plain_words(texts)[0], return_counts=True)
            yield record(schema, [lang] * len(name), np.ones(len(name), dtype=np.int32), name, n)
            yield record(schema, [lang] * CLASSES, np.zeros(CLASSES, dtype=np.int32), np.arange(CLASSES), class_counts(texts).sum(axis=0))


class References:
    """Histograms of the languages: class shares, and the shares of common words
    with all others last."""

    def __init__(self, languages: list[str], classes: np.ndarray, words: list[dict[int, float]]):
        self.languages, self.classes = languages, classes
        self.place = {x: i for i, x in enumerate(languages)}
        pairs = sorted((int(mix2(np.array([w], dtype=np.uint64), np.array([i], dtype=np.uint64))[0]), i, share) for i, own in enumerate(words) for w, share in own.items())
        self.keys = np.array([p[0] for p in pairs], dtype=np.uint64)
        self.owner = np.array([p[1] for p in pairs], dtype=np.int64)
        self.share = np.array([p[2] for p in pairs])
        self.other = np.array([max(0.0, 1 - sum(own.values())) for own in words])


def learn_references(documents: DataFrame, *, common_words: int = COMMON_WORDS, max_languages: int = MAX_LANGUAGES) -> References:
    """References from all documents with a text and a ``lang``. The driver gets
    ``common_words`` rows for each of at most ``max_languages`` languages, the
    ones with the most documents."""
    rows = documents.select("text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    languages = sorted(r["lang"] for r in rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect())
    counts = rows.mapInArrow(_histograms, "lang string, kind int, name long, n long").groupBy("lang", "kind", "name").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "name"))
    best = counts.withColumn("rank", rank).filter(F.col("rank") <= max(common_words, CLASSES))
    totals = counts.filter("kind = 1").groupBy("lang").agg(F.sum("n").alias("total"))
    table = best.join(totals, "lang", "left").collect() if languages else []
    place = {x: i for i, x in enumerate(languages)}
    classes = np.zeros((len(languages), CLASSES))
    words: list[dict[int, float]] = [{} for _ in languages]
    for r in table:
        i = place.get(r["lang"])
        if i is None:
            continue
        if r["kind"] == 0:
            classes[i, r["name"]] = r["n"]
        elif r["rank"] <= common_words:
            words[i][r["name"] & 0xFFFFFFFFFFFFFFFF] = r["n"] / r["total"]
    return References(languages, classes / np.maximum(classes.sum(axis=1, keepdims=True), 1), words)


def _entropy_term(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, p * np.log2(np.where(p > 0, p, 1)), 0.0)


def distances(texts: Texts, langs: list, refs: References) -> tuple[np.ndarray, np.ndarray]:
    """Jensen-Shannon distances of classes and words of each text from its
    language; from the nearest one if its language is null or has no reference.
    Without any reference, 0."""
    n = len(texts)
    by_class, by_word = np.full(n, np.inf), np.full(n, np.inf)
    if not refs.languages:
        return np.zeros(n), np.zeros(n)
    p = class_counts(texts)
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    names, owner = plain_words(texts)
    total = np.maximum(np.bincount(owner, minlength=n), 1)
    own = np.array([refs.place.get(x, -1) for x in langs], dtype=np.int64)
    for i in np.unique(own).tolist() if (own >= 0).all() else range(len(refs.languages)):
        rows = (own == i) | (own < 0)
        if not rows.any():
            continue
        q = refs.classes[i]
        m = (p + q) / 2
        jsd = -_entropy_term(m).sum(axis=1) + (_entropy_term(p).sum(axis=1) + _entropy_term(q).sum()) / 2
        by_class = np.where(rows, np.minimum(by_class, np.sqrt(np.maximum(jsd, 0))), by_class)
        # words: start from a text without any common word, then correct those it has
        key = mix2(names, np.full(len(names), i, dtype=np.uint64))
        at = np.minimum(np.searchsorted(refs.keys, key), max(len(refs.keys) - 1, 0))
        hit = (refs.keys[at] == key) & rows[owner] if len(refs.keys) else np.zeros(len(key), dtype=bool)
        cell, count = np.unique(owner[hit].astype(np.int64) * len(refs.keys) + at[hit], return_counts=True)
        text, word = cell // max(len(refs.keys), 1), cell % max(len(refs.keys), 1)
        share, q = count / total[text], refs.share[word]
        language = refs.share[refs.owner == i]
        base = -_entropy_term(language / 2).sum() + _entropy_term(language).sum() / 2
        gain = -_entropy_term((share + q) / 2) + _entropy_term(q / 2) + _entropy_term(share) / 2
        jsd = base + np.bincount(text, weights=gain, minlength=n)
        rest = 1 - np.bincount(text, weights=share, minlength=n)
        other = refs.other[i]
        jsd += -_entropy_term((rest + other) / 2) + (_entropy_term(rest) + _entropy_term(np.array(other))) / 2
        by_word = np.where(rows, np.minimum(by_word, np.sqrt(np.maximum(jsd, 0))), by_word)
    return by_class, by_word


def judge(documents: DataFrame, refs: References | None = None, *, min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS, max_class_distance: float = MAX_CLASS_DISTANCE, max_word_distance: float = MAX_WORD_DISTANCE, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns named in ``keep``, then ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, class_distance,
    word_distance`` of every document.

    ``base_failed``: fewer than 50 words, or more than half of the words in 3-word
    windows found twice. Otherwise a document is rejected if its class distance
    (from ``min_chars`` code points in words on) or its word distance (from
    ``min_words`` words on) is above the limit. References are learned from the
    same documents unless given.

    A null or empty text has no words and fails the base. A null ``lang``, or one
    without a reference, is compared to the nearest reference. Rows may repeat; an
    empty table gives an empty result.
    """
    known = refs or learn_references(documents)  # travels with the function, by value
    rows = documents.select(*keep, F.col("lang").cast("string").alias("__lang"), F.col("text").alias("__text"))
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-2])
    out += "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, word_distance double"
    names = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"]

    def run(batches):
        for part in chunks(batches, "__text"):
            texts = texts_of(part.column("__text"))
            c = base_counts(texts)
            by_class, by_word = distances(texts, part.column("__lang").to_pylist(), known)
            failed = (c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])
            strange = ((c["word_chars"] >= min_chars) & (by_class > max_class_distance)) | ((c["n_words"] >= min_words) & (by_word > max_word_distance))
            columns = [part.column(i) for i in range(len(keep))]
            columns += [pa.array(c[k].astype(np.int64)) for k in names[len(keep) : len(keep) + 5]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(failed), pa.array(~failed & ~strange), pa.array(by_class), pa.array(by_word)], names=names)

    return rows.mapInArrow(run, out)


def op1_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts and verdicts of all documents."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))
