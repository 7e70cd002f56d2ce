"""Language identification with language-bitmask n-gram filters.

The filter is a Bloom filter cut into slices: each slot holds a bit mask of
languages, so the AND of an n-gram's slots names all languages whose filter holds
it at once. Each language's popcount over a text is corrected for the false
positives expected from its slice's fill; the language that explains most n-grams
wins. The n-grams of a language are its most frequent ones over all training text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._flat import Texts, chunks, mix, record, texts_of

GRAM = 4  #: bytes of an n-gram
TOP = 5_000  #: n-grams in the filter of each language
HASHES = 3
SLOTS_PER_GRAM = 16
MAX_LANGUAGES = 256  #: most frequent ones in training; bounds the filter

# letters in lower case, bytes of longer characters as they are, all else one space
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def grams(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of all texts, each between two spaces, and how many belong
    to each text. N-grams with two spaces in a row are left out."""
    n = len(texts)
    owner = texts.owner()
    data = np.full(len(texts.data) + 2 * n, 0x20, dtype=np.uint8)
    data[np.arange(len(owner)) + 2 * owner.astype(np.int64) + 1] = _FOLD[texts.data]
    ends = texts.offsets[1:] + 2 * np.arange(1, n + 1)
    if len(data) < size:
        return np.zeros(0, dtype=np.uint64), np.zeros(n, dtype=np.int64)
    m = len(data) - size + 1
    code = np.zeros(m, dtype=np.uint64)
    for i in range(size):
        code = (code << np.uint64(8)) | data[i : i + m]
    space = data == 0x20
    # two spaces in a row also stand at every border between texts
    good = np.ones(m, dtype=bool)
    for i in range(size - 1):
        good &= ~(space[i : i + m] & space[i + 1 : i + 1 + m])
    sums = np.concatenate(([0], np.cumsum(good)))
    cut = sums[np.clip(ends, 0, m)]
    return code[good], np.diff(np.concatenate(([0], cut)))


def has_letter(texts: Texts, raw: pa.Array) -> np.ndarray:
    ascii_letters = texts.counts(_LETTER[texts.data]) > 0
    longer = (texts.counts(texts.data >= 128) > 0) & ~ascii_letters
    for i in np.flatnonzero(longer).tolist():
        ascii_letters[i] = any(c.isalpha() for c in raw[i].as_py())
    return ascii_letters


class LanguageFilter:
    """Bit-sliced Bloom filters of up to 64 languages per mask word."""

    def __init__(self, languages: list[str], rows: list[tuple[str, int]], top: int, hashes: int = HASHES):
        self.languages, self.hashes = languages, hashes
        self.slots = 1 << max(10, (SLOTS_PER_GRAM * top - 1).bit_length())
        self.table = np.zeros((max(1, -(-len(languages) // 64)), self.slots), dtype=np.uint64)
        place = {x: i for i, x in enumerate(languages)}
        lang = np.array([place[x] for x, _ in rows], dtype=np.int64)
        code = np.array([c for _, c in rows], dtype=np.uint64)
        for at in self.positions(code):
            np.bitwise_or.at(self.table, (lang // 64, at), np.uint64(1) << (lang % 64).astype(np.uint64))
        fill = np.array([((self.table[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
        self.false = fill**hashes

    def positions(self, code: np.ndarray) -> list[np.ndarray]:
        h = mix(code)
        bits = np.uint64(self.slots - 1)
        step = (h >> np.uint64(32)) | np.uint64(1)
        return [((h + np.uint64(i) * step) & bits).astype(np.int64) for i in range(self.hashes)]

    def counts(self, code: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        """Corrected popcounts: a row for each text, a column for each language."""
        at = self.positions(code)
        borders = np.concatenate(([0], np.cumsum(per_text)))
        out = np.zeros((len(per_text), len(self.languages)))
        for w, table in enumerate(self.table):
            mask = table[at[0]]
            for x in at[1:]:
                mask &= table[x]
            for i in range(64 * w, min(64 * w + 64, len(self.languages))):
                sums = np.concatenate(([0], np.cumsum((mask >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)))
                out[:, i] = sums[borders[1:]] - sums[borders[:-1]]
        return np.maximum(0, (out - per_text[:, None] * self.false) / (1 - self.false))


def _gram_counts(size: int):
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for part in chunks(batches, "text"):
            langs = part.column("lang").dictionary_encode()
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                own = part.column("text").take(pa.array(np.flatnonzero(langs.indices.to_numpy() == i)))
                code, n = np.unique(grams(texts_of(own), size)[0], return_counts=True)
                yield record(schema, [lang] * len(code), code, n)

    return run


def learn(labelled: DataFrame, *, gram: int = GRAM, top: int = TOP, max_languages: int = MAX_LANGUAGES) -> LanguageFilter | None:
    """The filter of the ``lang`` values in ``labelled`` (``text``, ``lang``; rows
    with a null are skipped); None if there are none.

    Counts cover all rows. The driver gets ``top`` n-grams for each of at most
    ``max_languages`` languages; the others aren't learned.
    """
    rows = labelled.select("text", F.col("lang").cast("string").alias("lang")).filter("text is not null and lang is not null")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not sizes:
        return None
    languages = [r["lang"] for r in sizes]  # the most frequent first
    counts = rows.mapInArrow(_gram_counts(gram), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).filter(F.col("rank") <= top)
    if len(languages) == max_languages:
        best = best.join(F.broadcast(labelled.sparkSession.createDataFrame(sizes).select("lang")), "lang")
    return LanguageFilter(languages, [(r["lang"], r["gram"] & 0xFFFFFFFFFFFFFFFF) for r in best.select("lang", "gram").collect()], top)


def predict(documents: DataFrame, model: LanguageFilter | None, *, gram: int = GRAM, keep: tuple[str, ...] = ()) -> DataFrame:
    """The language of every whole ``text``: the columns named in ``keep``, then
    ``lang_pred`` and ``score``, the share of the text's n-grams that the language
    explains.

    ``und`` with score 0 where the text is null or has no letter, or nothing was
    learned. A text with a letter that no language explains gets the most frequent
    language of the training rows with score 0; ties go to the more frequent one.
    Rows may repeat; an empty table gives an empty result.
    """
    rows = documents.select(*keep, F.col("text").alias("__text"))
    out = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1]) + "lang_pred string, score double"

    def run(batches):  # the model travels with the function, by value
        for part in chunks(batches, "__text"):
            raw = part.column("__text")
            texts = texts_of(raw)
            text = has_letter(texts, raw)
            if model is None:
                names, score = [None] * len(text), np.zeros(len(text))
            else:
                code, n = grams(texts, gram)
                counts = model.counts(code, n)
                best = counts.argmax(axis=1)
                score = np.where(text, np.clip(counts[np.arange(len(n)), best] / np.maximum(n, 1), 0, 1), 0.0)
                names = [model.languages[i] for i in best.tolist()]
            names = [x if ok and x is not None else "und" for x, ok in zip(names, text.tolist(), strict=True)]
            columns = [part.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names, pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return rows.mapInArrow(run, out)


def identify(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document, learned from the
    documents that aren't held out: crc32 of the doc_id as text modulo 4 is not 2.
    A null doc_id is neither held out nor learned from."""
    out = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 4 == 2
    rows = documents.select("doc_id", "text", "lang", out.alias("held_out"))
    model = learn(rows.filter(~F.col("held_out")), **options)
    return predict(rows.withColumn("held_out", F.coalesce("held_out", F.lit(False))), model, keep=("doc_id", "held_out"), gram=options.get("gram", GRAM))


def op7_language_id(spark, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from three of four folds."""
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))
