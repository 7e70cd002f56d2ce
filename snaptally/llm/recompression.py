"""Repeated passages of words by recompression.

Each word is a symbol. A round first names runs of equal symbols (up to a few
words long), then deals symbols to a left and a right half by their names and names
every left-right pair that is adjacent. A name is a hash of the names it replaces,
so all tasks name alike without exchanging tables.

What happens to a symbol depends on its neighbours only, so a round disturbs a
bounded number of words at each edge of a repeated passage (:func:`margin`). The
symbols further inside are the same in every occurrence. Each window of 50 words
is filed under one of these inner symbols, the one with the least name; windows are
then compared by the 64-bit hash of all their words (:mod:`_repeats`). The two rounds run
inside a task, as no table of names has to be shared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._flat import Prefix, Texts, chunks, mix, mix2, record, texts_of
from ._repeats import Cells, _span_flags, digests, keyed, runs_per_text, seen_earlier, with_texts

WINDOW = 50
RUN_WORDS = (2, 4)  #: longest run, in words, that each round names; one round for each


def margin(runs: tuple[int, ...] = RUN_WORDS) -> tuple[int, int]:
    """Words that the rounds can disturb at each edge of a repeat, and the
    longest symbol in words."""
    lost, longest = 0, 1
    for run in runs:
        longest = max(longest, run)
        lost += run + longest
        longest *= 2
    return lost, longest


def compress(names: np.ndarray, length: np.ndarray, owner: np.ndarray, runs: tuple[int, ...] = RUN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after the rounds: their names, lengths in words and texts."""
    for turn, run in enumerate(runs):
        if len(names) < 2:
            break
        new = np.ones(len(names), dtype=bool)
        new[1:] = (names[1:] != names[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        k = np.diff(np.concatenate((first, [len(names)])))
        whole = (k > 1) & (k * length[first] <= run)
        if whole.any():
            keep = new | ~np.repeat(whole, k)
            names, length = names.copy(), length.copy()
            names[first[whole]] = mix2(names[first[whole]], (k[whole] + 1000 * (turn + 1)).astype(np.uint64))
            length[first[whole]] *= k[whole]
            names, length, owner = names[keep], length[keep], owner[keep]
        right = (mix(names + np.uint64(turn + 1)) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(names), dtype=bool)
        pair[:-1] = ~right[:-1] & right[1:] & (owner[1:] == owner[:-1])
        at = np.flatnonzero(pair)
        names, length = names.copy(), length.copy()
        names[at] = mix2(names[at], names[at + 1])
        length[at] += length[at + 1]
        keep = np.ones(len(names), dtype=bool)
        keep[at + 1] = False
        names, length, owner = names[keep], length[keep], owner[keep]
    return names, length, owner


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Where the least value of each closed range lies (leftmost of equals)."""
    size = high - low + 1
    level = np.frexp(size)[1] - 1
    tables = [np.arange(len(values), dtype=np.int32)]
    for j in range(int(level.max(initial=0))):
        prev, step = tables[-1], 1 << j
        a, b = prev[:-step], prev[step:]
        tables.append(np.where(values[b] < values[a], b, a).astype(np.int32))
    out = np.empty(len(low), dtype=np.int64)
    for j in np.unique(level):
        rows = np.flatnonzero(level == j)
        a, b = tables[j][low[rows]], tables[j][high[rows] - (1 << int(j)) + 1]
        out[rows] = np.where(values[b] < values[a], b, a)
    return out


def word_cells(window: int, runs: tuple[int, ...]):
    """Anchors of word texts: the least inner symbol of every window."""
    edge, _ = margin(runs)

    def cells(texts: Texts) -> Cells:
        none = np.zeros(0, dtype=np.int64)
        empty = Cells(none, none.view(np.uint64), none.view(np.uint64), none, none)
        words = texts.words()
        owner = words.owner()
        if len(owner) < window:
            return empty
        plain = words.hashes(texts.data)
        starts = np.flatnonzero(owner[: len(owner) - window + 1] == owner[window - 1 :])
        if not len(starts):
            return empty
        names, length, _ = compress(plain, np.ones(len(plain), dtype=np.int64), owner, runs)
        begin = np.concatenate(([0], np.cumsum(length)))  # symbol borders, in words
        # first symbol at or after s+edge, last that ends by s+window-edge
        border = np.zeros(len(plain) + 1, dtype=np.int64)
        border[begin] = 1
        count = np.cumsum(border)  # borders up to and including each word
        low = count[starts + edge] - border[starts + edge]
        high = count[starts + window - edge] - 2
        best = least_between(names, low, high)
        own = owner[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (best[1:] != best[:-1]) | (own[1:] != own[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(starts)])) - 1
        lo, hi, anchor, text = starts[first], starts[last], best[first], own[first]
        cell = Prefix(plain).spans(lo, hi + window)
        cell = mix2(cell, ((begin[anchor] - lo) * (2 * window) + hi - lo).view(np.uint64))
        base = words.first[text]
        return Cells(text, names[anchor], cell, lo - base, hi - base)

    return cells


def word_windows(window: int):
    """Names of all windows of words, and where each text's words begin."""

    def names(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        words = texts.words()
        return Prefix(words.hashes(texts.data)).windows(window), words.first[:-1]

    return names


def _results(with_text: bool):
    schema = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("n_spans", pa.int64())]
    schema = pa.schema(schema + ([("kept", pa.string())] if with_text else []))

    def run(batches):
        for part in chunks(batches, "text"):
            texts = texts_of(part.column("text"))
            words = texts.words()
            gone = _span_flags(part, words.first[:-1], len(words.starts))
            left = np.flatnonzero(~gone)
            owner = words.owner()[left]
            data = texts.data.copy()
            edge = np.zeros(len(data) + 1, dtype=np.int8)
            np.add.at(edge, words.starts[left], 1)
            np.add.at(edge, words.ends[left], -1)
            keep = np.cumsum(edge[:-1]).astype(bool)
            # a kept word that isn't its text's first keeps the separator before it, as a space
            joined = np.ones(len(left), dtype=bool)
            joined[:1] = False
            joined[1:] = owner[1:] == owner[:-1]
            spaces = words.starts[left[joined]] - 1
            keep[spaces] = True
            data[spaces] = 0x20
            kept = data[keep]
            offsets = np.concatenate(([0], np.cumsum(texts.counts(keep))))
            removed = np.bincount(words.owner()[gone], minlength=len(texts)).astype(np.int64)
            more = [pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))])] if with_text else []
            yield record(schema, part.column("doc"), words.counts, removed, digests(kept, offsets), runs_per_text(gone, words.first), *more)

    return run


def remove_passages(documents: DataFrame, *, window: int = WINDOW, runs: tuple[int, ...] = RUN_WORDS, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that also occurs
    in a document with a smaller ``doc_id``.

    ``documents`` has ``doc_id`` and ``text``; other columns are ignored. Returns
    ``doc_id, n_words, n_removed, kept_sha256, n_spans`` and with ``with_text`` the
    kept words joined by single spaces as ``kept``.

    A null text has no words. A row without doc_id is left out; rows that repeat a
    doc_id count as one document, the one with the smallest text. An empty table
    gives an empty result. Repeats inside one document alone stay.
    """
    lost, longest = margin(runs)
    if window - 2 * lost < 2 * longest - 1:
        raise ValueError("these rounds leave no symbol that is surely inside a window")
    docs = keyed(documents)
    spans = seen_earlier(docs, window, word_cells(window, runs), word_windows(window), within=False)
    return with_texts(docs, spans, _results(with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long" + ", kept string" * with_text)


def op8_substring_recompression(spark, sf_dir: str) -> DataFrame:
    """Words of all documents covered by 50-word windows of earlier documents."""
    return remove_passages(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
