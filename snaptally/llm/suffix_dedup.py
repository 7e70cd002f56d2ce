"""Exact removal of repeated byte strings by anchors; this takes the place of
bucket-pointer refinement.

Every byte position has a bucket: the hash of the q bytes that start there. In each
window of ``length`` bytes the position with the least bucket is its anchor, so equal
strings choose the same position, one in about (length - q) / 2. Anchors are dealt by
bucket; what the windows of an anchor cover has one chained hash of the buckets at
p, p+q, p+2q, ..., and where those differ, windows of ``length`` bytes are compared by
their hashes. Nothing is sorted on the bucket ids of later offsets: that would shuffle
every position in every round, where anchors are one in 35. See :mod:`_repeats` for the
distributed part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._flat import BYTE_VALUE, Prefix, Texts, chunks, mix2, record, texts_of
from ._repeats import Cells, _span_flags, digests, keyed, runs_per_text, seen_earlier, with_texts

LENGTH = 100
Q = 32


def least_positions(values: np.ndarray, span: int) -> np.ndarray:
    """For each start, where the least of the next ``span`` values lies (the
    leftmost of equals)."""
    at = np.arange(len(values), dtype=np.int64)
    best, reach = values, 1
    while reach < span:
        step = min(reach, span - reach)
        left, right = best[:-step], best[step:]
        take = right < left
        at = np.where(take, at[step:], at[:-step])
        best = np.where(take, right, left)
        reach += step
    return at


def byte_cells(length: int, q: int):
    """Anchors of byte texts: least q-gram buckets of every window."""

    def cells(texts: Texts) -> Cells:
        none = np.zeros(0, dtype=np.int64)
        data, offsets = texts.data, texts.offsets
        if len(data) < length:
            return Cells(none, none.view(np.uint64), none.view(np.uint64), none, none)
        bucket = Prefix(BYTE_VALUE[data]).windows(q)
        at = least_positions(bucket, length - q + 1)[: len(data) - length + 1]
        owner = texts.owner()
        starts = np.flatnonzero(owner[: len(at)] == owner[length - 1 : length - 1 + len(at)])
        if not len(starts):
            return Cells(none, none.view(np.uint64), none.view(np.uint64), none, none)
        at, own = at[starts], owner[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (own[1:] != own[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(starts)])) - 1
        lo, hi, anchor, text = starts[first], starts[last], at[first], own[first]
        # refine: the bucket names at lo, lo+q, ... up to the last q bytes of the cell
        end = hi + length - q
        name = mix2(bucket[anchor], ((anchor - lo) * (2 * length) + hi - lo).view(np.uint64))
        place, todo = lo.copy(), np.arange(len(lo))
        while len(todo):
            name[todo] = mix2(name[todo], bucket[place[todo]])
            todo = todo[place[todo] < end[todo]]
            place[todo] = np.minimum(place[todo] + q, end[todo])
        base = offsets[text]
        return Cells(text, bucket[anchor], name, lo - base, hi - base)

    return cells


def byte_windows(length: int):
    """Names of all windows of ``length`` bytes, and where each text begins."""

    def names(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        return Prefix(BYTE_VALUE[texts.data]).windows(length), texts.offsets[:-1]

    return names


def _results(with_text: bool):
    schema = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema(schema + ([("kept", pa.binary())] if with_text else []))

    def run(batches):
        for part in chunks(batches, "text"):
            texts = texts_of(part.column("text"))
            gone = _span_flags(part, texts.offsets[:-1], len(texts.data))
            kept = texts.data[~gone]
            removed = texts.counts(gone)
            offsets = np.concatenate(([0], np.cumsum(texts.lengths - removed)))
            more = [pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))])] if with_text else []
            yield record(schema, part.column("doc"), texts.lengths, removed, runs_per_text(gone, texts.offsets), digests(kept, offsets), *more)

    return run


def remove_repeats(documents: DataFrame, *, length: int = LENGTH, q: int = Q, with_text: bool = False) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts
    earlier: in a document with a smaller ``doc_id``, or earlier in the same one.

    ``documents`` has ``doc_id`` and ``text``; other columns are ignored. Strings are
    judged on the input and never cross documents; overlapping occurrences count.
    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and with
    ``with_text`` the remaining bytes ``kept`` (a cut may split a character).

    A null text counts as empty. A row without doc_id has no place in the order and
    is left out. Rows that repeat a doc_id count as one document, the one with the
    smallest text. An empty table gives an empty result.
    """
    if not 1 < q < length:
        raise ValueError("q must lie between 1 and length")
    docs = keyed(documents)
    spans = seen_earlier(docs, length, byte_cells(length, q), byte_windows(length), within=True)
    return with_texts(docs, spans, _results(with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text)


def op5_suffix_array_dedup(spark, sf_dir: str) -> DataFrame:
    """Bytes of all documents covered by 100-byte strings that start earlier."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("text")))
