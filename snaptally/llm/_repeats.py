"""Which windows of W symbols were seen earlier: the part that the byte form
(:mod:`suffix_dedup`) and the word form (:mod:`recompression`) share.

Each form picks *anchors*: places chosen by content alone, so that two equal
windows hold the same anchor at the same offset. An anchor has a bucket (the name
of its symbols) and a cell (the name of everything that its windows cover).

1. Anchors are dealt by bucket. A cell that occurred earlier settles all its
   windows at once. Within a chunk of texts the repeats are settled before the
   shuffle, so a passage held by a third of all documents sends one row per chunk.
2. Only buckets with several different cells go on: their windows are compared one
   by one. A bucket with more than ``hot`` open cells is dealt by window instead
   of by bucket, so it spreads over all tasks; the comparison is the same.

Buckets that very many documents share are dealt by bucket and cell from the start and
count as open. A bounded sample of documents names them; it steers where rows go and
changes no result.

Everything is sorted streams and joins on document ids; no group is gathered whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._flat import Texts, chunks, group_starts, mix2, record, texts_of
from ._shared import one_row_per_id, written

HOT_BUCKET = 20_000  #: open cells of a bucket from which it is dealt by window

HOT_SAMPLE = 100_000  #: documents sampled for buckets that many documents share
HOT_SHARE, HOT_LEAST, HOT_MOST = 1e-3, 64, 100_000

_ANCHORS = pa.schema([("key", pa.int64()), ("bucket", pa.int64()), ("cell", pa.int64()), ("doc", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("sure", pa.bool_())])
_OPEN = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("lo", pa.int64()), ("names", pa.list_(pa.int64()))])
_SPANS = pa.schema([("doc", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])


class Cells:
    """Anchors of a chunk of texts. ``lo``/``hi``: the first and last window start
    that the anchor stands for, counted from the text's start."""

    def __init__(self, text: np.ndarray, bucket: np.ndarray, cell: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        self.text, self.bucket, self.cell, self.lo, self.hi = text, bucket, cell, lo, hi


def _union(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of each document joined."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    firsts = group_starts(doc)
    # running maximum of hi within each document: lift each document above the last
    lift = np.zeros(len(doc), dtype=np.int64)
    lift[firsts] = 1
    lift = (np.cumsum(lift) - 1) * (int(hi.max()) + 2)
    reach = np.maximum.accumulate(hi + lift)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (lo + lift)[1:] > reach[:-1]
    starts = np.flatnonzero(new)
    ends = np.concatenate((starts[1:], [len(doc)])) - 1
    return doc[starts], lo[starts], (reach - lift)[ends]


def _shared_buckets(docs: DataFrame, cells_of):
    """Sorted buckets that at least one in a thousand of the sampled documents hold."""
    k = max(1, -(-docs.count() // HOT_SAMPLE))

    def run(batches):
        schema = pa.schema([("bucket", pa.int64()), ("held", pa.int64())])
        for part in chunks(batches, "text"):
            c = cells_of(texts_of(part.column("text")))
            each = np.unique(np.stack((c.bucket, c.cell)), axis=1)[0] if len(c.bucket) else c.bucket
            bucket, held = np.unique(each, return_counts=True)
            yield record(schema, bucket[held > 1], held[held > 1])

    sample = docs.filter(F.pmod(F.xxhash64("doc"), F.lit(k)) == 0).select("doc", "text")
    least = max(HOT_LEAST, int(HOT_SHARE * HOT_SAMPLE)) if k > 1 else HOT_LEAST
    held = sample.mapInArrow(run, "bucket long, held long").groupBy("bucket").agg(F.sum("held").alias("held")).filter(F.col("held") >= least)
    rows = held.orderBy(F.desc("held"), "bucket").limit(HOT_MOST).select("bucket").collect()
    return np.sort(np.array([r["bucket"] for r in rows], dtype=np.int64).view(np.uint64))


def _anchor_rows(cells_of: Callable[[Texts], Cells], width: int, within: bool, shared):
    """Anchors with the repeats inside a chunk settled. ``within``: an earlier
    start in the same document counts as well. Rows of shared buckets carry the
    bucket and are keyed by bucket and cell, the others by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = shared.value
        for part in chunks(batches, "text"):
            ids = part.column("doc").to_numpy()
            c = cells_of(texts_of(part.column("text")))
            if not len(c.text):
                continue
            doc = ids[c.text]
            order = np.lexsort((c.lo, doc, c.cell, c.bucket))
            bucket, cell, doc, lo, hi = c.bucket[order], c.cell[order], doc[order], c.lo[order], c.hi[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (cell[1:] != cell[:-1])
            firsts = np.flatnonzero(new)
            sizes = np.diff(np.concatenate((firsts, [len(doc)])))
            sure = ~new if within else doc > np.repeat(doc[firsts], sizes)
            d, a, b = _union(doc[sure], lo[sure], hi[sure] + width)
            if len(d):
                # settled already: the key only spreads the rows
                key = mix2(d.view(np.uint64), a.view(np.uint64))
                yield record(_ANCHORS, key, pa.nulls(len(d), pa.int64()), key, d, a, b, np.ones(len(d), dtype=bool))
            rest = ~sure
            bucket, cell = bucket[rest], cell[rest]
            spread = many[np.minimum(np.searchsorted(many, bucket), len(many) - 1)] == bucket if len(many) else np.zeros(len(bucket), dtype=bool)
            key = bucket.copy()
            key[spread] = mix2(bucket[spread], cell[spread])
            yield record(_ANCHORS, key, pa.array(bucket.view(np.int64), mask=~spread), cell, doc[rest], lo[rest], hi[rest], np.zeros(len(key), dtype=bool))

    return run


def _open_rows(names_of: Callable[[Texts], tuple[np.ndarray, np.ndarray]]):
    """The window names of open cells; one row per window for hot buckets.

    ``names_of`` gives the names of all windows by global start, and where each
    text's symbols begin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            opened = part.column("opened")
            some = np.flatnonzero(opened.is_valid().to_numpy(zero_copy_only=False))
            if not len(some):
                continue
            part = part.take(pa.array(some))
            opened = part.column("opened")
            cells = opened.flatten()
            text = np.repeat(np.arange(part.num_rows), np.diff(opened.offsets.to_numpy()))
            bucket = cells.field("bucket").to_numpy().view(np.uint64)
            lo, hi = cells.field("lo").to_numpy(), cells.field("hi").to_numpy()
            hot = cells.field("hot").to_numpy(zero_copy_only=False).astype(bool)
            doc = part.column("doc").to_numpy()[text]
            names, begin = names_of(texts_of(part.column("text")))
            n = hi - lo + 1
            at = np.repeat(begin[text] + lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))
            name = mix2(np.repeat(bucket, n), names[at])
            cool = ~np.repeat(hot, n)
            m = n[~hot]
            lists = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(m))).astype(np.int32), pa.array(name[cool].view(np.int64)))
            if len(m):
                yield record(_OPEN, bucket[~hot], doc[~hot], lo[~hot], lists)
            if hot.any():
                k = int((~cool).sum())
                start = (np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum())))[~cool]
                one = name[~cool]
                yield record(_OPEN, one, np.repeat(doc, n)[~cool], start, pa.ListArray.from_arrays(np.arange(k + 1, dtype=np.int32), pa.array(one.view(np.int64))))

    return run


def _seen_rows(width: int, within: bool):
    """From open rows sorted by key, document and start: the ranges whose windows
    were seen earlier. Between batches it keeps one row per window of one key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, dtype=np.int64)] * 3  # key, name, first document
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("names")
            n = np.diff(lists.offsets.to_numpy())
            name = lists.flatten().to_numpy()
            key = np.repeat(batch.column("key").to_numpy(), n)
            doc = np.repeat(batch.column("doc").to_numpy(), n)
            lo = batch.column("lo").to_numpy()
            start = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(len(name))
            old = len(kept[0])
            key, name, doc = np.concatenate((kept[0], key)), np.concatenate((kept[1], name)), np.concatenate((kept[2], doc))
            start = np.concatenate((np.full(old, -1), start))
            # rows come in document order within a key; kept ones lie before them
            order = np.lexsort((start, doc, name, key))
            k, w, d = key[order], name[order], doc[order]
            new = np.ones(len(k), dtype=bool)
            new[1:] = (k[1:] != k[:-1]) | (w[1:] != w[:-1])
            firsts = np.flatnonzero(new)
            seen = ~new if within else d > np.repeat(d[firsts], np.diff(np.concatenate((firsts, [len(k)]))))
            s = start[order]
            seen &= s >= 0
            spans = _union(d[seen], s[seen], s[seen] + width)
            if len(spans[0]):
                yield record(_SPANS, *spans)
            last = firsts[k[firsts] == key[-1]]
            kept = [k[last], w[last], d[last]]

    return run


def seen_earlier(docs: DataFrame, width: int, cells_of, names_of, *, within: bool, hot: int = HOT_BUCKET) -> DataFrame:
    """``doc, spans``: for each document with a window seen earlier, the sorted
    ranges ``{lo, hi}`` of symbols that such windows cover (ranges may overlap).

    ``docs`` has ``doc`` (unique, not null) and ``text``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_shared_buckets(docs, cells_of))
    anchors = docs.select("doc", "text").mapInArrow(_anchor_rows(cells_of, width, within, shared), "key long, bucket long, cell long, doc long, lo long, hi long, sure boolean")
    key = Window.partitionBy("key")
    cell = Window.partitionBy("key", "cell")
    spread = F.col("bucket").isNotNull()
    open_ = (F.col("least_cell") != F.col("most_cell")) | spread
    first = F.min(F.struct("doc", "lo")).over(cell)
    anchors = (
        anchors.withColumns({"least_cell": F.min("cell").over(key), "most_cell": F.max("cell").over(key), "held": F.count("*").over(key)})
        .withColumn("first", first)
        .withColumn("repeat", (F.struct("doc", "lo") > F.col("first")) if within else (F.col("doc") > F.col("first.doc")))
        .filter(F.col("sure") | F.col("repeat") | open_)
        .select(F.coalesce("bucket", "key").alias("bucket"), "doc", "lo", F.when(F.col("sure"), F.col("hi")).when(F.col("repeat"), F.col("hi") + width).otherwise(F.col("hi")).alias("hi"), (F.col("sure") | F.col("repeat")).alias("done"), (spread | (F.col("held") > hot)).alias("hot"))
    )
    anchors = written(anchors)
    opened = anchors.filter(~F.col("done")).groupBy("doc").agg(F.collect_list(F.struct("bucket", "lo", "hi", "hot")).alias("opened"))
    rows = docs.join(opened, "doc", "left").select("doc", "text", "opened").mapInArrow(_open_rows(names_of), "key long, doc long, lo long, names array<long>")
    late = (
        rows.repartition(F.col("key")).sortWithinPartitions("key", "doc", "lo")
        .mapInArrow(_seen_rows(width, within), "doc long, lo long, hi long")
    )
    spans = anchors.filter("done").select("doc", "lo", "hi").unionByName(late)
    return spans.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def _span_flags(part: pa.RecordBatch, begin: np.ndarray, total: int) -> np.ndarray:
    """Which symbols of the chunk are covered by the rows' spans."""
    lists = part.column("spans")
    n = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, dtype=np.int64)
    n = np.where(lists.is_valid().to_numpy(zero_copy_only=False), n, 0)
    spans = lists.flatten()
    row = np.repeat(np.arange(part.num_rows), n)
    edge = np.zeros(total + 1, dtype=np.int64)
    np.add.at(edge, begin[row] + spans.field("lo").to_numpy(), 1)
    np.add.at(edge, begin[row] + spans.field("hi").to_numpy(), -1)
    return np.cumsum(edge[:-1]) > 0


def runs_per_text(flags: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Maximal runs of flagged symbols in each text."""
    before = np.zeros(len(flags) + 1, dtype=bool)
    before[1:] = flags
    before[begin] = False
    starts = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags & ~before[:-1], out=starts[1:])
    return starts[begin[1:]] - starts[begin[:-1]]


def digests(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """SHA-256 of each slice, in hex."""
    view = memoryview(np.ascontiguousarray(data))
    return [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]


def with_texts(docs: DataFrame, spans: DataFrame, run, schema: str) -> DataFrame:
    """``run`` over ``doc, text, spans`` of every document (spans null: none)."""
    return docs.join(spans, "doc", "left").select("doc", "text", "spans").mapInArrow(run, schema)


def keyed(documents: DataFrame) -> DataFrame:
    """``doc, text`` with one row per non-null doc_id. The key isn't nullable, so
    both joins on it shuffle the same rows and can share one exchange."""
    rows = one_row_per_id(documents.select("doc_id", "text"), "doc_id", "text")
    return rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc"), "text")
