"""N-gram Jaccard self-join over count vectors.

A document is the set of its shingle hashes. The hash range is cut into groups: 64
for the point of a document (its count of shingles in each group) and about n / 3
for its tiles. The overlap of two sets is at most the sum of the smaller counts of
each group, for two points as for the bounding boxes of two pages of points.

Linked sets differ in at most D shingles (:func:`most_apart`), so among the first
D + 1 groups that either holds, in any fixed order, one has the very same content
in both. These tiles are the top of the tree: documents meet only in a tile. Groups
whose content very many documents share come last in the order, so a passage that a
third of all documents hold isn't a meeting place. The order changes no result.

1. Equal sets are one class; the rest works on one document of each.
2. In each tile the document with most copies is the pivot. Each document is
   verified against the pivot that it meets most often; components follow.
3. Tiles that still hold several components go on with wide points. Tiles with the same
   members are one, so a pair of documents is compared once, not once in each of the many
   groups that it shares. Points of different components are compared page by page, and
   the pairs within the bound are verified. What is left out is connected already or can't
   be linked, so the components are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._components import components
from ._flat import LOWER, Prefix, Texts, chunks, group_starts, mix, mix2, parts, record, texts_of, trimmed
from ._shared import one_row_per_id, sendable, written

WORDS = 4
NUM, DEN = 85, 100  #: similarity of a link
POINT_BITS = 6  #: 64 coordinates
WIDE_BITS = 10  #: 1,024 coordinates, for the documents of open tiles and for pairs to verify
SMALL = 64  #: sets below it share one level with 256 groups
HOT_SHARE, HOT_LEAST, HOT_MOST = 1e-4, 64, 1_000_000  #: when a tile counts as hot; these order groups only
PAGE = 256
PAIRS = 4096  #: pairs of points compared at once
VERIFY_VALUES = 1 << 19  #: shingles of the pairs compared at once


def shingle_sets(texts: Texts, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in one array, and the text of
    each. A text with fewer words has its whole sequence as its one shingle."""
    data = LOWER[texts.data]
    w = texts.words()
    prefix = Prefix(w.hashes(data))
    owner = w.owner()
    start = np.flatnonzero(owner[: max(0, len(owner) - words + 1)] == owner[words - 1 :])
    names, text = prefix.spans(start, start + words), owner[start]
    short = np.flatnonzero((w.counts > 0) & (w.counts < words))
    if len(short):
        names = np.concatenate((names, prefix.spans(w.first[short], w.first[short + 1])))
        text = np.concatenate((text, short.astype(text.dtype)))
    order = np.lexsort((names, text))
    names, text = names[order], text[order]
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[1:] != names[:-1]) | (text[1:] != text[:-1])
    return names[new], text[new]


def most_apart(n, num: int = NUM, den: int = DEN):
    """Most shingles in which a set of n can differ from a linked set."""
    # |A ^ B| <= (a + b)(1 - s) / (1 + s), and b <= a / s
    return (n * (den + num) * (den - num)) // (num * (den + num))


def _levels(n: np.ndarray) -> np.ndarray:
    """log2 of the number of groups of a set of n."""
    return np.where(n < SMALL, 8, np.frexp(np.maximum(n, 1))[1] - 2)


def _tokens(names: np.ndarray, text: np.ndarray, n: np.ndarray, level: np.ndarray):
    """Content names of the non-empty groups of each text at its level, with the
    text of each; groups come in order of their number."""
    own = level[text]
    group = names >> (64 - own).astype(np.uint64)
    new = np.ones(len(names), dtype=bool)
    new[1:] = (group[1:] != group[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    content = np.add.reduceat(mix(names), first) if len(first) else names[:0]
    return mix2(content, group[first] * np.uint64(64) + own[first].astype(np.uint64)), text[first]


def _both_levels(names, text, n, num, den):
    """Tokens at each text's level, and one level down where a linked set could
    be just below the border."""
    level = _levels(n)
    yield _tokens(names, text, n, level)
    lower = _levels(-(-n * num // den))  # of the smallest set that could be linked
    down = lower != level
    if down.any():
        some = down[text]
        if some.any():
            yield _tokens(names[some], text[some], n, lower)


def _set_rows(words: int, num: int, den: int):
    """Per document its set's size, two sums that identify it and its point; and
    tokens that a chunk holds twice or more, with their counts."""
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("point", pa.binary()), ("token", pa.int64()), ("held", pa.int64())])

    def run(batches):
        for part in chunks(batches, "text"):
            names, text = shingle_sets(texts_of(part.column("text")), words)
            docs = part.num_rows
            n = np.bincount(text, minlength=docs)
            ends = np.concatenate(([0], np.cumsum(n)))
            sums = []
            for salt in (1, 2):
                s = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(names + np.uint64(salt)))))
                sums.append(s[ends[1:]] - s[ends[:-1]])
            none = pa.nulls(docs, pa.int64())
            yield record(schema, part.column("doc"), n, *sums, _as_points(names, text, docs, POINT_BITS), none, none)
            unique = np.unique(mix2(*sums), return_index=True)[1]
            first = np.zeros(docs, dtype=bool)
            first[unique] = True
            tokens = [t[first[x]] for t, x in _both_levels(names, text, n, num, den)]
            token, held = np.unique(np.concatenate(tokens), return_counts=True)
            token, held = token[held > 1], held[held > 1]
            none = pa.nulls(len(token), pa.int64())
            yield record(schema, none, none, none, none, pa.nulls(len(token), pa.binary()), token, held)

    return trimmed(run)


def _tile_rows(words: int, num: int, den: int, hot):
    schema = pa.schema([("tile", pa.int64()), ("doc", pa.int64())])

    def run(batches):
        late = hot.value
        for part in chunks(batches, "text"):
            names, text = shingle_sets(texts_of(part.column("text")), words)
            n = np.bincount(text, minlength=part.num_rows)
            apart = most_apart(n, num, den)
            # equal sets in a chunk need one of them only
            ends = np.concatenate(([0], np.cumsum(n)))
            s = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(names + np.uint64(1)))))
            wanted = np.zeros(part.num_rows, dtype=bool)
            wanted[np.unique(mix2(s[ends[1:]] - s[ends[:-1]], n.astype(np.uint64)), return_index=True)[1]] = True
            wanted &= apart > 0  # others are linked to equal sets only
            some = wanted[text]
            ids = part.column("doc").to_numpy()
            for token, own in _both_levels(names[some], text[some], n, num, den):
                at = np.minimum(np.searchsorted(late, token), max(len(late) - 1, 0))
                is_hot = late[at] == token if len(late) else np.zeros(len(token), dtype=bool)
                order = np.lexsort((is_hot, own))
                token, own = token[order], own[order]
                start = group_starts(own)
                rank = np.arange(len(own)) - np.repeat(start, np.diff(np.concatenate((start, [len(own)]))))
                keep = rank <= apart[own]
                yield record(schema, token[keep], ids[own[keep]])

    return trimmed(run)


def _bound_rows(num: int, den: int, bits: int = POINT_BITS):
    """Of candidate pairs with their points, those whose bound allows a link."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        for part in parts(batches, lambda batch: np.full(batch.num_rows, 1 << bits), VERIFY_VALUES):
            p, q = _points(part.column("pa"), bits), _points(part.column("pb"), bits)
            na, nb = part.column("na").to_numpy(), part.column("nb").to_numpy()
            ok = (num + den) * np.minimum(p, q).sum(axis=1, dtype=np.int64) >= num * (na + nb)
            yield record(schema, part.column("a").to_numpy()[ok], part.column("b").to_numpy()[ok])

    return trimmed(run)


def _as_points(names: np.ndarray, text: np.ndarray, docs: int, bits: int) -> list[bytes]:
    """The count vector of each text: a byte per coordinate where all fit, else four."""
    cell = text.astype(np.int64) << bits | (mix(names) >> np.uint64(64 - bits)).astype(np.int64)
    rows = np.bincount(cell, minlength=docs << bits).reshape(docs, 1 << bits)
    return [x.astype("u1" if x.max() < 256 else "<u4").tobytes() for x in rows]


def _points(column: pa.Array, bits: int = POINT_BITS) -> np.ndarray:
    """The count vectors of a column, a row each; in bytes if all fit."""
    texts = texts_of(column)
    small = texts.lengths == 1 << bits
    if small.all():
        return texts.data.reshape(-1, 1 << bits)
    out = np.empty((len(texts), 1 << bits), dtype=np.uint32)
    raw = texts.data[np.repeat(small, texts.lengths)]
    out[small] = raw.reshape(-1, 1 << bits)
    if not small.all():
        raw = texts.data[np.repeat(~small, texts.lengths)]
        out[~small] = np.frombuffer(raw.tobytes(), dtype="<u4").reshape(-1, 1 << bits)
    return out


def _page_pairs(num: int, den: int):
    """Candidate pairs of rows sorted by tile and size: different components,
    and a bound that allows a link. Holds the rows of one tile at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def near(doc, comp, n, point, i, j):
        ok = (comp[i] != comp[j]) & (num * n[j] <= den * n[i])
        i, j = i[ok], j[ok]
        ok = (num + den) * np.minimum(point[i], point[j]).sum(axis=1, dtype=np.int64) >= num * (n[i] + n[j])
        return doc[i[ok]], doc[j[ok]]

    def work(tile, doc, comp, n, point):
        start = group_starts(tile)
        size = np.diff(np.concatenate((start, [len(tile)])))
        left = np.repeat(start + size, size) - np.arange(len(tile))  # rows of the tile from here on
        small = np.repeat(size, size) <= 16
        for step in range(1, 16):
            i = np.flatnonzero(small & (left > step))
            if not len(i):
                break
            for x in range(0, len(i), PAIRS):
                yield near(doc, comp, n, point, i[x : x + PAIRS], i[x : x + PAIRS] + step)
        for s, m in zip(start[size > 16].tolist(), size[size > 16].tolist(), strict=True):
            pages = [(x, min(x + PAGE, s + m)) for x in range(s, s + m, PAGE)]
            top = [point[a:b].max(axis=0) for a, b in pages]
            for u, (a, b) in enumerate(pages):
                for v in range(u, len(pages)):
                    c, d = pages[v]
                    if num * n[c] > den * n[b - 1] or (num + den) * int(np.minimum(top[u], top[v]).sum(dtype=np.int64)) < num * (n[a] + n[c]):
                        continue
                    # 256 x 256 points by slices, to keep the temporary arrays small
                    for x in range(a, b, PAIRS // PAGE):
                        i, j = np.meshgrid(np.arange(x, min(x + PAIRS // PAGE, b)), np.arange(c, d), indexing="ij")
                        keep = i < j
                        yield near(doc, comp, n, point, i[keep], j[keep])

    def run(batches):
        held = None
        for part in batches:
            if not part.num_rows:
                continue
            new = [part.column(c).to_numpy() for c in ("tile", "doc", "comp", "n")] + [_points(part.column("point"), WIDE_BITS)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1]))  # the last tile may go on
            if cut:
                for a, b in work(*[x[:cut] for x in held]):
                    yield record(schema, np.minimum(a, b), np.maximum(a, b))
                held = [x[cut:] for x in held]
        if held is not None:
            for a, b in work(*held):
                yield record(schema, np.minimum(a, b), np.maximum(a, b))

    return trimmed(run)


def _wide_rows(words: int):
    """The size and wide point of each document."""
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("point", pa.binary())])

    def run(batches):
        for part in chunks(batches, "text"):
            names, text = shingle_sets(texts_of(part.column("text")), words)
            yield record(schema, part.column("doc"), np.bincount(text, minlength=part.num_rows), _as_points(names, text, part.num_rows, WIDE_BITS))

    return trimmed(run)


def _sets(words: int):
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("point", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(batches):
        for part in chunks(batches, "text"):
            names, text = shingle_sets(texts_of(part.column("text")), words)
            n = np.bincount(text, minlength=part.num_rows)
            ends = np.concatenate(([0], np.cumsum(n)))
            yield record(schema, part.column("doc"), n, _as_points(names, text, part.num_rows, WIDE_BITS), pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(names.view(np.int64))))

    return trimmed(run)


def _verified(num: int, den: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def weight(part):
        return sum(np.diff(part.column(c).offsets.to_numpy()) for c in ("sa", "sb"))

    def run(batches):
        for part in parts(batches, weight, VERIFY_VALUES):
            # every row's two sets sorted together: equal neighbours are the overlap
            row, value, size = [], [], []
            for c in ("sa", "sb"):
                lists = part.column(c)
                size.append(np.diff(lists.offsets.to_numpy()))
                row.append(np.repeat(np.arange(part.num_rows), size[-1]))
                value.append(lists.flatten().to_numpy())
            row, value = np.concatenate(row), np.concatenate(value)
            order = np.lexsort((value, row))
            row, value = row[order], value[order]
            both = np.bincount(row[1:][(row[1:] == row[:-1]) & (value[1:] == value[:-1])], minlength=part.num_rows)
            ok = den * both >= num * (size[0] + size[1] - both)
            yield record(schema, part.column("a").to_numpy()[ok], part.column("b").to_numpy()[ok])

    return trimmed(run)


def _with_points(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs with both sides' sizes and points."""
    side = lambda c: points.select(F.col("doc").alias(c), F.col("n").alias(f"n{c}"), F.col("point").alias(f"p{c}"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", "pa", "pb")


def _links(pairs: DataFrame, docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """The pairs that are links by their whole sets."""
    ids = written(pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct())
    sets = written(docs.join(sendable(ids), "doc", "left_semi").select("doc", "text").mapInArrow(_sets(words), "doc long, n long, point binary, shingles array<long>"))
    # a wide point is far smaller than a long document's set: few pairs need the sets
    near = written(_with_points(pairs, sets).mapInArrow(_bound_rows(num, den, WIDE_BITS), "a long, b long"))
    both = (
        near.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("sb")), "b")
        .join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("sa")), "a")
        .select("a", "b", "sa", "sb")
    )
    return both.mapInArrow(_verified(num, den), "a long, b long")


def jaccard_groups(documents: DataFrame, *, words: int = WORDS, num: int = NUM, den: int = DEN) -> DataFrame:
    """Group documents whose sets of ``words``-word shingles (A-Z lowered) have a
    Jaccard similarity of at least ``num / den``, directly or through others.

    Returns ``doc_id, n_shingles, component_id`` (the least doc_id reachable by
    links, itself included).

    A text with fewer words is one shingle as a whole; a null text, or one without
    words, has an empty set and is linked with nothing. A row without doc_id is
    left out; rows that repeat a doc_id count as one document, the one with the
    smallest text. Other columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    rows = one_row_per_id(documents.select("doc_id", "text"), "doc_id", "text")
    docs = rows.select(F.col("doc_id").cast("long").alias("doc"), "text")
    found = written(docs.mapInArrow(_set_rows(words, num, den), "doc long, n long, k1 long, k2 long, point binary, token long, held long"))
    sets = found.filter("doc is not null").select("doc", "n", "k1", "k2", "point")
    least = max(HOT_LEAST, int(HOT_SHARE * sets.count()))
    held = found.filter("doc is null").groupBy("token").agg(F.sum("held").alias("held")).filter(F.col("held") >= least)
    tokens = [r["token"] for r in held.orderBy(F.desc("held"), "token").limit(HOT_MOST).select("token").collect()]
    hot = spark.sparkContext.broadcast(np.sort(np.array(tokens, dtype=np.int64).view(np.uint64)))

    same = ["n", "k1", "k2"]
    classes = written(sets.filter("n > 0").groupBy(*same).agg(F.min("doc").alias("rep"), F.count("*").alias("copies")))
    members = sets.select("doc", *same).join(classes, same, "left").select("doc", "n", F.coalesce("rep", "doc").alias("rep"))
    # only copies and their representatives need a look-up; all others stand for themselves
    copied = written(members.join(classes.filter("copies > 1").select("rep", "copies"), "rep").select("doc", "rep", "copies"))
    points = sets.join(classes.select(F.col("rep").alias("doc")), "doc", "left_semi").select("doc", "n", "point")

    tiles = docs.mapInArrow(_tile_rows(words, num, den, hot), "tile long, doc long")
    tile = Window.partitionBy("tile")
    shared = tiles.withColumns({"x": F.min("doc").over(tile), "y": F.max("doc").over(tile)}).filter("x <> y").select("tile", "doc")
    # equal sets met in different chunks become one; the pivot has most copies. If the
    # look-up is broadcast, all of this keeps the partitioning by tile.
    one = (
        shared.join(sendable(copied), "doc", "left")
        .groupBy("tile", F.coalesce("rep", "doc").alias("doc")).agg(F.coalesce(F.first("copies"), F.lit(1)).alias("copies"))
    )
    top = F.max(F.struct("copies", (-F.col("doc")).alias("less"))).over(tile)
    meets = written(one.withColumns({"others": F.count("*").over(tile), "top": top}).filter("others > 1").select("tile", "doc", (-F.col("top.less")).alias("pivot")))

    stars = meets.filter("doc <> pivot").groupBy("doc", "pivot").count()
    best = stars.groupBy("doc").agg(F.max(F.struct("count", (-F.col("pivot")).alias("less"))).alias("top")).select(F.col("doc").alias("b"), (-F.col("top.less")).alias("a"))
    first = written(_with_points(best, points).mapInArrow(_bound_rows(num, den), "a long, b long"))
    links = written(_links(first, docs, words, num, den))

    groups = written(components(links).withColumnRenamed("node", "doc"))
    known = meets.select("tile", "doc").join(sendable(groups), "doc", "left").select("tile", "doc", F.coalesce("component", "doc").alias("comp"))
    # a tile's name is now the hash of its members: tiles of the same ones fall together
    whole = {"x": F.min("comp").over(tile), "y": F.max("comp").over(tile), "members": F.expr("bit_xor(xxhash64(doc))").over(tile)}
    open_ = written(known.withColumns(whole).filter("x <> y").select(F.col("members").alias("tile"), "doc", "comp").distinct())
    ids = written(open_.select("doc").distinct())
    wide = written(docs.join(sendable(ids), "doc", "left_semi").select("doc", "text").mapInArrow(_wide_rows(words), "doc long, n long, point binary"))
    rows = open_.join(wide, "doc").select("tile", "doc", "comp", "n", "point")
    pairs = written(rows.repartition(F.col("tile")).sortWithinPartitions("tile", "n", "doc").mapInArrow(_page_pairs(num, den), "a long, b long").distinct())
    tested = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(pairs.join(tested, ["a", "b"], "left_anti"))
    groups = components(links.union(written(_links(pairs, docs, words, num, den))))
    return (
        members.join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
    )


def op4_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Groups of all documents at a Jaccard similarity of 0.85 of 4-word shingles."""
    return jaccard_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
