"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

The tokens of A and of B are two cuttings of one byte string. Every token points to its
farthest-right overlapping token of the other cutting: the one that holds its last byte;
a token of B whose end A shares points to itself. Successor doubling (``to = to[to]``)
brings all pointers to the last token of their component in a number of rounds that
grows with the logarithm of the longest chain. That token labels the group: the
smallest spans that both tokenizers cut at the same bytes.

Texts are worked on in *units*, runs of spaces with what follows up to the next space.
Neither tokenizer has a token over a unit's border (checked when the vocabularies are
read), so a task aligns each different unit once and puts texts together from units.

Counts of id pairs are over the whole corpus. The links of each text are written with
its row, Spark counts them, and the counts go back to the rows: the most frequent
pairs, up to a stated number, are broadcast; the rest, if there is one, is joined.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._flat import SEPARATOR, Texts, chunks, parts, release, texts_of
from ._repeats import digests
from ._shared import written

TEXT_BYTES = 1 << 20  #: texts worked on at once
KNOWN_UNITS, KNOWN_BYTES = 200_000, 16 << 20  #: what a task remembers before it starts afresh
FOUND_LINKS = 1 << 18  #: links looked up at once
JOINED_BYTES = 1 << 12  #: units encoded in one call
PAIRS_SENT = 2_000_000  #: id pairs broadcast with their counts (17 bytes each); rarer ones are joined

#: the pattern that byte_bpe_50k.json splits with
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # white space, as the pattern's \s
_LONG_SPACE = re.compile(f"[{_WHITE}]{{1000,}}")
_SPACES = tuple(c.encode() for c in map(chr, range(0x3001)) if re.match(f"[{_WHITE}]", c))

RESULTS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256", "links")


class Bytes:
    """Byte strings as one array and their borders in it."""

    def __init__(self, data: np.ndarray, borders: np.ndarray):
        self.size = np.diff(borders)
        self.array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders), pa.py_buffer(data)])

    @classmethod
    def of(cls, items: list[bytes]) -> Bytes:
        borders = np.concatenate(([0], np.cumsum([len(x) for x in items], dtype=np.int64)))
        return cls(np.frombuffer(b"".join(items), dtype=np.uint8), borders)

    @staticmethod
    def split(column: pa.LargeBinaryArray) -> list[bytes]:
        _, borders, data = column.buffers()
        borders, raw = np.frombuffer(borders, dtype=np.int64, count=len(column) + 1).tolist(), data.to_pybytes()
        return [raw[a:b] for a, b in zip(borders[:-1], borders[1:], strict=True)]

    def take(self, at: np.ndarray) -> np.ndarray:
        """The strings ``at``, one after another."""
        data = self.array.take(pa.array(at)).buffers()[2] if len(at) else None
        return np.frombuffer(data, dtype=np.uint8, count=int(self.size[at].sum())) if data is not None else np.zeros(0, dtype=np.uint8)


def labels(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token of B that ends the component of every token of A and of B. Both
    arrays rise strictly and have the same last value."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    shared = ends_a[over_b] == ends_b
    to = np.concatenate((over_a + n, np.where(shared, np.arange(len(ends_b)) + n, over_b)))
    while True:
        after = to[to]
        if np.array_equal(after, to):
            return to[:n] - n, to[n:] - n
        to = after


class Tokenizers:
    """A: a byte-level vocabulary as ranks. B: a piece vocabulary with byte fallback."""

    def __init__(self, ranks: bytes, model: bytes):
        import sentencepiece
        import tiktoken

        table = {base64.b64decode(t): int(i) for t, i in (line.split() for line in ranks.splitlines() if line)}
        self.a = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = max(table.values()) + 1
        by_id = [b""] * size
        for t, i in table.items():
            by_id[i] = t
        self.bytes_a = Bytes.of(by_id)
        pieces = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {i} goes on over a space")
            if self.b.is_byte(i):
                pieces.append(bytes([int(piece[1:-1], 16)]))
            else:
                pieces.append(b"" if self.b.is_control(i) or self.b.is_unknown(i) else piece.replace("▁", " ").encode())
        self.bytes_b = Bytes.of(pieces)
        self.space = self.b.piece_to_id("▁")
        self.digits = Bytes.of([str(i).encode() + b" " for i in range(max(size, len(pieces)))])

    def _ids_a(self, text: str) -> np.ndarray:
        # the library's pattern overflows its stack on very long white space, which is one token run up to its last character
        out, at = [], 0
        for run in _LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += [self.a.encode_ordinary(text[at : run.start()]), self.a._encode_single_piece(text[run.start() : end])]
            at = end
        out.append(self.a.encode_ordinary(text[at:]))
        return np.array([i for x in out for i in x] if len(out) > 1 else out[0], dtype=np.int64)

    def _ids_b(self, text: str) -> np.ndarray:
        # B adds the first space itself, but none to nothing
        return np.array(self.b.encode(text[1:]) if len(text) > 1 else [self.space], dtype=np.int64)

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B over all units that both give back byte for byte, and which
        these are. Units of a word each are encoded joined, since no token crosses them."""
        a, b, good = [], [], np.ones(len(units), dtype=bool)
        todo = [(0, len(units))]
        while todo:
            start, end = todo.pop()
            cut, size = start, 0
            while cut < end and (cut == start or (size + len(units[cut]) <= JOINED_BYTES and not units[cut - 1].endswith(_SPACES))):
                size += len(units[cut])
                cut += 1
            if cut < end:
                todo.append((cut, end))
            raw = b"".join(units[start:cut])
            text = raw.decode()
            ids_a, ids_b = self._ids_a(text), self._ids_b(text)
            if self.bytes_a.take(ids_a).tobytes() == raw == self.bytes_b.take(ids_b).tobytes():
                a.append(ids_a)
                b.append(ids_b)
            elif cut == start + 1:
                good[start] = False
            else:
                todo += [(i, i + 1) for i in range(cut - 1, start - 1, -1)]
        none = np.zeros(0, dtype=np.int64)
        return np.concatenate([none, *a]), np.concatenate([none, *b]), good


class Cut:
    """Aligned units. ``good``: whether both cuttings give the unit's bytes; ``n_a``,
    ``n_b``, ``n_groups``; ``text``: the groups, each ended by ``;``, up to
    ``text_ends``; ``keys``: the links, ``n_groups`` a unit (A's id in the high half)."""

    def __init__(self, tokenizers: Tokenizers, units: list[bytes]):
        a, b, self.good = tokenizers.encode(units)
        borders = np.cumsum(np.where(self.good, [len(u) for u in units], 0))
        ends_a, ends_b = np.cumsum(tokenizers.bytes_a.size[a]), np.cumsum(tokenizers.bytes_b.size[b])
        owner_a, owner_b = np.searchsorted(borders, ends_a), np.searchsorted(borders, ends_b)
        group_a, group_b = labels(ends_a, ends_b)
        last = np.flatnonzero(group_b == np.arange(len(b)))  # the token of B that ends each group
        number_a, number_b = np.searchsorted(last, group_a), np.searchsorted(last, group_b)
        closing = np.searchsorted(ends_a, ends_b[last])  # the token of A that ends it
        self.keys = a[closing] << 32 | b[last]
        # a group's tokens in order: those of A, then those of B
        place_a = np.arange(len(a)) + np.searchsorted(number_b, number_a)
        place_b = np.arange(len(b)) + np.searchsorted(number_a, number_b, side="right")
        order = np.empty(len(a) + len(b), dtype=np.int64)
        order[place_a], order[place_b] = a, b
        self.text = tokenizers.digits.take(order).copy()
        ends = np.cumsum(tokenizers.digits.size[order])
        marks = np.full(len(order), ord(","), dtype=np.uint8)
        marks[place_a[closing]], marks[place_b[last]] = ord("|"), ord(";")
        self.text[ends - 1] = marks
        self.n_a, self.n_b, self.n_groups = (np.bincount(x, minlength=len(units)) for x in (owner_a, owner_b, owner_b[last]))
        self.text_ends = np.concatenate(([0], ends))[np.cumsum(self.n_a + self.n_b)]


def spaced(texts: Texts) -> Texts:
    """Each text that isn't empty with a space before it."""
    some = texts.lengths > 0
    data = np.insert(texts.data, texts.offsets[:-1][some], np.uint8(32))
    return Texts(data, texts.offsets + np.concatenate(([0], np.cumsum(some))))


def unit_borders(texts: Texts) -> np.ndarray:
    """Starts of units and the end: texts' starts, and spaces after a character that
    isn't white space (of ASCII or of Unicode, since A takes white space together)."""
    data = texts.data
    start = np.zeros(len(data) + 1, dtype=bool)
    start[1:-1] = (data[1:] == 32) & ~SEPARATOR[data[:-1]]
    at = np.flatnonzero(start)
    one, two, three = data[at - 1], data[at - 2], data[at - 3]  # a wrapped index meets no match that matters
    odd = (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
    odd |= (three == 0xE1) & (two == 0x9A) & (one == 0x80) | (three == 0xE3) & (two == 0x80) & (one == 0x80)
    odd |= (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF)) | (three == 0xE2) & (two == 0x81) & (one == 0x9F)
    start[at[odd]] = False
    start[texts.offsets] = True
    return np.flatnonzero(start)


class Growing:
    """An array that rows are added to."""

    def __init__(self, dtype):
        self.room, self.n = np.zeros(1024, dtype=dtype), 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.room):
            room = np.zeros(max(2 * len(self.room), self.n + len(rows)), dtype=self.room.dtype)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : self.n + len(rows)] = rows
        self.n += len(rows)

    @property
    def rows(self) -> np.ndarray:
        return self.room[: self.n]


class Aligner:
    """The units that a task has met, and texts put together from them."""

    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.held = 0
        self.good, self.text = Growing(bool), Growing(np.uint8)
        self.n_a, self.n_b, self.n_groups, self.keys = (Growing(np.int64) for _ in range(4))
        self.text_at, self.keys_at = Growing(np.int64), Growing(np.int64)  # borders of units
        self.text_at.add(np.zeros(1, dtype=np.int64))
        self.keys_at.add(np.zeros(1, dtype=np.int64))

    def full(self) -> bool:
        return len(self.place) > KNOWN_UNITS or self.held > KNOWN_BYTES

    def _learn(self, units: list[bytes]) -> None:
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units)), strict=True))
        cut = Cut(self.tokenizers, units)
        self.text_at.add(self.text.n + cut.text_ends)
        self.keys_at.add(8 * (self.keys.n + np.cumsum(cut.n_groups)))
        for c in ("good", "n_a", "n_b", "n_groups", "text", "keys"):
            getattr(self, c).add(getattr(cut, c))
        self.held += sum(map(len, units)) + len(cut.text) + 8 * len(cut.keys)

    def look(self, texts: Texts) -> Look:
        """The units of a chunk of texts; new ones are aligned."""
        texts = spaced(texts)
        borders = unit_borders(texts)
        first = np.searchsorted(borders, texts.offsets)
        if len(borders) < 2:
            return Look(self, np.zeros(0, dtype=np.int64), first * 0)
        column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(borders) - 1, [None, pa.py_buffer(borders.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(texts.data))])
        coded = column.dictionary_encode()
        units = Bytes.split(coded.dictionary)
        new = [u for u in units if u not in self.place]
        if new:
            self._learn(new)
        place = np.array(list(map(self.place.__getitem__, units)), dtype=np.int64)
        return Look(self, place[coded.indices.to_numpy()], first)


class Look:
    """``at``: the place of every unit of a chunk in the task's memory; those of text
    i are ``first[i]:first[i+1]``."""

    def __init__(self, aligner: Aligner, at: np.ndarray, first: np.ndarray):
        self.aligner, self.at, self.first = aligner, at, first
        self.valid = self._sums(~aligner.good.rows) == 0
        self.live = np.repeat(self.valid, np.diff(first))  # units of texts with tokens

    def _sums(self, value: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(value[self.at], dtype=np.int64)))
        return total[self.first[1:]] - total[self.first[:-1]]

    def sums(self, value: np.ndarray) -> np.ndarray:
        """A value of units added up over each text; 0 for texts without tokens."""
        return np.where(self.valid, self._sums(value), 0)

    def forms(self) -> tuple[np.ndarray, np.ndarray]:
        """The groups of every text as bytes, and where each text's begin."""
        units = Bytes(self.aligner.text.rows, self.aligner.text_at.rows)
        out = units.take(self.at[self.live])
        size = self.sums(units.size)
        ends = np.concatenate(([0], np.cumsum(size)))
        keep = np.ones(len(out), dtype=bool)
        keep[ends[1:][size > 0] - 1] = False  # the last group's mark
        return out[keep], ends - np.concatenate(([0], np.cumsum(size > 0)))

    def links(self) -> np.ndarray:
        """The keys of all texts' links in order, ``n_groups`` a text."""
        return Bytes(self.aligner.keys.rows.view(np.uint8), self.aligner.keys_at.rows).take(self.at[self.live]).view(np.int64)


def find(table: tuple[np.ndarray, np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each key its count, 1 if it's the best of its B id, and 1 if the table (sorted
    keys, counts, best) doesn't have it."""
    key, n, best = table
    if not len(key) or not len(keys):
        none = np.zeros(len(keys), dtype=np.int64)
        return none, none, none + 1
    order = np.argsort(keys)  # sorted keys are found without leaps through the table
    at = np.empty(len(keys), dtype=np.int64)
    at[order] = np.searchsorted(key, keys[order])
    at = np.minimum(at, len(key) - 1)
    known = key[at] == keys
    return np.where(known, n[at], 0), (known & best[at]).astype(np.int64), (~known).astype(np.int64)


def vocabularies(ranks: str | None = None, model: str | None = None) -> tuple[bytes, bytes]:
    """The files' bytes: ranks of A (``.tiktoken``) and the model of B; by default the public ones."""
    if ranks is None or model is None:
        import public_tokenizers

        ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
        model = model or public_tokenizers.path("piece_bpe_32k.model")
    out = []
    for path in (ranks, model):
        with open(path, "rb") as f:
            out.append(f.read())
    return tuple(out)


def groups(documents: DataFrame, *, id: str = "doc_id", text: str = "text", ranks: str | None = None, model: str | None = None, texts: bool = True, digest: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The part of :func:`align` that needs one document alone: its columns without
    ``n_best`` and ``count_sum``, and ``links``, the id pairs of the links in order
    (A's id in the high half). One pass, no shuffle."""
    keep = tuple(c for c in keep if c not in RESULTS and c != id)
    shared = documents.sparkSession.sparkContext.broadcast(vocabularies(ranks, model))
    rows = documents.select(F.col(f"`{id}`").cast("long").alias("__id"), *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("__text"))
    kept = [documents.select(f"`{c}`").schema[0] for c in keep]
    names = [id, *keep, "n_a", "n_b", "n_groups", "n_links"] + ["groups"] * texts + ["groups_sha256"] * digest + ["links"]
    schema = ", ".join([f"`{id}` long"] + [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n_a long, n_b long, n_groups long, n_links long"] + ["groups string"] * texts + ["groups_sha256 string"] * digest + ["links array<long>"])

    def work(batches):
        aligner = Aligner(Tokenizers(*shared.value))
        for part in chunks(batches, "__text", TEXT_BYTES):
            if aligner.full():
                aligner.forget()
            look = aligner.look(texts_of(part.column("__text")))
            n_groups = look.sums(aligner.n_groups.rows)
            columns = [part.column(i) for i in range(1 + len(keep))]
            columns += [pa.array(x) for x in (look.sums(aligner.n_a.rows), look.sums(aligner.n_b.rows), n_groups, n_groups)]
            data, ends = look.forms()
            if texts:
                raw = data.tobytes()
                columns.append(pa.array([raw[a:b].decode() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.string()))
            if digest:
                columns.append(pa.array([d if v else "" for d, v in zip(digests(data, ends), (n_groups > 0).tolist(), strict=True)], pa.string()))
            borders = np.concatenate(([0], np.cumsum(n_groups)))
            columns.append(pa.ListArray.from_arrays(borders.astype(np.int32), pa.array(look.links())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches):
        yield from work(batches)
        release()  # now that nothing of the task is held any more

    return rows.mapInArrow(run, schema)


_KEY = "shiftleft(cast(a_id as long), 32) + b_id as key"


def pair_counts(found: DataFrame) -> DataFrame:
    """Every id pair that :func:`groups` links anywhere: ``a_id``, ``b_id``, ``count`` (its
    links) and ``best`` (no pair of this B id has more). Rows that repeat count as often
    as they're there. A hot pair is one partial row a task; the counts are written once
    to the shared folder."""
    counts = written(found.select(F.explode("links").alias("key")).groupBy("key").agg(F.count("*").alias("count")))
    counts = counts.select(F.shiftright("key", 32).cast("int").alias("a_id"), F.expr("cast(key & 4294967295 as int)").alias("b_id"), "count")
    most = counts.groupBy("b_id").agg(F.max("count").alias("most"))  # a row for an id of B at most
    return counts.join(F.broadcast(most), "b_id").select("a_id", "b_id", "count", (F.col("count") == F.col("most")).alias("best"))


def _frequent(pairs: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """The pairs with the largest counts, ``limit`` at most, and the rest (None if
    there is none). The border is a power of two, from a count of counts."""
    sizes = pairs.groupBy(F.floor(F.log2("count")).cast("int").alias("p")).count().collect()  # 64 rows at most
    least, total = 64, 0
    for r in sorted(sizes, key=lambda r: -r["p"]):
        if total + r["count"] > limit:
            break
        least, total = r["p"], total + r["count"]
    if total == sum(r["count"] for r in sizes):
        return pairs, None
    power = F.floor(F.log2("count"))
    return pairs.filter(power >= least), pairs.filter(power < least)


def align(documents: DataFrame, *, id: str = "doc_id", texts: bool = True, digest: bool = False, keep: tuple[str, ...] = (), pairs_sent: int = PAIRS_SENT, **options) -> DataFrame:
    """Every whole text cut by both tokenizers and aligned.

    Returns a row for each row: the id (as long), the columns named in ``keep``, tokens
    ``n_a`` and ``n_b``, ``n_groups``, ``n_links`` (pairs of tokens that end together),
    ``n_best`` (links whose pair has the most links of its B id in the corpus, ties
    included), ``count_sum`` (of the links' corpus counts), with ``texts`` the ``groups``
    as ``a1,a2|b1;a3|b2,b3``, and with ``digest`` their SHA-256 (``''`` without tokens).

    A null or empty text, and one that a tokenizer doesn't give back byte for byte, has
    zeros and ``''``. Rows that repeat are counted and returned each; null ids stay. A kept
    column named like a result is left out. An empty table gives an empty result. Pairs
    beyond ``pairs_sent`` are joined instead of broadcast, with the same result.
    ``options`` go to :func:`groups`, whose rows are written once to the shared folder.
    """
    spark = documents.sparkSession
    found = written(groups(documents, id=id, texts=texts, digest=digest, keep=keep, **options))
    frequent, rest = _frequent(written(pair_counts(found)), pairs_sent)
    table = frequent.selectExpr(_KEY, "count", "best").toArrow()
    key, n, best = (table.column(i).to_numpy() for i in range(3))
    order = np.argsort(key)
    sent = spark.sparkContext.broadcast((key[order], n[order], best[order]))
    with_rest = rest is not None
    head = [c for c in found.columns if c != "links"]

    def work(batches):
        for part in parts(batches, lambda b: np.diff(b.column("links").offsets.to_numpy()), FOUND_LINKS):
            links = part.column("links")
            flat, borders = links.flatten().to_numpy(zero_copy_only=False), links.offsets.to_numpy().astype(np.int64)
            borders -= borders[0]
            count, most, unknown = find(sent.value, flat)
            sums = [np.diff(np.concatenate(([0], np.cumsum(x)))[borders]) for x in (most, count, unknown)]
            columns = [part.column(c) for c in head] + [pa.array(x) for x in sums[:2]]
            if with_rest:
                columns.append(pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sums[2]))).astype(np.int32), pa.array(flat[unknown > 0])))
            yield pa.RecordBatch.from_arrays(columns, names=[*head, "n_best", "count_sum"] + ["__rest"] * with_rest)

    def run(batches):
        yield from work(batches)
        release()

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema if f.name != "links"] + ["n_best long, count_sum long"] + ["__rest array<long>"] * with_rest)
    out = found.mapInArrow(run, schema)
    last = [c for c in ("groups", "groups_sha256") if c in head]
    names = [c for c in head if c not in last] + ["n_best", "count_sum", *last]
    if not with_rest:
        return out.select(*[f"`{c}`" for c in names])
    out = written(out.withColumn("__row", F.monotonically_increasing_id()))
    links = out.select("__row", F.explode("__rest").alias("key")).groupBy("__row", "key").agg(F.count("*").alias("times"))
    more = links.join(rest.selectExpr(_KEY, "count", "best"), "key").groupBy("__row").agg(F.sum(F.col("times") * F.col("count")).alias("__sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("__best"))
    added = {"n_best": "__best", "count_sum": "__sum"}
    return out.join(more, "__row", "left").select(*[(F.col(c) + F.coalesce(F.col(added[c]), F.lit(0))).alias(c) if c in added else F.col(f"`{c}`") for c in names])


def op11_token_alignment(spark, sf_dir: str) -> DataFrame:
    """Tokens, groups, links and their corpus counts of all documents."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align(documents, texts=False, digest=True)
