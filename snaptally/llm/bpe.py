"""BPE encoding and decoding in batched numpy merge rounds.

White space never takes part in a token of this kind of vocabulary, so a text is
encoded piece by piece between white space, and equal pieces once per task. The new
pieces of a chunk lie in one flat array of symbols. A round looks up every adjacent
pair by binary search in the sorted pair keys, takes the lowest rank of each word and
merges that pair wherever it occurs in the word; words without a pair are done.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._flat import chunks, record, texts_of, trimmed
from ._repeats import digests

KNOWN_PIECES = 200_000  #: pieces that a task remembers before it starts afresh
ROUND_SYMBOLS = 1 << 17  #: symbols merged in one flat array
TEXT_BYTES = 1 << 18  #: texts encoded at once; a longer single text is encoded alone

# the part of the pre-tokenizer's pattern that ASCII text can reach
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_SUPPORTED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_chars() -> list[str]:
    """The visible character that byte-level vocabularies use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    out = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [out[b] for b in range(256)]


class Vocabulary:
    """Tables of a ``tokenizers`` JSON file: BPE on bytes with a word-end suffix."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        kinds = [x["type"] for x in spec["normalizer"]["normalizers"]]
        splits = spec["pre_tokenizer"]["pretokenizers"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"] or kinds != ["NFC", "Replace", "Lowercase"] or splits[0]["pattern"]["Regex"] != _SUPPORTED or spec["decoder"]:
            raise ValueError("not a lower-casing byte-level BPE file with word ends")
        vocab = dict(model["vocab"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        suffix = model["end_of_word_suffix"]
        chars = byte_chars()
        self.inner = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], dtype=np.int64)
        self.byte_of = {c: b for b, c in enumerate(chars)}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int64), made[order]
        names = {i: t for t, i in {**vocab, **self.special}.items()}
        size = max(names) + 1
        shown = [(names[i] + " ").encode() if i in names else b"" for i in range(size)]
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.shown_at = np.concatenate(([0], np.cumsum([len(x) for x in shown])))
        # what text beyond ASCII needs of the library: the rules without the vocabulary
        bare = {"added_tokens": [], "post_processor": None, "model": {**model, "vocab": {}, "merges": []}}
        self.rules = json.dumps({**spec, **bare})
        self._library = None

    @classmethod
    def from_tables(cls, tables: dict) -> Vocabulary:
        """A vocabulary of another one's ``vars()``: a task needs no file and parses none."""
        out = cls.__new__(cls)
        vars(out).update(tables)
        return out

    def pretokens(self, piece: bytes) -> list[bytes | int]:
        """Words of a piece without white space, as bytes; special tokens as ids."""
        if piece.isascii():
            text = piece.decode("ascii")
            if "<|" in text and any(s in text for s in self.special):
                out: list[bytes | int] = []
                for x in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text):
                    out += [self.special[x]] if x in self.special else self.pretokens(x.encode())
                return out
            return [w.encode() for w in _ASCII.findall(text.lower())]
        text = piece.decode("utf-8")
        if "<|" in text and any(s in text for s in self.special):
            out = []
            for x in re.split("(" + "|".join(map(re.escape, self.special)) + ")", text):
                out += [self.special[x]] if x in self.special else self.pretokens(x.encode())
            return out
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.rules)
        words = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(self.byte_of[c] for c in w) for w, _ in words]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in one array, and where each word's ids begin."""
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        ids = self.inner[data]
        last = np.cumsum(lengths) - 1
        ids[last] = self.final[data[last]]
        word = np.repeat(np.arange(len(words)), lengths)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            key = ids[:-1] << 32 | ids[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = (self.keys[at] == key) & (word[1:] == word[:-1])
            rank = np.full(len(ids), len(self.keys), dtype=np.int64)
            rank[:-1][found] = self.ranks[at[found]]
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            size = np.diff(np.concatenate((first, [len(ids)])))
            least = np.minimum.reduceat(rank, first)
            open_ = np.repeat(least < len(self.keys), size)
            if not open_.all():
                done.append((word[~open_], ids[~open_]))
            hit = (rank == np.repeat(least, size)) & open_
            # of pairs that overlap (a a a) every second one counts, from the left
            start = hit.copy()
            start[1:] &= ~hit[:-1]
            run = np.flatnonzero(start)
            place = np.arange(len(ids))
            since = place - np.repeat(run, np.diff(np.concatenate((run, [len(ids)])))) if len(run) and run[0] == 0 else place - np.concatenate((np.zeros(run[0] if len(run) else len(ids), dtype=np.int64), np.repeat(run, np.diff(np.concatenate((run, [len(ids)]))))))
            hit &= since % 2 == 0
            left = np.flatnonzero(hit)
            ids[left] = self.made[at[left]]
            keep = open_
            keep[left + 1] = False
            ids, word = ids[keep], word[keep]
        word, ids = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return ids[order], np.concatenate(([0], np.cumsum(np.bincount(word, minlength=len(words)))))

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, as little-endian unsigned 32-bit integers."""
        parts = [self.pretokens(p) for p in pieces]
        words = list({w for p in parts for w in p if isinstance(w, bytes)})
        ids: dict[bytes | int, bytes] = {i: np.uint32(i).astype("<u4").tobytes() for i in self.special.values()}
        start = 0
        while start < len(words):
            end, total = start, 0
            while end < len(words) and (end == start or total + len(words[end]) <= ROUND_SYMBOLS):
                total += len(words[end])
                end += 1
            flat, begin = self.merge(words[start:end])
            raw = flat.astype("<u4").tobytes()
            cuts = (begin * 4).tolist()
            ids.update(zip(words[start:end], (raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)), strict=True))
            start = end
        return [b"".join([ids[w] for w in p]) for p in parts]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts of ids as bytes: their tokens joined by single spaces. Ids that
        the vocabulary doesn't have are left out."""
        known = (ids >= 0) & (ids < len(self.shown_at) - 1)
        ids = np.where(known, ids, 0)
        n = np.where(known, self.shown_at[ids + 1] - self.shown_at[ids], 0)
        ends = np.concatenate(([0], np.cumsum(n)))
        at = np.repeat(self.shown_at[ids] - ends[:-1], n) + np.arange(ends[-1])
        out = self.shown[at]
        borders = ends[offsets]
        # drop the space after each text's last token
        some = borders[1:] > borders[:-1]
        keep = np.ones(len(out), dtype=bool)
        keep[borders[1:][some] - 1] = False
        return out[keep], borders - np.concatenate(([0], np.cumsum(some)))


class Encoder:
    """A vocabulary with the pieces that a task has met: their sorted names, and where
    the ids of each lie in one flat array."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()

    def forget(self) -> None:
        self.names = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids begin."""
        words = texts.words()
        names, first, inverse = np.unique(words.hashes(texts.data), return_index=True, return_inverse=True)
        if len(self.names) > KNOWN_PIECES:
            self.forget()
        at = np.searchsorted(self.names, names)
        new = np.ones(len(names), dtype=bool)
        old = np.flatnonzero(at < len(self.names))
        new[old] = self.names[at[old]] != names[old]
        if new.any():
            raw = texts.data.tobytes()
            here = first[new]
            pieces = [raw[a:b] for a, b in zip(words.starts[here].tolist(), words.ends[here].tolist(), strict=True)]
            found = self.vocabulary.encode_pieces(pieces)
            n = np.array([len(x) // 4 for x in found], dtype=np.int64)
            self.names = np.insert(self.names, at[new], names[new])
            self.begin = np.insert(self.begin, at[new], len(self.ids) + np.cumsum(n) - n)
            self.size = np.insert(self.size, at[new], n)
            self.ids = np.concatenate((self.ids, np.frombuffer(b"".join(found), dtype="<u4")))
            at += np.cumsum(new) - new  # places move by the new ones before them
        begin, size = self.begin[at][inverse], self.size[at][inverse]
        ends = np.concatenate(([0], np.cumsum(size)))
        ids = self.ids[np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])]
        return ids, ends[words.first]


def tokenizer_json(path: str | None = None) -> str:
    """The tokenizer file's text; the default is the public word-end vocabulary."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(documents: DataFrame, *, path: str | None = None, digest: bool = True, with_ids: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Encode every whole ``text`` and decode it again.

    Returns a row for each row: ``doc_id``, the columns named in ``keep``,
    ``n_tokens``, with ``digest`` ``ids_sha256`` and ``decoded_sha256`` (hex, of the
    ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8),
    and with ``with_ids`` the ``ids``. The vocabulary's tables (a few MB) are sent
    to the tasks. A null or empty text has no tokens; rows may repeat; an empty table
    gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(vars(Vocabulary(tokenizer_json(path))))
    rows = documents.select("doc_id", *keep, F.col("text").alias("__text"))
    fields = [documents.schema[c] for c in ("doc_id", *keep)]
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["n_tokens long"] + ["ids_sha256 string", "decoded_sha256 string"] * digest + ["ids array<int>"] * with_ids)
    head = len(fields)

    def run(batches):
        encoder = Encoder(Vocabulary.from_tables(shared.value))
        for part in chunks(batches, "__text", TEXT_BYTES):
            ids, offsets = encoder.encode(texts_of(part.column("__text")))
            columns = [part.column(i) for i in range(head)]
            names = [f.name for f in fields] + ["n_tokens"]
            columns.append(pa.array(np.diff(offsets)))
            if digest:
                raw = np.frombuffer(ids.astype("<u4").tobytes(), dtype=np.uint8)
                text, borders = encoder.vocabulary.decode(ids.astype(np.int64), offsets)
                columns += [pa.array(digests(raw, offsets * 4)), pa.array(digests(text, borders))]
                names += ["ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(trimmed(run), out)


def decode(tokens: DataFrame, *, path: str | None = None) -> DataFrame:
    """The text of each row's ``ids``: ``doc_id, text``; null ids give a null text."""
    shared = tokens.sparkSession.sparkContext.broadcast(vars(Vocabulary(tokenizer_json(path))))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches):
        vocabulary = Vocabulary.from_tables(shared.value)
        for part in batches:
            if not part.num_rows:
                continue
            lists = part.column("ids").fill_null([]) if part.column("ids").null_count else part.column("ids")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            text, borders = vocabulary.decode(flat, offsets - offsets[0])
            raw = text.tobytes()
            valid = part.column("ids").is_valid().to_pylist()
            yield record(schema, part.column("doc_id"), [raw[a:b].decode() if v else None for a, b, v in zip(borders[:-1].tolist(), borders[1:].tolist(), valid, strict=True)])

    return tokens.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, text string")


def op9_bpe(spark, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts of all documents."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
