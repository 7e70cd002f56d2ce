"""Fill-in-middle transformation over a sparse exception index.

A text is cut into prefix, middle and suffix, and put in another order so that a model
learns to fill the middle. Cuts are found in one alphabet (units or code points) and
made in another (UTF-8 bytes). Instead of a table of all characters' positions, the
index records the multibyte characters alone: where each one lies and how many bytes
it has beyond one. Between two of them positions differ by a constant, so a cut is
converted by one binary search and a subtraction; ASCII texts have an empty index.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._flat import Texts, chunks, release, texts_of
from ._units import unit_starts

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
FIM_PERCENT = 50  #: texts transformed, in a hundred
SPM_PERCENT = 80  #: of them with the suffix first

#: bytes beyond the first of a character, by its first byte; 0 inside a character
_EXCESS = np.zeros(256, dtype=np.int64)
_EXCESS[0xC0:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:] = 1, 2, 3


class Exceptions:
    """The multibyte characters of a byte array that begins and ends at characters'
    borders: their byte positions, code-point positions, and the excess bytes up to each."""

    def __init__(self, data: np.ndarray):
        self.at_byte = np.flatnonzero(data >= 0xC0)
        self.excess = np.concatenate(([0], np.cumsum(_EXCESS[data[self.at_byte]])))
        self.at_char = self.at_byte - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut (a cut lies between characters)."""
        return cuts - self.excess[np.searchsorted(self.at_byte, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.excess[np.searchsorted(self.at_char, cuts)]


def draws(ids: list, seed: int) -> np.ndarray:
    """Four 32-bit numbers for each id: the first four 8-digit groups of the hex
    SHA-256 of ``seed:id`` (a null id counts as no digits)."""
    raw = b"".join(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(raw, dtype=">u4").astype(np.int64).reshape(-1, 4)


def restore(output: bytes, form: str) -> bytes:
    """The text that :func:`transformed` made ``output`` from, from it and its form."""
    if form == "plain":
        return output
    if form == "psm":
        prefix, _, rest = output[len(PREFIX) :].partition(SUFFIX)
        suffix, _, middle = rest.partition(MIDDLE)
    else:
        suffix, _, rest = output[len(SUFFIX) :].partition(PREFIX)
        prefix, _, middle = rest.partition(MIDDLE)
    return prefix + middle + suffix


def transformed(texts: Texts, ids: list, *, seed: int = SEED, level: str = "unit", fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT):
    """``n, forms, prefix_chars, middle_chars, outputs`` of a chunk of texts."""
    index = Exceptions(texts.data)
    begin = texts.offsets[:-1]
    chars = index.to_chars(texts.offsets)
    if level == "unit":
        starts, first = unit_starts(texts)
        n = np.diff(first)
    elif level == "char":
        n = np.diff(chars)
    else:
        raise ValueError(f"level must be unit or char, not {level}")
    h = draws(ids, seed)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    cuts = np.stack((np.minimum(one, two), np.maximum(one, two)))
    if level == "unit":
        ends = np.append(starts, len(texts.data))
        # the cut after all units of a text is its end, which is the next text's start
        at = np.where(cuts == n, texts.offsets[1:], ends[np.minimum(first[:-1] + cuts, len(ends) - 1)])
    else:
        at = index.to_bytes(chars[:-1] + cuts)
    at_char = index.to_chars(at)
    raw = texts.data.tobytes()
    plain = (h[:, 2] % 100 >= fim_percent) | (n == 0)
    spm = h[:, 3] % 100 < spm_percent
    forms, outputs = [], []
    for i, (a, p, m, b) in enumerate(zip(begin.tolist(), at[0].tolist(), at[1].tolist(), texts.offsets[1:].tolist(), strict=True)):
        text = raw[a:b]
        if plain[i] or PREFIX in text or SUFFIX in text or MIDDLE in text:
            plain[i] = True
            forms.append("plain")
            outputs.append(text)
        elif spm[i]:
            forms.append("spm")
            outputs.append(SUFFIX + raw[m:b] + PREFIX + raw[a:p] + MIDDLE + raw[p:m])
        else:
            forms.append("psm")
            outputs.append(PREFIX + raw[a:p] + SUFFIX + raw[m:b] + MIDDLE + raw[p:m])
    prefix = pa.array(at_char[0] - chars[:-1], mask=plain)
    middle = pa.array(at_char[1] - at_char[0], mask=plain)
    return n, forms, prefix, middle, outputs


RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256")


def fill_in_middle(documents: DataFrame, *, id: str = "doc_id", text: str = "text", level: str = "unit", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT, outputs: bool = True, digests: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every whole text with its middle moved to the end.

    Returns a row for each row: the id (as long), the columns named in ``keep``, ``n``
    (units or code points, by ``level``), ``form`` (``plain``, ``psm`` or ``spm``),
    ``prefix_chars`` and ``middle_chars`` (code points; null if plain), with ``outputs``
    the ``output``, and with ``digests`` the SHA-256 of the output and of the text
    rebuilt from output and form. The cuts depend on seed and id alone, so equal rows
    give equal results, and no row depends on another.

    A null or empty text, and one that holds a marker, stays as it is (``plain``; null
    gives an empty output). A null id draws its own numbers. A kept column named like a
    result is left out. An empty table gives an empty result; one pass, no shuffle.
    """
    keep = tuple(c for c in keep if c not in RESULTS and c != id)
    rows = documents.select(F.col(f"`{id}`").cast("long").alias("__id"), *[F.col(f"`{c}`").alias(f"__k{i}") for i, c in enumerate(keep)], F.col(f"`{text}`").alias("__text"))
    kept = [documents.select(f"`{c}`").schema[0] for c in keep]
    names = [id, *keep, "n", "form", "prefix_chars", "middle_chars"] + ["output"] * outputs + ["output_sha256", "restored_sha256"] * digests
    schema = ", ".join([f"`{id}` long"] + [f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["n long, form string, prefix_chars long, middle_chars long"] + ["output string"] * outputs + ["output_sha256 string, restored_sha256 string"] * digests)

    def run(batches):
        for part in chunks(batches, "__text"):
            ids = part.column("__id")
            n, forms, prefix, middle, made = transformed(texts_of(part.column("__text")), ids.to_pylist(), seed=seed, level=level, fim_percent=fim_percent, spm_percent=spm_percent)
            columns = [ids, *[part.column(i + 1) for i in range(len(keep))], pa.array(n), pa.array(forms, pa.string()), prefix, middle]
            if outputs:
                columns.append(pa.array(made, pa.binary()).cast(pa.string()))
            if digests:
                columns.append(pa.array([hashlib.sha256(x).hexdigest() for x in made], pa.string()))
                columns.append(pa.array([hashlib.sha256(restore(x, f)).hexdigest() for x, f in zip(made, forms, strict=True)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)
        release()

    return rows.mapInArrow(run, schema)


def op13_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    """Forms, cuts and digests of all documents, cut at units."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return fill_in_middle(documents, outputs=False, digests=True)
