"""Column expressions over text: length units, Java-style split, path pieces.

All helpers return :class:`~pyspark.sql.Column` expressions built from
built-in functions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from snaptally.functions._cols import as_col

UNITS = ("utf16", "chars", "bytes")


def text_length(col, unit: str = "utf16") -> Column:
    """Length of a string in the requested unit, as BIGINT.

    ``utf16``  UTF-16 code units, what a JVM ``String.length()`` reports
               (a character above U+FFFF counts twice).
    ``chars``  Unicode code points (Spark ``length``).
    ``bytes``  UTF-8 bytes (Spark ``octet_length``).

    For ``utf16`` a pure-ASCII value (byte count equal to character count)
    takes a fast path; only other values are re-encoded.
    """
    c = as_col(col)
    if unit == "chars":
        return F.char_length(c).cast("bigint")
    if unit == "bytes":
        return F.octet_length(c).cast("bigint")
    if unit != "utf16":
        raise ValueError(f"unit must be one of {UNITS}, got {unit!r}")
    n_bytes = F.octet_length(c)
    n_chars = F.char_length(c)
    # A code point above U+FFFF takes 4 UTF-8 bytes and 2 UTF-16 units;
    # only when bytes exceed chars by 3 per such point can they exist at all.
    utf16 = F.when(
        n_bytes - n_chars < F.lit(3), n_chars
    ).otherwise(F.shiftright(F.octet_length(F.encode(c, "UTF-16BE")), 1))
    return utf16.cast("bigint")


def java_split(col, sep: str = " ") -> Column:
    """``String.split`` of the JVM for a one-character literal separator.

    Spark ``split`` keeps trailing empty strings, the JVM drops them:
    an empty value gives one empty string, a value made only of separators
    gives no element, otherwise trailing separators are removed before
    splitting (leading and interior empties are kept).
    """
    if len(sep) != 1:
        raise ValueError("java_split supports a one-character separator")
    c = as_col(col)
    trimmed = F.rtrim(c, F.lit(sep))
    return (
        F.when(c == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, _regex_escape(sep)))
    )


def _regex_escape(ch: str) -> str:
    return "\\" + ch if ch in r".^$*+?()[]{}|\/" else ch


def decode_path(col) -> Column:
    """Undo the percent-encoding of ``_metadata.file_path``.

    ``url_decode`` would also turn ``+`` into a space, so ``+`` is protected
    first; the result equals the ``path`` column of the ``binaryFile`` source.
    """
    return F.url_decode(F.replace(as_col(col), F.lit("+"), F.lit("%2B")))


def parent_dir(col) -> Column:
    """Everything before the last ``/`` of a path string."""
    return F.regexp_extract(as_col(col), r"^(.*)/[^/]*$", 1)


def path_component(col, index: int) -> Column:
    """Path component by 1-based position, negative counts from the end
    (``-1`` the file name, ``-2`` its directory); NULL when there is no such
    component (no error under ANSI mode)."""
    return F.try_element_at(F.split(as_col(col), "/"), F.lit(index))
