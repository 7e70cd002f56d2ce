"""File semantics (D6) on random contents against direct Python computations."""

import os
import random
import re

from conftest import write_file
from snaptally.operators import dataset_stats, file_stats
from snaptally.sources import scan_lines

PIECES = ["a", "bb", "é", "\U0001F600", " ", "\n", "\n", "\r\n", "\r", "\n\n", "x y"]


def reader_lines(content: str) -> list[str]:
    """Default line reader: breaks at \\n, \\r\\n and \\r; a final break adds no line."""
    if content == "":
        return []
    parts = re.split(r"\r\n|\n|\r", content)
    if re.search(r"(\r\n|\n|\r)$", content):
        parts.pop()
    return parts


def newline_records(content: str) -> list[str]:
    """Records split at \\n only (\\r stays); a final \\n adds no record."""
    if content == "":
        return []
    parts = content.split("\n")
    if content.endswith("\n"):
        parts.pop()
    return parts


def jvm_split_newline(content: str) -> list[str]:
    """String.split("\\n") of the JVM: trailing empty records dropped."""
    if content == "":
        return [""]
    parts = content.split("\n")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def u16(s: str) -> int:
    return len(s.encode("utf-16-le")) // 2


def test_line_and_file_semantics_match_python(spark, tmp_path):
    rnd = random.Random(17)
    root = str(tmp_path / "files")
    contents = {}
    for i in range(40):
        c = "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(1, 30)))
        contents[f"f{i:02d}"] = c
        write_file(f"{root}/f{i:02d}", c.encode("utf-8"))

    all_lines = [ln for c in contents.values() for ln in reader_lines(c)]
    r = dataset_stats(scan_lines(spark, root)).first()
    assert r.recordCount == len(all_lines)
    assert r.tableSize == sum(u16(ln) for ln in all_lines)

    got = {os.path.basename(x.fileURI): x for x in file_stats(spark, root).collect()}
    for name, c in contents.items():
        recs = newline_records(c)
        assert got[name].recordCount == len(recs), name
        assert got[name].fileSize == u16(c), name  # every break counted, no more
        assert got[name].fileBytes == len(c.encode("utf-8")), name

    whole = {os.path.basename(x.fileURI): x for x in file_stats(spark, root, whole=True).collect()}
    for name, c in contents.items():
        assert whole[name].recordCount == len(jvm_split_newline(c)), name
        assert whole[name].fileSize == u16(c), name
