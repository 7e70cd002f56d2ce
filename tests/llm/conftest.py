import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, size: int = 4000) -> list[str]:
    import random

    rng = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz"
    vocabulary = ["".join(letters[(i * 7 + j * 11 + i // 26) % 26] for j in range(3 + i % 6)) for i in range(size)]
    return [rng.choice(vocabulary) for _ in range(n)]


def odd_documents() -> list[tuple]:
    """Small documents with every odd case: nulls, empty and long texts, ties,
    repeated rows, copies, near copies, shared passages, runs of one word."""
    shared = words(1, 80)
    base = words(2, 300)
    texts = [
        "", None, " ", "one", "one", "two words", "a b c", "É ÜBER naïve 漢字 😀 ok", "\n\n\t", "the " * 120, "the " * 200, "ab ab ab ba " * 60,
        " ".join(base), " ".join(base), " ".join(base[:150] + ["changed"] + base[151:]), " ".join(base[:290]), " ".join(base).upper(),
        " ".join(words(3, 40) + shared + words(4, 40)), " ".join(words(5, 10) + shared[5:75] + words(6, 90)), " ".join(shared[20:] + words(7, 5)),
        " ".join(words(8, 12000)), " ".join(words(8, 12000)[100:]), "x" * 5000, "x" * 4000 + "y", "line one here\n" * 40, " ".join(f"{w}###" for w in words(9, 200)),
    ]
    rows = [(i * 3, t, ["en", "fr", None][i % 3], ["s1", "s2", None, "s1"][i % 4], len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [(100 + i, " ".join(words(10 + i, 60 + 20 * i)), "en", "s1", None) for i in range(12)]
    rows.append(rows[12])  # a repeated row
    rows.append((500, " ".join(base[:100]), "en", "s2", 1))
    rows.append((500, " ".join(base[:90]), "en", "s2", 1))  # one id, two texts
    rows.append((None, " ".join(base), "en", "s1", 1))
    return rows


def by_id(rows) -> dict[int, str | None]:
    """One text for each id: the smallest; null only if there's no other."""
    out: dict[int, str | None] = {}
    for r in rows:
        if r[0] is None:
            continue
        if r[0] not in out or out[r[0]] is None or (r[1] is not None and r[1].encode() < out[r[0]].encode()):
            out[r[0]] = r[1] if r[1] is not None else out.get(r[0])
    return out


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents with extra columns that clash with names used inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_documents(), DOCS).repartition(3)
    return df.withColumns({c: F.lit(i) for i, c in enumerate(("doc", "spans", "kept", "n", "tile", "lo", "label", "row", "mix_slot", "mix_source", "base", "found", "rep", "k1"))})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
