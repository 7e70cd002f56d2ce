"""The Jaccard join against all pairs, and components against union-find."""

import random
import re

from snaptally.llm import count_vector_join as join
from snaptally.llm._components import components

from .conftest import by_id, odd_documents, words

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def direct(texts, n, num, den):
    sets = {i: shingles(t, n) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df):
    rows = df.collect()
    out = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(out) == len(rows)
    return out


def test_odd(odd):
    assert got(join.jaccard_groups(odd)) == direct(by_id(odd_documents()), 4, 85, 100)


def test_near_copies_around_the_threshold(spark):
    # copies of a few originals with few or many edits, so links run near the limit
    rng = random.Random(3)
    texts = {}
    for o in range(6):
        original = words(50 + o, [9, 30, 70, 140, 300, 900][o])
        for _ in range(40):
            w = list(original)
            for _ in range(rng.randint(0, max(1, len(w) // 22))):
                at = rng.randrange(len(w))
                w[at : at + rng.randint(0, 1)] = [f"z{rng.randint(0, 30)}"]
            texts[len(texts) * 7 + 1] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    assert got(join.jaccard_groups(df)) == direct(texts, 4, 85, 100)
    assert got(join.jaccard_groups(df, words=5, num=80)) == direct(texts, 5, 80, 100)


def test_empty_table(none):
    assert join.jaccard_groups(none).collect() == []


def test_most_apart_bounds_linked_sets():
    for a in range(1, 120):
        for b in range(a, 150):
            for both in range(a + 1):
                if 100 * both >= 85 * (a + b - both):
                    assert a + b - 2 * both <= join.most_apart(a)
                    assert a + b - 2 * both <= join.most_apart(b)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    root = {x: x for e in links for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    expected = {x: find(x) for x in root if any(x in e and e[0] != e[1] for e in links)}
    rows = components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()
    assert {r.node: r.component for r in rows} == expected and len(rows) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_copies_near_their_original_and_far_from_each_other(spark):
    """Copies at 0.87 to the original and 0.76 to each other, and documents that share a
    long passage: all links are found, and few pairs go on to be verified."""
    original = words(90, 400)
    texts = {}
    for i in range(60):
        w = list(original)
        for k in range(5):  # five edits, each in a place of its own
            w[(i * 5 + k) * 400 // 300] = f"edit{i}x{k}"
        texts[10 + i] = " ".join(w)
    texts[500] = " ".join(original)  # not the least id
    shared = words(91, 300)
    for i in range(60):
        texts[600 + i] = " ".join(words(700 + i, 240) + shared)
    want = direct(texts, 4, 85, 100)
    assert len({want[10 + i][1] for i in range(60)}) == 1 and len({want[600 + i][1] for i in range(60)}) == 60
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    seen = []
    real = join._links

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return real(pairs, *rest)

    join._links = counted
    try:
        assert got(join.jaccard_groups(df)) == want
    finally:
        join._links = real
    assert sum(seen) <= 2 * len(texts)
