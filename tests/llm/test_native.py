"""Personal data and secrets: base spans against the plain patterns, plans without
Python, and every odd case."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from snaptally.llm import personal_data, secrets

from .conftest import DOCS, odd_documents, words

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PARTS = ["a", "b.", "1", "22", "255", "256", ".", ".", "@", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "4111-1111-1111-1112", "x@y.zz", "x@y.zz_q@r.st", "1.2.3.4", "0001.2.3.256", "é", "😀", "+1 (212) 555-0100", "_", "%", "\n", "999"]
SIZE = 1200


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(d[::-1])) % 10 == 0


def direct(text):
    out = []
    for k, (name, p) in enumerate(BASE.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if name == "ip":
                ok = all(int(x) <= 255 for x in m[0].split("."))
            else:
                ok = {"email": True, "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[name]
            if ok:
                out.append((m.start(), k, m.end(), name))
    return sorted(out)


def texts():
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30)))) for i in range(SIZE)]
    long = ["a" * 60_000, "1" * 60_000, "1." * 20_000, "a@" * 10_000, "+1 " * 10_000, "4111111111111111 x " * 400, "word " * 20_000, None, ""]
    return rows + [(SIZE + i, t) for i, t in enumerate(long)]


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|ExistingRDD", plan), plan


def test_base_spans_and_redaction(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = personal_data.find(df, keep=("doc_id", "text"))
    no_python(found)
    got = {r.doc_id: r for r in found.withColumn("clean", personal_data.redact()).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        base = direct(t)
        r = got[i]
        joined = ",".join(f"{n}:{s}:{e}" for s, _, e, n in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (t, joined, r.spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(b[1] == k for b in base) for k in range(4))
        spans = [(f.s, f.k, f.e) for f in r.found]
        assert spans == sorted(spans) and {b[:3] for b in base} <= set(spans)
        # redaction: overlapping spans become one mark
        out, at, names = [], 0, [*personal_data.KINDS, *personal_data.GENERATORS]
        for s, k, e in spans:
            if s < at:
                at = max(at, e)
                if out[-1][1] < e:
                    out[-1] = (out[-1][0], e, out[-1][2])
                continue
            out.append((s, e, names[k]))
            at = e
        expected, at = "", 0
        for s, e, n in out:
            expected += t[at:s] + f"[{n.upper()}]"
            at = e
        assert r.clean == (None if t is None else expected + t[at:])


def test_added_spans_stand_like_confirmed_ones(spark):
    # proposals that the base misses (bracketed mail addresses) beside confirmed ones
    rng = random.Random(1)
    rows = []
    for i in range(400):
        w = words(i, 30)
        name = "".join(rng.choice("abcdef") for _ in range(6))
        if i % 2:
            w.insert(9, f"mail {name}{i}@host{i % 7}.example.com")
        if i % 5 == 0:
            w.insert(20, f"mail {name}{i}[at]host{i % 7}.example.com")
        if i % 3 == 0:
            w.insert(15, f"{rng.randint(10**9, 10**10)}/{rng.randint(10, 99)}")
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in personal_data.find(df, precision=0.8).collect():
        base = direct(rows[r.doc_id][1])
        extra = [f for f in r.found if f.k >= 4]
        assert len(r.found) == len(base) + len(extra)
        assert all(f.k == 4 + list(personal_data.GENERATORS).index("mail_like") for f in extra)


def test_trees_and_thresholds_use_every_candidate(spark):
    """A generator with 150 of 60,150 candidates, all confirmed: the fifth kept apart is enough for 0.95, a third of it (a sample of 20,000) is not."""
    rare = F.col("id") >= 60_000
    values = {"generator": F.when(rare, 3.0).otherwise(0.0), "length": F.when(rare, 20.0).otherwise(F.col("id") % 2 + 8.0)}
    rows = spark.range(60_150).select("id", F.lit(0).alias("s"), F.lit(9).alias("e"), F.when(rare, 3).otherwise(0).alias("g"), *[values.get(f, F.lit(0.0)).alias(f) for f in personal_data.FEATURES], (rare | (F.col("id") % 2 == 0)).alias("confirmed"))
    apart = rows.filter(F.pmod(F.xxhash64("id", "s", *personal_data.FEATURES), F.lit(5)) == 4).filter(rare).count()
    assert apart / (apart + 1) >= personal_data.PRECISION
    limits = personal_data.fit(rows)[1]
    assert limits[0] < 1 and limits[3] < 1
    assert limits[1] == limits[2] == 2.0  # no candidates


def test_odd_and_empty(odd, none):
    assert personal_data.find(odd).count() == len(odd_documents())
    assert personal_data.find(none).collect() == []
    assert secrets.scan(odd).count() == len(odd_documents())
    assert secrets.scan(none).collect() == []


def test_secrets_kept_and_false_positives_removed(spark):
    rng = random.Random(2)
    rows, truth = [], set()
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    for i in range(500):
        w = words(1000 + i, 40)
        if i % 4 == 0:
            secret = ["AKIA" + "".join(rng.choice(alphabet) for _ in range(16)), "".join(rng.choice("0123456789abcdef") for _ in range(32))][i % 8 // 4]
            w.insert(7, secret if secret.startswith("AKIA") else f'token = "{secret}"')
            truth.add((i, secret))
        if i % 3 == 0:
            w.insert(3, "".join(rng.choice(words(i, 5)) for _ in range(4)))
            w.insert(5, f"https://host.example.com/{w[0]}/{w[1]}/{w[2]}.html")
            w.insert(9, f"first.{w[1]}@mail.example.com")
        rows.append((i, " ".join(w), "en", "s", 1))
    found = secrets.scan(spark.createDataFrame(rows, DOCS))
    no_python(found)
    got = {(r.doc_id, rows[r.doc_id][1][f.s : f.e]) for r in found.collect() for f in r.found}
    assert truth <= got
    assert len(got - truth) <= 5, sorted(got - truth)[:10]


def test_many_matches_keep_their_places(spark):
    from pyspark.sql import functions as F

    from snaptally.llm._native import spans

    text = "é 12 x345 " * 700 + "7"
    r = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(spans("t", "[0-9]++").alias("x"), F.col("t")).collect()
    assert [(f.s, f.e, f.v) for f in r[0].x] == [(m.start(), m.end(), m[0]) for m in re.finditer("[0-9]+", text)]
    assert r[1].x is None and r[2].x == []


@pytest.mark.parametrize("digits", ["4111111111111111", "4111111111111112", "123456789012", "79927398713000"])
def test_luhn(spark, digits):
    from pyspark.sql import functions as F

    assert spark.range(1).select(F.expr(personal_data._luhn(f"'{digits}'"))).first()[0] == luhn(digits)


def test_kinds_that_the_base_rules_do_not_know(spark):
    planted = {"account_like": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"], "address_like": ["2001:db8:85a3:0:0:8a2e:370:7334", "fe80:12::8a2e:370"], "mail_like": ["jane.roe(at)host.example.com", "joe [at] mail [dot] org"]}
    rows = [(i, f"see {v} today") for i, v in enumerate(x for group in planted.values() for x in group)]
    wrong = ["DE89 3704 0044 0532 0130 01", "00:1a:2b:3c:4d:5e:6f:70", "12:30:45:10", "we meet (at) noon. It is"]
    df = spark.createDataFrame(rows + [(100 + i, f"see {v} today") for i, v in enumerate(wrong)], "doc_id long, text string")
    got = {r.doc_id: r for r in personal_data.find(df, keep=("doc_id", "text")).withColumn("clean", personal_data.redact()).collect()}
    kinds = [k for k, group in planted.items() for _ in group]
    for (i, text), kind in zip(rows, kinds, strict=True):
        assert f"{kind}:4:{len(text) - 6}" in got[i].spans.split(",")
        assert got[i].clean == f"see [{kind.upper()}] today"
    for i in range(len(wrong)):
        assert not any(k in got[100 + i].spans for k in planted)
