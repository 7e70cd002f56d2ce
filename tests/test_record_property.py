"""Strict record check against an independent validator (Python's json module).

Thousands of seeded random lines — valid objects and mutations of them (cuts,
inserted JSON punctuation, wrappers, trailing text, duplicate keys) — are
checked in one Spark job. A line is good exactly when Python parses it as one
object with no duplicate key anywhere and no NaN/Infinity.
"""

import json
import random

from snaptally.operators import parse_records


class _Bad(ValueError):
    pass


def _no_dups(pairs):
    keys = [k for k, _ in pairs]
    if len(keys) != len(set(keys)):
        raise _Bad("duplicate key")
    return dict(pairs)


def _reject(_):
    raise _Bad("non-finite number")


def py_valid(line: str) -> bool:
    try:
        obj = json.loads(line, object_pairs_hook=_no_dups, parse_constant=_reject)
    except (ValueError, RecursionError):
        return False
    return isinstance(obj, dict)


def _value(rnd, depth=0):
    k = rnd.randrange(9 if depth < 3 else 5)
    if k == 0:
        return rnd.choice([0, -1, 7, 123456789, -42])
    if k == 1:
        return rnd.choice([0.5, -2.25, 1e10, 3.0])
    if k == 2:
        return rnd.choice(["", "x", "tab\there", "quote\"d", "é", "é中", "back\\slash", "}", "]", ","])
    if k == 3:
        return rnd.choice([True, False, None])
    if k == 4:
        return "s%d" % rnd.randrange(100)
    if k in (5, 6):
        return {rnd.choice(["a", "b", "~table", "", "k%d" % rnd.randrange(5)]): _value(rnd, depth + 1)
                for _ in range(rnd.randrange(4))}
    return [_value(rnd, depth + 1) for _ in range(rnd.randrange(4))]


def _line(rnd) -> str:
    obj = {"~table": "t%d" % rnd.randrange(4)} if rnd.random() < 0.5 else {}
    for _ in range(rnd.randrange(4)):
        obj["f%d" % rnd.randrange(6)] = _value(rnd)
    s = json.dumps(obj, ensure_ascii=rnd.random() < 0.5, separators=rnd.choice([(",", ":"), (", ", ": ")]))
    m = rnd.randrange(12)
    if m == 0:
        s = s[: rnd.randrange(len(s) + 1)]
    elif m == 1:
        i = rnd.randrange(len(s) + 1)
        s = s[:i] + rnd.choice(["}", "]", ",", ":", '"', "{", "[", " ", "x", "\\"]) + s[i:]
    elif m == 2:
        s = s + rnd.choice(["}", "]", " x", ',"z":1', ',"z"', "{}", " ", "\t", "//c", "\r"])
    elif m == 3:
        fmt = rnd.choice(["[%s]", " %s ", '{"w":%s}', "%s,%s", "%s%s"])
        s = fmt % ((s, s) if fmt.count("%s") == 2 else (s,))
    elif m == 4 and len(s) > 2:
        s = s[:-1] + ',"f0":1,"f0":2}'
    elif m == 5:
        s = rnd.choice(["null", "[]", "1", '"x"', "", "  ", "{}", "{ }", "true", "{,}", '{"a"}', '{"a":}'])
    elif m == 6:
        i = rnd.randrange(len(s) + 1)
        s = s[:i] + s[i + 1:]
    return s.replace("\n", " ")


def test_strict_check_matches_python_json(spark):
    rnd = random.Random(20261202)
    lines = [_line(rnd) for _ in range(4000)]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    got = {r.i: r.is_valid for r in parse_records(df, keep_record=False).select("i", "is_valid").collect()}
    diffs = [(lines[i], got[i]) for i in range(len(lines)) if got[i] != py_valid(lines[i])]
    assert not diffs, diffs[:10]
    n_valid = sum(got.values())
    assert 0.2 * len(lines) < n_valid < 0.8 * len(lines)  # both kinds well represented


def test_gap_forms_match_python_json(spark):
    """Objects with brackets, braces, commas and members appended or inserted:
    exactly the forms a single wrapper parse would let through."""
    tails = ["}", "]", ",", ',"z":1', ',"z":1}', ',"z":1}x', "]x", "}x", ",1]", ",{}]", ',{"a":1}', "}]", "]}",
             ",]", ",}", " ", "\t", ":", '"', "{", "[", ']},"k":[', '"}', "null", ",null"]
    rnd = random.Random(77)
    lines = []
    for _ in range(5000):
        obj = {f"k{rnd.randrange(4)}": _value(rnd) for _ in range(rnd.randrange(3))}
        s = json.dumps(obj, separators=rnd.choice([(",", ":"), (", ", ": ")]))
        for _ in range(rnd.randrange(3)):
            t = rnd.choice(tails)
            if rnd.random() < 0.6:
                s = s + t
            else:
                i = rnd.randrange(len(s) + 1)
                s = s[:i] + t + s[i:]
        lines.append(s.replace("\n", " "))
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "i int, value string")
    got = {r.i: r.is_valid for r in parse_records(df, keep_record=False).select("i", "is_valid").collect()}
    diffs = [(lines[i], got[i]) for i in range(len(lines)) if got[i] != py_valid(lines[i])]
    assert not diffs, diffs[:10]
