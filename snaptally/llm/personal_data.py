"""Personal data by candidate gradient boosting, in DataFrame expressions only.

Base spans (email, ip, card, phone) are found by their patterns and checks and always
stay. Generators of high recall propose more spans, which may overlap. Boosted trees
score each by its format and context; per-generator thresholds, calibrated for
precision on candidates that were not trained on, select the spans added.

Written-out mail addresses, IPv6 addresses and account numbers (IBAN) that their own
rule settles are spans too. The labels are these rules and the base rules: a proposal
that a span confirms is positive, any other negative, but kinds that the base rules
don't know are left out where no context speaks against them. The trees don't see the rules' verdict, only shape and
context, so they add proposals that look and stand like confirmed ones. The fitted trees
become one SQL expression over the array of proposals; scoring needs no shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._native import boosted_probability, spans
from ._shared import written

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base kinds. A match can begin only where a run of its first
# characters begins (or where the match before ended), so runs are read once;
# possessive repeats keep long runs from going back.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# a cheap test that any match needs
_HINT = {"email": "contains({t}, '@')", "ip": "{d}", "card": "{d}", "phone": "contains({t}, '+') and {d}"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

# High recall: written-out mail addresses, digit groups with any separators, numbers
# with a national prefix, colon groups of an IPv6 address, letter-digit account numbers.
GENERATORS = {
    "mail_like": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}+){1,8}+", "({t} like '%@%' or {t} like '%(at)%' or {t} like '%[at]%')"),
    "number_like": (r"(?<![0-9])[+(]?[0-9](?:[\x20()./-]{0,2}+[0-9]){7,24}+", "{d}"),
    "address_like": (r"(?<![0-9A-Fa-f:.])(?:[0-9]{1,4}(?:\.[0-9]{1,4}){3}+|[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){3,7}+)", "{d}"),
    "account_like": (r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+", "{d}"),
}
# What a generator's own rule settles without the trees: written-out mail addresses with
# a known ending, IPv6 addresses, account numbers of their country's length (IBAN)
_IBAN = {15: "NO", 16: "BE", 18: "DK|FI|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG", 25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU", 31: "MT|SC", 33: "RU", 32: "LC"}
_ENDING = "(?i:com|org|net|edu|gov|mil|int|info|biz|name|dev|app|xyz|online|site|tech|cloud|[a-z]{2})"
_H = "[0-9A-Fa-f]{1,4}"
OWN = {
    "mail_like": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]{{1,64}}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{{1,63}}+(?:(?:\.| ?(?:\(dot\)|\[dot\]) ?)[A-Za-z0-9-]{{1,63}}+){{0,7}}(?:\.| ?(?:\(dot\)|\[dot\]) ?){_ENDING}(?![A-Za-z0-9_-])",
    "address_like": rf"(?<![0-9A-Za-z:.])(?:{_H}(?::{_H}){{7}}|{_H}(?::{_H}){{0,6}}::(?:{_H}(?::{_H}){{0,5}})?)(?![0-9A-Za-z:])",
    "account_like": "(?<![A-Za-z0-9])(?:" + "|".join(rf"(?:{c})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in sorted(_IBAN.items())) + ")(?![A-Za-z0-9])",
}


def _mod97(text: str) -> str:
    """The remainder of an account number, its first four places moved to the end."""
    turned = f"concat(substring({text}, 5), substring({text}, 1, 4))"
    return (
        f"aggregate(sequence(1, length({text})), 0, (r, i) -> if(substring({turned}, i, 1) rlike '[0-9]', "
        f"(r * 10 + cast(substring({turned}, i, 1) as int)) % 97, (r * 100 + ascii(substring({turned}, i, 1)) - 55) % 97))"
    )


_OWN_RULE = {
    "mail_like": "not contains(x.v, '@')",
    # eight pairs are a hardware address as well
    "address_like": "not x.v rlike '^[0-9A-Fa-f]{2}(:[0-9A-Fa-f]{2}){7}$' and size(filter(split(x.v, ':'), p -> p <> '')) between 3 and 8 and x.v rlike '[0-9]'",
    "account_like": _mod97("replace(x.v, ' ', '')") + " = 1",
}
FEATURES = ("generator", "length", "digits", "letters", "separators", "groups", "luhn", "distinct", "ends_word", "after_mark", "cue", "hexish")
_CUE = "(?i)(mail|phone|tel|call|fax|card|visa|pay|ip|host|addr|contact|account|iban|ssn|id)[^a-z]{0,3}$"

TASK_ROWS = 200_000  #: different candidates that one task of the fit holds
MOST_VALUES = 1024  #: more than any feature has values, by the bounds in the patterns
PRECISION = 0.95


def _luhn(digits: str) -> str:
    """Whether a string of digits passes the Luhn check; false for other lengths than 12 to 19."""
    total = (
        f"aggregate(sequence(1, length({digits})), 0, (sum, i) -> sum + if(i % 2 = 1, cast(substring(reverse({digits}), i, 1) as int), "
        f"2 * cast(substring(reverse({digits}), i, 1) as int) - if(cast(substring(reverse({digits}), i, 1) as int) > 4, 9, 0)))"
    )
    return f"if(length({digits}) between 12 and 19, {total} % 10 = 0, false)"


def _checked(kind: str, column: str) -> str:
    digits = "regexp_replace(x.v, '[^0-9]', '')"
    rule = {
        "email": None,
        "ip": f"x.v rlike '^{_PART}(?:[.]{_PART}){{3}}$'",
        "card": _luhn(digits),
        "phone": f"length({digits}) between 9 and 15",
    }[kind]
    return f"filter({column}, x -> {rule})" if rule else column


def _with_base(docs: DataFrame) -> DataFrame:
    """Adds ``base``: an array of ``s, k, e`` in the order of the digest."""
    empty = "cast(array() as array<struct<s:int,e:int,v:string>>)"
    none = F.expr(empty)
    found = docs.withColumn("__digit", F.expr("__text rlike '[0-9]'"))
    found = found.withColumns({f"__{k}": F.when(F.expr(_HINT[k].format(t="__text", d="__digit")), spans("__text", p)).otherwise(none) for k, p in BASE.items()})
    arrays = ", ".join(f"transform({_checked(k, f'__{k}')}, x -> struct(x.s as s, {i} as k, x.e as e))" for i, k in enumerate(KINDS))
    return found.withColumn("base", F.expr(f"array_sort(concat({arrays}))")).drop(*[f"__{k}" for k in KINDS])


def _with_candidates(docs: DataFrame) -> DataFrame:
    """Adds ``own``: spans that a generator's own rule settles, and ``candidates``:
    proposals with their features, whether a base or own span confirms them (covers
    them, or is covered by them), and whether else no rule could tell."""
    none = F.expr("cast(array() as array<struct<s:int,e:int,v:string>>)")
    found = docs.withColumns({f"__{g}": F.when(F.expr(hint.format(t="__text", d="__digit")), spans("__text", p)).otherwise(none) for g, (p, hint) in GENERATORS.items()})
    arrays = ", ".join(f"transform(__{g}, x -> struct(x.s as s, x.e as e, {i} as g, x.v as v))" for i, g in enumerate(GENERATORS))
    hints = {g: GENERATORS[g][1].format(t="__text", d="__digit") for g in OWN}
    found = found.withColumns({f"__own_{g}": F.when(F.expr(hints[g]), spans("__text", p)).otherwise(none) for g, p in OWN.items()})
    own = ", ".join(f"transform(filter(__own_{g}, x -> {_OWN_RULE[g]}), x -> struct(x.s as s, {len(KINDS) + list(GENERATORS).index(g)} as k, x.e as e))" for g in OWN)
    found = found.withColumn("own", F.expr(f"concat({own})")).drop(*[f"__own_{g}" for g in OWN])
    found = found.withColumn("__all", F.expr(f"concat({arrays})")).drop(*[f"__{g}" for g in GENERATORS])
    # the 24 characters before and the one after
    around = "transform(__all, x -> struct(x.s as s, x.e as e, x.g as g, x.v as v, substring(__text, greatest(x.s - 23, 1), least(x.s, 24)) as before, substring(__text, x.e + 1, 1) as after, regexp_replace(x.v, '[^0-9]', '') as d))"
    found = found.withColumn("__all", F.expr(around))
    features = {
        "generator": "cast(x.g as double)",
        "length": "cast(x.e - x.s as double)",
        "digits": "cast(length(x.d) as double)",
        "letters": "cast(length(regexp_replace(x.v, '[^A-Za-z]', '')) as double)",
        "separators": "cast(length(regexp_replace(x.v, '[A-Za-z0-9]', '')) as double)",
        "groups": "cast(size(split(x.v, '[^A-Za-z0-9]+')) as double)",
        "luhn": f"if({_luhn('x.d')}, 1.0D, 0.0D)",
        "distinct": "cast(size(array_distinct(split(x.d, ''))) as double)",
        "ends_word": "if(x.after rlike '[A-Za-z0-9_]', 1.0D, 0.0D)",
        "after_mark": "if(x.before rlike '[A-Za-z0-9_=\"/]$', 1.0D, 0.0D)",
        "cue": f"if(x.before rlike '{_CUE}', 1.0D, 0.0D)",
        "hexish": "if(x.before rlike '[0-9a-f]{2}$' or x.after rlike '[0-9a-f]', 1.0D, 0.0D)",
    }
    fields = ", ".join(f"{e} as {n}" for n, e in features.items())
    # the base rules don't know these kinds: no span of theirs says nothing, but a hash, version or id around does
    unknown = f"((x.g = 3 or (x.g = 2 and contains(x.v, ':')) or (x.g = 0 and not contains(x.v, '@'))) and {features['ends_word']} + {features['after_mark']} + {features['hexish']} = 0)"
    scored = f"transform(__all, x -> struct(x.s as s, x.e as e, x.g as g, {fields}, exists(concat(base, own), b -> (b.s <= x.s and b.e >= x.e) or (b.s >= x.s and b.e <= x.e)) as confirmed, {unknown} as unknown))"
    return found.withColumn("candidates", F.expr(scored)).drop("__all")


def fit(candidates: DataFrame, *, precision: float = PRECISION, seed: int = 11) -> tuple[str, list[float]] | None:
    """The trees as an SQL expression on a struct ``x``, and the threshold of
    each generator; None if there are no candidates of both labels.

    ``candidates`` holds the features and ``confirmed``. All are used: four of five, by
    a hash of their features, for the trees, the rest for the thresholds. Candidates of
    equal features and label are one row weighted by their count. A threshold is the
    least score from which on all score bands of its generator hold the wanted
    precision (with one failure added to each band); above 1 if no band does.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    fold = F.pmod(F.xxhash64("id", "s", *FEATURES), F.lit(5))
    counted = written(candidates.groupBy("g", *FEATURES, F.col("confirmed").cast("double").alias("label"), (fold == 4).alias("apart")).agg(F.count("*").alias("weight")))
    train = counted.filter("not apart")
    n = train.count()
    if train.select("label").distinct().count() < 2:
        return None
    # sums in a fixed order as long as the rows fit one task
    spread = train.repartition(-(-n // TASK_ROWS), *FEATURES).sortWithinPartitions(*FEATURES, "label")
    shaped = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(spread).select("features", "label", "weight")
    # the library looks for splits in maxBins ** 2 rows: all of them
    bins = max(MOST_VALUES, math.isqrt(n) + 1)
    model = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.2, maxBins=bins, weightCol="weight", seed=seed).fit(shaped)
    score = boosted_probability(model, list(FEATURES), "x")
    bands = (
        counted.filter("apart").select("g", "label", "weight", F.expr(f"transform(array(struct({', '.join(FEATURES)})), x -> {score})[0]").alias("p"))
        .withColumn("band", F.floor(F.least(F.col("p"), F.lit(0.999)) * 20))
        .groupBy("g", "band").agg(F.sum(F.col("label") * F.col("weight")).alias("yes"), F.sum("weight").alias("all")).collect()
    )
    limits = [2.0] * len(GENERATORS)
    for g in range(len(GENERATORS)):
        for b in sorted((b for b in bands if b["g"] == g), key=lambda b: -b["band"]):
            if b["yes"] / (b["all"] + 1) < precision:
                break
            limits[g] = b["band"] / 20
    return score, limits


def find(documents: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), precision: float = PRECISION) -> DataFrame:
    """The columns named in ``keep``, then ``n_email, n_ip, n_card, n_phone``,
    ``base_sha256``, ``spans`` (``kind:start:end``, code points, by start, then kind)
    and ``found`` (the same as an array of ``s, k, e``) of every whole ``text``.

    Kinds 0 to 3 are :data:`KINDS`, the next are :data:`GENERATORS`. A null or empty
    text has no spans. Rows may repeat; an empty table gives an empty result;
    columns not named are ignored.
    """
    docs = documents.select(*[F.col(c).alias(f"k_{i}") for i, c in enumerate(keep)], F.coalesce(F.col("text"), F.lit("")).alias("__text"))
    held = written(_with_candidates(_with_base(docs)).drop("__text", "__digit"))
    each = held.select(F.col("k_0").alias("id"), F.explode("candidates").alias("c")).select("id", "c.*").filter("confirmed or not unknown")
    fitted = fit(each, precision=precision)
    if fitted is None:
        added = F.expr("cast(array() as array<struct<s:int,k:int,e:int>>)")
    else:
        score, limits = fitted
        limit = f"element_at(array({', '.join(f'{x!r}D' for x in limits)}), x.g + 1)"
        added = F.expr(f"transform(filter(candidates, x -> not x.confirmed and {score} >= {limit}), x -> struct(x.s as s, x.g + {len(KINDS)} as k, x.e as e))")
    names = ", ".join(f"'{n}'" for n in (*KINDS, *GENERATORS))
    label = f"transform({{}}, x -> concat(element_at(array({names}), x.k + 1), ':', x.s, ':', x.e))"
    return (
        held.withColumn("found", F.array_sort(F.concat("base", "own", added)))
        .select(
            *[F.col(f"k_{i}").alias(c) for i, c in enumerate(keep)],
            *[F.expr(f"cast(size(filter(base, x -> x.k = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)],
            F.sha2(F.expr(f"array_join({label.format('base')}, ',')"), 256).alias("base_sha256"),
            F.expr(f"array_join({label.format('found')}, ',')").alias("spans"),
            "found",
        )
    )


def redact(text: str = "text", found: str = "found"):
    """The text with its spans replaced by ``[KIND]``; overlapping spans become
    one, named after the first."""
    names = ", ".join(f"'[{n.upper()}]'" for n in (*KINDS, *GENERATORS))
    merged = (
        f"aggregate({found}, cast(array() as array<struct<s:int,k:int,e:int>>), (acc, x) -> if(size(acc) > 0 and x.s < element_at(acc, -1).e, "
        "concat(slice(acc, 1, size(acc) - 1), array(named_struct('s', element_at(acc, -1).s, 'k', element_at(acc, -1).k, 'e', greatest(element_at(acc, -1).e, x.e)))), concat(acc, array(x))))"
    )
    return F.expr(
        f"if({text} is null or size({found}) = 0, {text}, aggregate({merged}, named_struct('at', 0, 'rest', {text}, 'out', cast(array() as array<string>)), "
        f"(a, x) -> named_struct('at', x.e, 'rest', substring(a.rest, x.e - a.at + 1), 'out', concat(a.out, array(substring(a.rest, 1, x.s - a.at), element_at(array({names}), x.k + 1)))), "
        "a -> concat(array_join(a.out, ''), a.rest)))"
    )


def op6_personal_data(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("found")
