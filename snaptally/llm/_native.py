"""Expressions for native operators: spans of a pattern, and fitted trees as SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 128  # spans added up at once; keeps long lists of matches from costing their square

SPAN = "struct<s:int,e:int,v:string>"


def text_literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans(text: str, pattern: str) -> Column:
    """All matches of a Java pattern in a string column, from the left without
    overlap: an array of start, end (code points, end exclusive) and text.

    ``pattern`` must not match the empty string. A null text gives null.
    """
    p = text_literal(pattern)
    steps = (
        f"zip_with(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), "
        "(gap, v) -> named_struct('gap', char_length(gap), 'size', char_length(v), 'v', v))"
    )
    # the last piece has no match after it
    steps = f"filter({steps}, x -> x.v is not null)"
    blocks = f"transform(sequence(0, greatest(size({steps}) - 1, 0) div {_BLOCK}), b -> slice({steps}, b * {_BLOCK} + 1, {_BLOCK}))"
    inner = (
        f"aggregate(block, named_struct('at', acc.at, 'out', cast(array() as array<{SPAN}>)), (a, x) -> "
        "named_struct('at', a.at + x.gap + x.size, 'out', concat(a.out, array(named_struct('s', a.at + x.gap, 'e', a.at + x.gap + x.size, 'v', x.v)))))"
    )
    return F.expr(
        f"aggregate({blocks}, named_struct('at', 0, 'out', cast(array() as array<array<{SPAN}>>)), (acc, block) -> "
        f"aggregate(array({inner}), acc, (o, r) -> named_struct('at', r.at, 'out', concat(o.out, array(r.out)))), acc -> flatten(acc.out))"
    )


def tree_sql(node, names: list[str], row: str) -> str:
    """A fitted tree's node (a JVM object) as nested conditions on ``row``'s fields."""
    if node.getClass().getSimpleName() == "LeafNode":
        return repr(float(node.prediction()))
    split = node.split()
    field = f"{row}.{names[split.featureIndex()]}"
    return f"if({field} <= {float(split.threshold())!r}, {tree_sql(node.leftChild(), names, row)}, {tree_sql(node.rightChild(), names, row)})"


def forest_probability(model, names: list[str], row: str) -> str:
    """Probability of class 1 by a fitted random forest: the mean of the shares
    of class 1 in the leaves."""

    def walk(node) -> str:
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            return repr(stats[1] / max(sum(stats), 1e-300))
        split = node.split()
        field = f"{row}.{names[split.featureIndex()]}"
        return f"if({field} <= {float(split.threshold())!r}, {walk(node.leftChild())}, {walk(node.rightChild())})"

    trees = [walk(t._java_obj.rootNode()) for t in model.trees]
    return f"(({') + ('.join(trees)})) / {len(trees)}"


def boosted_probability(model, names: list[str], row: str) -> str:
    """Probability of class 1 by fitted boosted trees."""
    terms = [f"{float(w)!r} * ({tree_sql(t._java_obj.rootNode(), names, row)})" for t, w in zip(model.trees, model.treeWeights, strict=True)]
    return f"1.0 / (1.0 + exp(-2.0 * ({' + '.join(terms)})))"
