"""Columns over score vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` worked out once, also where `use` mentions it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def softmax(logits: Column) -> Column:
    weights = bind(F.array_max(logits).cast("double"),
                   lambda peak: F.transform(logits, lambda x: F.exp(x.cast("double") - peak)))
    return bind(weights, lambda ws: bind(F.aggregate(ws, F.lit(0.0), lambda a, x: a + x),
                                         lambda total: F.transform(ws, lambda x: x / total)))


def topk_softmax(logits: Column, k: int = 3, labels: Column | None = None) -> Column:
    """The k most probable classes with their probabilities, best first, ties to the lower class."""
    ranked = F.slice(F.array_sort(F.transform(softmax(logits), lambda p, i: F.struct((-p).alias("p"), i.alias("i")))),
                     1, k)

    def entry(r: Column) -> Column:
        label = r["i"].cast("string") if labels is None else F.get(labels, r["i"])
        return F.struct(r["i"].alias("class_id"), label.alias("class"), (-r["p"]).alias("prob"))

    return F.transform(ranked, entry)


def best_class(probs: Column) -> Column:
    """0-based position of the largest score, first on ties."""
    return (F.array_position(probs, F.array_max(probs)) - 1).cast("int")


def best_score(probs: Column) -> Column:
    return F.array_max(probs)


def one_hot(index: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda x: (x == index).cast("int"))


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x.cast("double")))
