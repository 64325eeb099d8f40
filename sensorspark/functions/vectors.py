"""Expressions over array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("array<double>")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A lambda body re-evaluates whatever it refers to for every element; binding the value
    as the single element of an array keeps per-row constants out of inner loops.
    """
    return F.transform(F.array(value), body)[0]


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))


def l2_normalize(v: Column, epsilon: float | None = None) -> Column:
    """Divide by the norm; a zero norm counts as 1, or add ``epsilon`` instead."""

    def divisor(n: Column) -> Column:
        return F.when(n == 0, F.lit(1.0)).otherwise(n) if epsilon is None else n + F.lit(epsilon)

    return let(norm(v), lambda n: let(divisor(n), lambda d: F.transform(v, lambda x: x / d)))


def z_normalize(v: Column, epsilon: float = 1e-9) -> Column:
    """Per-window z-normalisation with the population deviation."""

    def scaled(centred: Column) -> Column:
        square = F.aggregate(centred, F.lit(0.0), lambda a, x: a + x * x)
        std = F.sqrt(square / F.size(centred)) + F.lit(epsilon)
        return let(std, lambda s: F.transform(centred, lambda x: x / s))

    mean = F.aggregate(v, F.lit(0.0), lambda a, x: a + x) / F.size(v)
    return let(let(mean, lambda m: F.transform(v, lambda x: x - m)), scaled)


def mean_abs_difference(a: Column, b: Column) -> Column:
    parts = F.zip_with(a, b, lambda x, y: F.abs(x - y))
    return let(parts, lambda p: F.aggregate(p, F.lit(0.0), lambda s, x: s + x) / F.size(p))


def euclidean(a: Column, b: Column) -> Column:
    return norm(F.zip_with(a, b, lambda x, y: x - y))


def concat_channels(vectors: Column) -> Column:
    """Channel vectors, in order, as one joint vector."""
    return F.flatten(vectors)
