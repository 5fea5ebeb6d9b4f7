"""Robust means of an array column, as higher-order functions: no rows leave the JVM.

Each takes an array of finite numbers and gives NULL for an empty one, and the plain mean for fewer than three.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METHODS = ("mean", "median", "trimmed_mean", "winsorized_mean", "huber", "biweight")


def _let(value: Column, f) -> Column:
    return F.get(F.transform(F.array(value), f), F.lit(0))


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, v: a + v)


def mean(x: Column) -> Column:
    return F.when(F.size(x) > 0, total(x) / F.size(x))


def median(x: Column) -> Column:
    def middle(s: Column) -> Column:
        half = F.floor(F.size(s) / 2).cast("int")
        return F.when(F.size(s) % 2 == 1, F.get(s, half)).otherwise((F.get(s, half - 1) + F.get(s, half)) / 2)

    return _let(F.array_sort(x), middle)


def trimmed_mean(x: Column, share: float = 0.2) -> Column:
    """Drops floor(n * share) values at either end."""

    def inner(s: Column) -> Column:
        n = F.size(s)
        cut = F.floor(n * F.lit(float(share))).cast("int")
        return F.when((n < 3) | (2 * cut >= n), mean(s)).otherwise(mean(F.slice(s, cut + 1, F.greatest(n - 2 * cut, F.lit(0)))))

    return _let(F.array_sort(x), inner)


def winsorized_mean(x: Column, share: float = 0.2) -> Column:
    """Replaces floor(n * share) values at either end by the nearest that is left."""

    def inner(s: Column) -> Column:
        n = F.size(s)
        cut = F.floor(n * F.lit(float(share))).cast("int")
        kept = F.slice(s, cut + 1, F.greatest(n - 2 * cut, F.lit(0)))
        return F.when((n < 3) | (2 * cut >= n), mean(s)).otherwise((total(kept) + cut * (F.get(s, cut) + F.get(s, n - 1 - cut))) / n)

    return _let(F.array_sort(x), inner)


def _scale(x: Column, at: Column) -> Column:
    return 1.4826 * median(F.transform(x, lambda v: F.abs(v - at)))


def _reweighted(x: Column, weight, max_iter: int, tol: float) -> Column:
    """From the median: weights by the residual over 1.4826 MAD, a new location and scale, until it settles.

    Some samples never settle and wander for all max_iter rounds, where the last digit of a sum would decide the result.
    So each location is rounded to a billionth of the first scale, a tenth of the default tolerance.
    """

    def step(acc: Column, _: Column) -> Column:
        def moved(w: Column) -> Column:
            located = lambda new: _let(_scale(x, new), lambda s: F.struct(new.alias("at"), s.alias("s"), acc["unit"].alias("unit"), ((s == 0) | (F.abs(new - acc["at"]) < F.lit(tol) * s)).alias("done")))
            mean_of = total(F.zip_with(w, x, lambda a, b: a * b)) / total(w)
            heavy = _let(F.floor(mean_of / acc["unit"] + 0.5) * acc["unit"], located)
            return F.when(total(w) == 0, stay).otherwise(heavy)

        stay = F.struct(acc["at"].alias("at"), acc["s"].alias("s"), acc["unit"].alias("unit"), F.lit(True).alias("done"))
        go = _let(F.transform(x, lambda v: weight((v - acc["at"]) / acc["s"])), moved)
        return F.when(acc["done"] | (acc["s"] == 0), stay).otherwise(go)

    start = _let(median(x), lambda m: _let(_scale(x, m), lambda s: F.struct(m.alias("at"), s.alias("s"), (s * 1e-9).alias("unit"), F.lit(False).alias("done"))))
    run = F.aggregate(F.sequence(F.lit(1), F.lit(max_iter)), start, step, lambda acc: acc["at"])
    return F.when(F.size(x) < 3, mean(x)).otherwise(run)


def huber(x: Column, k: float = 1.345, max_iter: int = 100, tol: float = 1e-8) -> Column:
    return _reweighted(x, lambda u: F.when(F.abs(u) <= k, F.lit(1.0)).otherwise(F.lit(float(k)) / F.abs(u)), max_iter, tol)


def biweight(x: Column, c: float = 4.685, max_iter: int = 100, tol: float = 1e-8) -> Column:
    return _reweighted(x, lambda u: F.when(F.abs(u) <= c, F.pow(1.0 - F.pow(u / c, F.lit(2.0)), F.lit(2.0))).otherwise(F.lit(0.0)), max_iter, tol)


def reduce(x: Column, method: str, **parameters: float) -> Column:
    """One of METHODS by name."""
    if method not in METHODS:
        raise ValueError(f"unknown bin method {method!r}; expected one of {', '.join(METHODS)}.")
    return globals()[method](x, **parameters)
