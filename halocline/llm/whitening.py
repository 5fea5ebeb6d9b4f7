"""Whitening of embeddings by their principal components.

Vectors become integers (floor of 256 times an entry by default), so that copies are equal and sums exact. The model is
fitted on each distinct vector once: one aggregation for the sums of all dimensions, one for the centred products of
every pair of dimensions of the upper triangle, each pair a Spark SQL expression. The covariance of d * d numbers is
assembled on the driver and decomposed by LAPACK; projections are SQL expressions again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored, table

SCALE = 256
COMPONENTS = 4
PAIRS = 4096  #: expressions of one aggregation: all pairs of 90 dimensions; more dimensions take further aggregations


@dataclass(frozen=True)
class Whitening:
    """n distinct vectors, their sums, and the components by falling eigenvalue, one a row."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def mean(self) -> list[float]:
        return [s / self.n for s in self.sums]

    def degenerate(self, k: int) -> bool:
        """Whether the data don't vary along component k, but for rounding: there is nothing to scale then."""
        return self.values[k] <= len(self.sums) * np.finfo(float).eps * max(self.values[0], 0.0)


def usable(rows: DataFrame, vector: str = "embedding", scale: float = SCALE, out: str = "_x") -> DataFrame:
    """Rows whose vector has a finite number in every place, with the vector as longs: floor(scale * entry).

    The number of places is what most of these rows have (of equal counts, the greater); a vector of another length lacks
    places, or has some that the others lack, and is dropped like one with nulls. Floors beyond a long are its bounds.
    """
    x = F.col(vector).cast("array<double>")
    whole = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    fit = rows.where(whole)
    lengths = fit.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return fit.where(F.size(vector) == d).withColumn(out, F.transform(x, lambda c: F.floor(c * F.lit(float(scale))) + F.lit(0).cast("long")))


def distinct_vectors(rows: DataFrame, x: str = "_x") -> DataFrame:
    """The fit list, stored: each distinct vector once. Copies fold before they are shuffled."""
    return stored(rows.select(x).distinct(), "vectors")


def centred(x: str, mean: Sequence[float]) -> list[Column]:
    return [(F.col(x)[i].cast("double") - F.lit(m)).alias(f"_c{i}") for i, m in enumerate(mean)]


def covariance(vectors: DataFrame, n: int, mean: Sequence[float], x: str = "_x", pairs: int = PAIRS) -> np.ndarray:
    """The covariance (divisor n): sums of centred products, every pair of dimensions an expression of one aggregation.

    Beyond `pairs` pairs the triangle is dealt over aggregations of that many expressions, since a plan of hundreds of
    thousands can't be compiled; each reads the stored vectors.
    """
    every, out = list(combinations_with_replacement(range(len(mean)), 2)), np.zeros((len(mean), len(mean)))
    for at in range(0, len(every), pairs):
        part = every[at : at + pairs]
        used = sorted({i for p in part for i in p})
        columns = centred(x, mean)
        sums = vectors.select(*(columns[i] for i in used)).selectExpr(*(f"sum(_c{i} * _c{j}) as s{i}_{j}" for i, j in part)).first()
        for (i, j), s in zip(part, sums, strict=True):
            out[i, j] = out[j, i] = s / n
    return out


def fit(vectors: DataFrame, x: str = "_x") -> Whitening | None:
    """The model of a table of distinct vectors of one length; None for an empty one."""
    first = vectors.select(F.size(x)).first()
    if first is None:
        return None
    # Sums of longs can pass a long, so they are summed as decimals.
    found = vectors.agg(F.count("*"), *(F.sum(F.col(x)[i].cast("decimal(20,0)")) for i in range(first[0]))).first()
    n, sums = found[0], tuple(int(s) for s in found[1:])
    v = covariance(vectors, n, [s / n for s in sums], x)
    values, columns = np.linalg.eigh(v)
    return Whitening(n, sums, values[::-1].copy(), columns.T[::-1].copy(), float(np.trace(v)))


def projected(model: Whitening, k: int, x: str = "_x") -> Column:
    """The whitened value of component k (from 0): null where the data don't vary along it."""
    if model.degenerate(k):
        return F.lit(None).cast("double")
    terms = F.zip_with(F.zip_with(F.col(x), F.array(*map(F.lit, model.mean())), lambda a, m: a.cast("double") - m), F.array(*(F.lit(float(v)) for v in model.vectors[k])), lambda a, v: a * v)
    return F.aggregate(terms, F.lit(0.0), lambda total, t: total + t) / F.lit(float(np.sqrt(model.values[k])))


def deviation(model: Whitening, x: str = "_x") -> Column:
    """sum of (n * x - S)^2 over the dimensions, exact; null where it passes a long."""
    big = [s for s in model.sums if not -(1 << 63) <= s < 1 << 63]
    if big:
        return F.lit(None).cast("long")
    n = F.lit(model.n).cast("long")
    apart = F.zip_with(F.col(x), F.array(*(F.lit(s).cast("long") for s in model.sums)), lambda a, s: F.try_subtract(F.try_multiply(n, a), s))
    return F.aggregate(apart, F.lit(0).cast("long"), lambda total, a: F.try_add(total, F.try_multiply(a, a)))


def identity_error(vectors: DataFrame, model: Whitening, k: int, x: str = "_x") -> float | None:
    """How far the covariance of the first k whitened components over the fit list is from the identity, at most in any entry."""
    real = [j for j in range(k) if not model.degenerate(j)]
    if not real:
        return None
    pairs = list(combinations_with_replacement(real, 2))
    found = vectors.select(*(projected(model, j, x).alias(f"w{j}") for j in real)).agg(*(F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs)).first()
    return max(abs(c - (i == j)) for (i, j), c in zip(pairs, found, strict=True))


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: float = SCALE) -> DataFrame:
    """The usable rows with `whitened` (an array of up to `components` values), `explained` (their shares of the variance),
    `n`, `deviation` and `identity_error`.

    A row whose vector is null, empty, of another length than most, or holds a null, NaN or infinity is dropped. Repeated
    rows stay repeated and count once in the fit; so do copies of a vector under other ids. Further columns stay; those of
    the names above are replaced. Vectors of fewer dimensions than `components` give as many values as they have
    dimensions; along a component without variance the value is null (equal vectors alone, or fewer vectors than
    dimensions), and without any variance `explained` and `identity_error` are null. Equal eigenvalues have some
    orthogonal pair of eigenvectors, the same for all rows. An empty table gives no rows.
    """
    kept = usable(rows.drop("whitened", "explained", "n", "deviation", "identity_error", "_x"), vector, scale)
    vectors = distinct_vectors(kept)
    model = fit(vectors)
    if model is None:
        shares = F.array().cast("array<double>")
        return kept.limit(0).drop("_x").withColumns({"whitened": shares, "explained": shares, "n": F.lit(0).cast("long"), "deviation": F.lit(0).cast("long"), "identity_error": F.lit(0.0)})
    k = min(components, len(model.sums))
    share = [float(v) / model.trace if model.trace > 0 else None for v in model.values[:k]]
    return kept.withColumns({
        "whitened": F.array(*(projected(model, j) for j in range(k))), "explained": F.array(*(F.lit(s).cast("double") for s in share)),
        "n": F.lit(model.n).cast("long"), "deviation": deviation(model), "identity_error": F.lit(identity_error(vectors, model, k)).cast("double"),
    }).drop("_x")


def query(spark, sf_dir: str) -> DataFrame:
    """A row for each usable row of embeddings and each of its first four components; see whiten()."""
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    each = F.posexplode(F.arrays_zip("whitened", "explained"))
    return found.select("vec_id", "n", "deviation", "identity_error", each.alias("at", "of")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error"
    )
