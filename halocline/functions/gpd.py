"""Maximum-likelihood fit of the generalised Pareto distribution with location 0."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTS = 65


def first_grid(top: float, mean: float, points: int = POINTS) -> np.ndarray:
    """Where the profile likelihood in theta is looked at first: densely near its bound and near 0."""
    near = np.geomspace(1e-6, 1.0, points)
    grid = np.concatenate([-(1 - near * 1e-3) / top, -near[::-1] / top * 0.999, near * 1e-3 / mean, near * 50.0 / mean])
    return np.unique(grid[grid > -1 / top])


def fit(x: np.ndarray, rounds: int = 8, points: int = POINTS) -> tuple[float, float]:
    """(shape, scale) of excesses x > 0 by the profile likelihood in theta = shape / scale (Grimshaw 1993).

    For a given theta the shape is the mean of log(1 + theta x). The best of a grid is refined between its neighbours.
    """
    x = np.asarray(x, float)
    top, mean = x.max(), x.mean()
    grid = first_grid(top, mean, points)

    def likelihood(theta: np.ndarray) -> np.ndarray:
        shape = np.array([np.log1p(t * x).mean() for t in theta])
        with np.errstate(divide="ignore", invalid="ignore"):
            value = -np.log(shape / theta) - shape - 1
        return np.where(np.isfinite(value) & (shape > -1), value, -np.inf)

    for _ in range(rounds):
        at = int(np.argmax(likelihood(grid)))
        low, high = grid[max(at - 1, 0)], grid[min(at + 1, len(grid) - 1)]
        best = grid[at]
        grid = np.linspace(low, high, points)
        grid = grid[grid != 0]
    shape = float(np.log1p(best * x).mean())
    return shape, shape / float(best)


def fits(df: DataFrame, group: str, excess: str, rounds: int = 6, points: int = POINTS) -> DataFrame:
    """(group, shape, scale): fit() of every group at once, without a group in one task.

    Each round is one aggregation: the mean of log(1 + theta x) at every theta of the group's grid, summed where the rows
    are and combined. The best theta of the grid is refined between its neighbours in the next round. df, whose excesses are
    above 0, is read once a round and once before, so it should be a stored table.
    """
    rows = df.select(F.col(group).alias("_g"), F.col(excess).cast("double").alias("_x"))
    near = [float(v) for v in np.geomspace(1e-6, 1.0, points)]
    a, b = F.col("_a"), F.col("_b")  # the greatest excess and the mean, then the ends of the grid
    first = [-(1 - v * 1e-3) / a for v in near] + [-v / a * 0.999 for v in near] + [v * 1e-3 / b for v in near] + [v * 50.0 / b for v in near]
    line = [a + (b - a) * float(j) / (points - 1) for j in range(points)]
    state = rows.groupBy("_g").agg(F.max("_x").alias("_a"), F.avg("_x").alias("_b"))
    for n in range(rounds):
        grid = line if n else first
        # Two numbers a group are sent to the rows. Rows stay where they are, and no group's are sorted: all that is kept are sums.
        sums = F.array(*(F.sum(F.log1p(t * F.col("_x"))) for t in grid))
        met = rows.join(F.broadcast(state.select("_g", "_a", "_b")), "_g").groupBy("_g", "_a", "_b").agg(F.count("_x").alias("_n"), sums.alias("_s"))
        thetas = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda j: a + (b - a) * j / (points - 1)) if n else F.array(*grid)
        every = F.array_sort(F.array_distinct(F.filter(F.zip_with(thetas, "_s", lambda t, s: F.struct(t.alias("t"), (s / F.col("_n")).alias("s"))), lambda c: (c["t"] != 0) & (F.lit(n > 0) | (c["t"] > -1 / a)))))
        found = met.select("_g", every.alias("_e")).withColumn("_v", F.transform("_e", lambda c: F.coalesce(_likelihood(c["s"], c["t"]), F.lit(float("-inf")))))
        found = found.withColumn("_at", F.array_position("_v", F.array_max("_v")).cast("int") - 1)
        low, best, high = F.get("_e", F.greatest(F.col("_at") - 1, F.lit(0))), F.get("_e", F.col("_at")), F.get("_e", F.least(F.col("_at") + 1, F.size("_e") - 1))
        state = found.select("_g", low["t"].alias("_a"), high["t"].alias("_b"), best["t"].alias("_best"), best["s"].alias("_shape"))
    return state.select(F.col("_g").alias(group), F.col("_shape").alias("shape"), (F.col("_shape") / F.col("_best")).alias("scale"))


def _likelihood(shape: Column, theta: Column) -> Column:
    """Of a theta and the shape that goes with it, less what is the same for all; null where there is none."""
    ratio = shape / theta
    return F.when((ratio > 0) & (shape > -1), -F.log(ratio) - shape - 1)
