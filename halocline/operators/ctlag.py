"""The lag between conductivity and temperature: every lag of a range is tried, the smoothest salinity wins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.seawater import with_sp_from_c
from .corrections import shifted, value_range
from .model import KEYS, Keys, finite, require
from .slices import in_slices


@dataclass(frozen=True)
class LagSearch:
    enabled: bool = False
    least_pressure: float | None = None
    most_pressure: float | None = None
    window: int = 21
    min_lag: int = -20
    max_lag: int = 20

    def __post_init__(self) -> None:
        if self.window % 2 == 0:
            raise ValueError(f"the window must be odd; got {self.window}.")
        if self.min_lag > self.max_lag:
            raise ValueError(f"min_lag ({self.min_lag}) must be <= max_lag ({self.max_lag}).")


def moving_mean(x: Column, window: int, w: WindowSpec) -> Column:
    """Centred, clipped at the ends, missing values left out."""
    return F.avg(x).over(w.rowsBetween(-(window // 2), window // 2))


def lag_scores(df: DataFrame, settings: LagSearch, salinity: Callable[[DataFrame, str, str, str, str], DataFrame] = with_sp_from_c, conductivity: str = "electrical_conductivity", temperature: str = "temperature", pressure: str = "sea_pressure", keys: Keys = KEYS) -> DataFrame:
    """(deployment, lag, score): the population standard deviation of salinity about its moving mean, over all spans.

    Spans are profiles within the pressure bounds; shifting happens within them. The lags share one sort for the shifts; the
    moving means sort the rows of each lag again.
    """
    require(df, [conductivity, temperature, pressure], "Cannot find the lag")
    spans = value_range(df, pressure, settings.least_pressure, settings.most_pressure)
    lags = range(settings.min_lag, settings.max_lag + 1)
    w = keys.cast()
    tried = spans.select(keys.deployment, keys.profile, keys.order, temperature, pressure, F.array(*(F.struct(F.lit(k).alias("lag"), shifted(F.col(conductivity), k, w).alias("c")) for k in lags)).alias("_lags"))
    rows = tried.select("*", F.inline("_lags")).drop("_lags")
    rows = salinity(rows, "_s", "c", temperature, pressure)
    by_lag = Window.partitionBy(keys.deployment, keys.profile, "lag").orderBy(keys.order)
    left = rows.select(keys.deployment, "lag", finite(F.col("_s") - moving_mean(F.col("_s"), settings.window, by_lag)).alias("_r"))
    return left.groupBy(keys.deployment, "lag").agg(F.stddev_pop("_r").alias("score"))


def best_lags(scores: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """(deployment, lag): the least score; of equal ones the lag nearest 0, the negative first. Without a score the lag is missing."""
    rank = F.struct("score", F.abs("lag"), "lag")
    return scores.groupBy(keys.deployment).agg(F.min_by("lag", F.when(F.col("score").isNotNull(), rank)).alias("lag"))


def apply_lags(df: DataFrame, lags: DataFrame, conductivity: str = "electrical_conductivity", keys: Keys = KEYS, rows: int | None = None) -> DataFrame:
    """Shifts each whole deployment by its own lag; without one it stays. rows: logs are worked on in slices of so many samples.

    A shift must be the same for a plan, so each of the lags that occur is a column of one window, and a row takes its own.
    Which occur is read first: they are the whole numbers of a search range, whatever the number of deployments.
    """
    some = sorted(r[0] for r in lags.select("lag").distinct().collect() if r[0])
    if not some:
        return df

    def shift(part: DataFrame, k: Keys) -> DataFrame:
        c = F.col(conductivity)
        return part.withColumn("_c", reduce(lambda so_far, lag: so_far.when(F.col("_lag") == lag, shifted(c, lag, k.log())), some, F.when(F.lit(False), c)).otherwise(c))

    own = df.join(lags.select(F.col(keys.deployment).alias("_d"), F.coalesce("lag", F.lit(0)).alias("_lag")), F.col(keys.deployment).eqNullSafe(F.col("_d")), "left")
    done = in_slices(own.drop("_d").withColumn("_lag", F.coalesce("_lag", F.lit(0))), max(map(abs, some)), shift, rows, keys)
    return done.withColumn(conductivity, F.col("_c")).select(df.columns)
