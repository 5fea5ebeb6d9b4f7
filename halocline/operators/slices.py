"""One long log over many tasks: slices of equal length with border rows of their neighbours.

Windows over a whole log put one instrument's samples into one task. Here a log is cut into slices of `rows` samples; each
slice also gets the `reach` samples before and after it, so that any window of that reach, lag or shift has what it needs.
Operators run on slices unchanged: they are given keys whose windows stay within a slice. Border rows are dropped again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .model import KEYS, Keys

ROWS = 1 << 20
PLACE, SLICE = "_place", "_slice"


@dataclass(frozen=True)
class SlicedKeys(Keys):
    """Keys whose windows stay within a slice of a log."""

    def log(self) -> WindowSpec:
        return Window.partitionBy(self.deployment, SLICE).orderBy(self.order)

    def cast(self) -> WindowSpec:
        return Window.partitionBy(self.deployment, self.profile, SLICE).orderBy(self.order)


def placed(df: DataFrame, rows: int = ROWS, keys: Keys = KEYS) -> DataFrame:
    """df with each sample's place in its log, from 0, without a window over the log.

    The order is a whole number that no two samples of a log share, so a stretch of `rows` numbers has at most as many
    samples. They are counted stretch by stretch; what goes before a stretch is a sum over stretches, the rest a row number
    within it. Numbers may be missing, but where few are there, stretches have few rows: then choose more `rows`.
    """
    dep, cell = keys.deployment, F.floor(F.col(keys.order) / F.lit(rows))
    own = df.withColumn("_cell", cell)
    counts = df.select(F.col(dep).alias("_log"), cell.alias("_stretch")).groupBy("_log", "_stretch").agg(F.count("*").alias("_n"))
    before = counts.select("_log", "_stretch", (F.sum("_n").over(Window.partitionBy("_log").orderBy("_stretch")) - F.col("_n")).alias("_before"))  # a row a stretch
    both = own.join(before, F.col(dep).eqNullSafe(F.col("_log")) & (F.col("_cell") == F.col("_stretch")))
    place = F.row_number().over(Window.partitionBy(dep, "_cell").orderBy(keys.order)) - 1 + F.col("_before")
    return both.withColumn(PLACE, place.cast("long")).select(*df.columns, PLACE)


def sliced(df: DataFrame, reach: int, rows: int = ROWS, keys: Keys = KEYS) -> DataFrame:
    """df, with places, as slices with borders: each row under every slice that needs it, in `_slice`; `_own` tells whose it is.

    Slices are dealt by ranges: tasks get neighbouring slices, and as many as the others. Windows over a slice need no
    further exchange.
    """
    p = F.col(PLACE)
    needed = F.sequence(F.greatest(F.floor((p - reach) / rows), F.lit(0).cast("long")), F.floor((p + reach) / rows))
    every = df.select("*", F.explode(needed).alias(SLICE))
    return every.withColumn("_own", F.col(SLICE) == F.floor(p / rows)).repartitionByRange(keys.deployment, SLICE)


def in_slices(df: DataFrame, reach: int, work: Callable[[DataFrame, Keys], DataFrame], rows: int | None = ROWS, keys: Keys = KEYS) -> DataFrame:
    """work(df, keys) on slices of each log, without the border rows it also saw.

    reach: how many samples before or after a sample its result depends on. work must keep all rows and columns it is given.
    If df has places (see placed), they are used and kept. Without `rows` work gets whole logs.
    """
    if rows is None:
        return work(df, keys)
    known = PLACE in df.columns
    cut = sliced(df if known else placed(df, rows, keys), reach, rows, keys)
    done = work(cut, SlicedKeys(keys.deployment, keys.profile, keys.order)).where("_own").drop(SLICE, "_own")
    return done if known else done.drop(PLACE)
