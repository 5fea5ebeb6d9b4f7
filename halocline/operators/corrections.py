"""Projections, filters, and corrections of raw channels as window expressions over one sort."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from .model import KEYS, Keys, require, require_floating
from .slices import in_slices
from .tables import Tally


def select_channels(df: DataFrame, channels: Sequence[str], keys: Keys = KEYS, time: str = "time") -> DataFrame:
    """The keys, the time, and exactly these channels; all of them if none is named."""
    if not channels:
        return df
    require(df, channels, "Cannot read channels")
    return df.select(*[c for c in (keys.deployment, keys.order, time) if c in df.columns], *channels)


def time_range(df: DataFrame, start: datetime | None, end: datetime | None, time: str = "time") -> DataFrame:
    """Rows from start to end, both included; start must be before end."""
    if start is not None and end is not None and not start < end:
        raise ValueError(f"start_time ({start}) must be before end_time ({end}).")
    if start is not None:
        df = df.where(F.col(time) >= F.lit(start))
    return df.where(F.col(time) <= F.lit(end)) if end is not None else df


def value_range(df: DataFrame, channel: str, least: float | None, most: float | None) -> DataFrame:
    """Rows whose value is within the bounds, both included; missing values go if there is a bound."""
    if least is not None:
        df = df.where(F.col(channel) >= least)
    return df.where(F.col(channel) <= most) if most is not None else df


def subset_slice(df: DataFrame, start: int, stop: int, step: int = 1, keys: Keys = KEYS) -> DataFrame:
    """Samples at places start, start + step, ... below stop of each deployment, from 0."""
    place = F.row_number().over(keys.log()) - 1
    return df.withColumn("_place", place).where((F.col("_place") >= start) & (F.col("_place") < stop) & ((F.col("_place") - start) % step == 0)).drop("_place")


def subset_places(df: DataFrame, places: Sequence[int], keys: Keys = KEYS) -> DataFrame:
    """Samples at these places of each deployment; the places must ascend, since time must."""
    if any(a >= b for a, b in zip(places, places[1:], strict=False)):
        raise ValueError("time must be strictly increasing.")
    wanted = df.sparkSession.createDataFrame([(int(p),) for p in places], "_place int")
    return df.withColumn("_place", F.row_number().over(keys.log()) - 1).join(wanted, "_place", "left_semi").drop("_place")


def monotonic(df: DataFrame, channel: str, keys: Keys = KEYS) -> DataFrame:
    """(deployment, increasing, decreasing, monotonic): strict; true for fewer than two samples."""
    before = F.lag(channel).over(keys.log())
    steps = df.select(keys.deployment, F.coalesce(F.col(channel) > before, F.lit(True)).alias("up"), F.coalesce(F.col(channel) < before, F.lit(True)).alias("down"))
    both = steps.groupBy(keys.deployment).agg(F.every("up").alias("increasing"), F.every("down").alias("decreasing"))
    return both.withColumn("monotonic", F.col("increasing") | F.col("decreasing"))


def add_channel(df: DataFrame, name: str, value: Column) -> DataFrame:
    if name == "time" or name in df.columns:
        raise ValueError(f"channel {name!r} already exists or is reserved.")
    return df.withColumn(name, value)


def remove_channel(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise KeyError(name)
    return df.drop(name)


def held(x: Column, w: WindowSpec) -> Column:
    """Whether the value equals the original one before it; a missing value ends a run."""
    return F.coalesce(x == F.lag(x).over(w), F.lit(False))


def without_holds(x: Column, w: WindowSpec) -> Column:
    return F.when(held(x, w), F.lit(None)).otherwise(x)


def shifted(x: Column, shift: int, w: WindowSpec) -> Column:
    """The value `shift` samples earlier (later, if negative), missing outside."""
    return x if shift == 0 else F.lag(x, shift).over(w)


@dataclass(frozen=True)
class Correction:
    """holds first, then shift, then offset."""

    remove_holds: bool = True
    shift: int | None = None
    offset: float | None = None


def correct(df: DataFrame, channels: Mapping[str, Correction], keys: Keys = KEYS, rows: int | None = None, tally: Tally | None = None) -> DataFrame:
    """All channels in three projections over one window: holds, shifts, offsets. rows: logs are worked on in slices of so many samples.

    tally gets the held values of each channel, under "held".
    """
    require_floating(df, channels, "Cannot correct channels")
    reach = 1 + max([0, *(abs(s.shift or 0) for s in channels.values())])
    marks = {c: f"_held_{c}" for c, s in channels.items() if s.remove_holds and tally is not None}
    done = in_slices(df, reach, lambda part, k: _corrected(part, channels, k.log(), marks), rows, keys)
    return tally.watch(done, "held", {c: F.col(m) for c, m in marks.items()}).drop(*marks.values()) if marks else done


def _corrected(df: DataFrame, channels: Mapping[str, Correction], w: WindowSpec, marks: Mapping[str, str]) -> DataFrame:
    holds = {m: held(F.col(c), w) for c, m in marks.items()} | {c: without_holds(F.col(c), w) for c, s in channels.items() if s.remove_holds}
    shifts = {c: shifted(F.col(c), s.shift, w) for c, s in channels.items() if s.shift}
    offsets = {c: F.col(c) + F.lit(float(s.offset)) for c, s in channels.items() if s.offset is not None}
    for step in (holds, shifts, offsets):
        df = df.withColumns(step) if step else df
    return df


def hold_counts(df: DataFrame, channels: Sequence[str], keys: Keys = KEYS) -> DataFrame:
    """(deployment, one count a channel): held values, in one aggregation."""
    w = keys.log()
    marks = df.select(keys.deployment, *(held(F.col(c), w).cast("long").alias(c) for c in channels))
    return marks.groupBy(keys.deployment).agg(*(F.sum(c).alias(c) for c in channels))


def sea_pressure(df: DataFrame, atmospheric: float | None, absolute: str = "absolute_pressure", out: str = "sea_pressure") -> DataFrame:
    """absolute - atmospheric, replacing what is there; without a number the channel must be there already."""
    if atmospheric is None:
        require(df, [out], "No atmospheric pressure is set")
        return df
    require(df, [absolute], "Cannot compute sea pressure")
    return df.withColumn(out, F.col(absolute) - F.lit(float(atmospheric)))
