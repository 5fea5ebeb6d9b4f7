"""Profiles on a common grid: edges, assignment, robust reduction, full grid, attributes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import robust
from .model import KEYS, Keys, finite, require


def bin_edges(df: DataFrame, channel: str = "z", step: float = 1.0, first: float | None = None, last: float | None = None, keys: Keys = KEYS) -> DataFrame:
    """(deployment, first, step, n_bins): edges are first + step * i for i = 0 .. n_bins, and may go beyond the last value.

    A missing bound is the least or greatest finite value of the deployment, by the sign of the step. A deployment
    without finite values and bounds has NULLs, which bin_deployment refuses.
    """
    require(df, [channel], "Cannot bin")
    if step == 0:
        raise ValueError("step must not be 0.")
    x = finite(F.col(channel))
    low, high = (F.min(x), F.max(x)) if step > 0 else (F.max(x), F.min(x))
    found = df.groupBy(keys.deployment).agg((F.lit(float(first)) if first is not None else low).alias("first"), (F.lit(float(last)) if last is not None else high).alias("_last"))
    n = F.greatest(F.ceil((F.col("_last") - F.col("first")) / F.lit(float(step))), F.lit(1)).cast("int")
    return found.select(keys.deployment, "first", F.lit(float(step)).alias("step"), F.when(F.col("_last").isNotNull() & F.col("first").isNotNull(), n).alias("n_bins"))


def edge(i: Column) -> Column:
    """The i-th edge in ascending order, from the columns of bin_edges, by the arithmetic that defines it."""
    return F.when(F.col("step") > 0, F.col("first") + F.col("step") * i).otherwise(F.col("first") + F.col("step") * (F.col("n_bins") - i))


def with_bin(df: DataFrame, edges: DataFrame, channel: str = "z", keys: Keys = KEYS) -> DataFrame:
    """df with `bin` (from 0, ascending) and `bin_center`; rows outside every bin are dropped.

    Bins are (low, high], the lowest [low, high]. A quotient guesses the bin, and the exact edges beside it correct the guess.
    """
    x = finite(F.col(channel))
    both = df.join(edges, keys.deployment).where(x.isNotNull())
    guess = F.least(F.greatest(F.ceil((F.col(channel) - edge(F.lit(0))) / F.abs("step")) - 1, F.lit(0)), F.col("n_bins") - 1).cast("int")
    both = both.withColumn("bin", guess)
    both = both.withColumn("bin", F.when((F.col(channel) <= edge(F.col("bin"))) & (F.col("bin") > 0), F.col("bin") - 1).when((F.col(channel) > edge(F.col("bin") + 1)) & (F.col("bin") < F.col("n_bins") - 1), F.col("bin") + 1).otherwise(F.col("bin")))
    low, high = edge(F.col("bin")), edge(F.col("bin") + 1)
    inside = (F.col(channel) <= high) & ((F.col(channel) > low) | ((F.col("bin") == 0) & (F.col(channel) == low)))
    return both.where(inside).withColumn("bin_center", (low + high) / 2).drop("first", "step", "n_bins")


def grid(profiles: DataFrame, edges: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """(deployment, profile, bin, bin_center): every bin of every profile."""
    both = profiles.select(keys.deployment, keys.profile).distinct().join(edges.where("n_bins is not null"), keys.deployment)
    rows = both.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)))
    return rows.select(keys.deployment, keys.profile, "bin", ((edge(F.col("bin")) + edge(F.col("bin") + 1)) / 2).alias("bin_center"))


def reduce_bins(binned: DataFrame, methods: Mapping[str, tuple[str, Mapping[str, float]]], keys: Keys = KEYS) -> DataFrame:
    """(deployment, profile, bin, channels): each channel by its method, in one aggregation. Missing values are left out."""
    plain = {"mean": F.avg, "median": F.median}
    aggs = [(plain[m](finite(F.col(c))) if m in plain else F.collect_list(finite(F.col(c)).cast("double"))).alias(c) for c, (m, _) in methods.items()]
    grouped = binned.groupBy(keys.deployment, keys.profile, "bin", "bin_center").agg(*aggs)
    return grouped.withColumns({c: robust.reduce(F.col(c), m, **p) for c, (m, p) in methods.items() if m not in plain})


def bin_deployment(df: DataFrame, methods: Mapping[str, tuple[str, Mapping[str, float]]], channel: str = "z", step: float = 1.0, first: float | None = None, last: float | None = None, keys: Keys = KEYS, profiles: DataFrame | None = None) -> DataFrame:
    """Every channel of every profile on the deployment's grid; empty bins are missing. A profile without a sample in any bin is missing throughout.

    profiles: a table that has each profile; without it the samples are read once more for them.
    """
    edges = bin_edges(df, channel, step, first, last, keys)
    reduced = reduce_bins(with_bin(df, edges, channel, keys), methods, keys).drop("bin_center")
    return grid(df if profiles is None else profiles, edges, keys).join(reduced, [keys.deployment, keys.profile, "bin"], "left")


def check_one_identity(deployments: DataFrame) -> None:
    """Each deployment_id must come from one instrument and one file."""
    wrong = deployments.groupBy("deployment_id").agg(F.collect_set(F.struct("instrument_serial_number", "source_file")).alias("ids")).where(F.size("ids") > 1).limit(1).collect()
    if wrong:
        raise ValueError(f"profiles are of several deployments: {sorted(map(repr, wrong[0]['ids']))}")


def profile_rank(profiles: DataFrame, time: str = "time", keys: Keys = KEYS) -> DataFrame:
    """profiles with `profile`: their place by start time within the deployment, from 0; ties by index."""
    return profiles.withColumn("profile", F.row_number().over(Window.partitionBy(keys.deployment).orderBy(time, keys.profile)) - 1)


def merged_attributes(attrs: DataFrame, group: str) -> DataFrame:
    """(group, key, value, dropped) of (group, key, value) rows: attributes whose values disagree are dropped."""
    found = attrs.groupBy(group, "key").agg(F.min("value").alias("value"), (F.min("value") != F.max("value")).alias("dropped"))
    return found.withColumn("value", F.when(~F.col("dropped"), F.col("value")))
