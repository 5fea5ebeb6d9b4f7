"""Exact quantiles of many groups at once, by bins that narrow."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FINE = 4096  #: bins of the second round within one of the first
_OCTAVES = 256  #: bins of the first round for each factor of e
_ZERO = 250_000  #: above any logarithm of a double times _OCTAVES


def _coarse(x: Column) -> Column:
    """A whole number that never falls as x rises: sign and logarithm."""
    size = F.floor(F.log(F.abs(x)) * _OCTAVES) + _ZERO
    return F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0).cast("long"))


def _ranked(bins: DataFrame, within: list[str], by: str) -> DataFrame:
    """bins with the number of values before each, in the order of `by`."""
    return bins.withColumn("_before", F.sum("_n").over(Window.partitionBy(*within).orderBy(by)) - F.col("_n"))


def _hit(bins: DataFrame, ranks: Column) -> DataFrame:
    """The bins that hold a wanted rank, a row for each; ranks count from the bin then."""
    there = F.filter(ranks, lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_n")))
    hit = bins.select("*", F.explode(there).alias("_r"))
    return hit.withColumns({"_tag": F.col("_r.tag"), "_rank": F.col("_r.rank") - F.col("_before")}).drop("_r", "_before")


def quantiles(df: DataFrame, group: str, value: str, wanted: Mapping[str, float], store: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """(group, n, a column for each wanted name): quantiles of the finite values, between neighbours by proportion.

    Three rounds over df, for all groups and quantiles at once. Bins of the logarithm are counted; those that hold a wanted
    rank are split evenly between their least and greatest value and counted again; of the bins that still hold one, the
    values themselves. Counts are combined before they are shuffled, so no group meets in a task: a window sees the bins of
    a group (some thousands), and in the last round the distinct values of a bin (a two-millionth of a smooth sample).
    A group without finite values has n = 0 and nulls. store keeps the tables between rounds (a few rows a group).
    """
    x = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), F.col(value).cast("double"))
    # A struct around the group: a null group equals itself then.
    rows = df.select(F.struct(F.col(group).alias("key")).alias("_g"), x.alias("_x")).withColumn("_a", _coarse(F.col("_x")))
    last = F.col("_all") - 1
    tags = [(name, k) for name in wanted for k in (0, 1)]
    at = lambda name, k: F.least(F.floor(F.lit(wanted[name]) * last) + k, last)
    first = rows.groupBy("_g", "_a").agg(F.count("_x").alias("_n"), F.min("_x").alias("_low"), F.max("_x").alias("_high"))
    everyone = first.groupBy("_g").agg(F.sum("_n").alias("n"))
    first = _ranked(first.where("_n > 0"), ["_g"], "_a").withColumn("_all", F.sum("_n").over(Window.partitionBy("_g")))
    ranks = F.array(*(F.struct(F.lit(i).alias("tag"), at(name, k).cast("long").alias("rank")) for i, (name, k) in enumerate(tags)))
    coarse = _hit(first, ranks).select("_g", "_a", "_low", "_high", "_tag", "_rank")
    ask = lambda found, *keys: found.groupBy("_g", *keys).agg(F.collect_list(F.struct(F.col("_tag").alias("tag"), F.col("_rank").alias("rank"))).alias("_ranks"))  # noqa: E731  two for each name at most

    fine = F.when(F.col("_high") > F.col("_low"), F.floor((F.col("_x") - F.col("_low")) / (F.col("_high") - F.col("_low")) * FINE)).otherwise(0).cast("long")
    split = lambda found: rows.where("_x is not null").join(found, ["_g", "_a"]).withColumn("_b", fine)
    asked = store(ask(coarse, "_a", "_low", "_high"))
    second = split(asked.drop("_ranks")).groupBy("_g", "_a", "_b").agg(F.count("*").alias("_n"))
    second = _ranked(second, ["_g", "_a"], "_b").join(asked, ["_g", "_a"])
    narrow = store(ask(_hit(second, F.col("_ranks")), "_a", "_b", "_low", "_high"))

    left = split(narrow.select("_g", "_a", "_low", "_high").distinct()).join(narrow.select("_g", "_a", "_b"), ["_g", "_a", "_b"], "left_semi")
    third = left.groupBy("_g", "_a", "_b", "_x").agg(F.count("*").alias("_n"))
    third = _ranked(third, ["_g", "_a", "_b"], "_x").join(narrow.select("_g", "_a", "_b", "_ranks"), ["_g", "_a", "_b"])
    values = _hit(third, F.col("_ranks")).groupBy("_g").agg(*(F.max(F.when(F.col("_tag") == i, F.col("_x"))).alias(f"_v{i}") for i in range(len(tags))))

    both = everyone.join(values, "_g", "left")
    out = []
    for i, name in enumerate(wanted):
        low, high, place = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}"), F.lit(wanted[name]) * (F.col("n") - 1)
        part = place - F.floor(place)
        out.append(F.when(low == high, low).otherwise((1 - part) * low + part * high).alias(name))
    return both.select(F.col("_g.key").alias(group), "n", *out)
