"""Many gridded deployments as one dataset: union grid, duplicates by time, order, attributes."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

log = logging.getLogger("halocline")

MOST_CENTRES = 20_000


def union(parts: list[DataFrame]) -> DataFrame:
    """Rows of all parts with `file_rank`, the part's place; a channel that a part lacks is missing there."""
    if not parts:
        raise ValueError("nothing to concatenate")
    ranked = [p.withColumn("file_rank", F.lit(i)) for i, p in enumerate(parts)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)


def union_grid(rows: DataFrame, profile: list[str], bin_center: str = "bin_center") -> DataFrame:
    """Every profile on the union of all bin centres, compared as exact numbers; what is not there is missing.

    An export for grids that share most of their centres: where they share few, it is mostly missing values. A dense grid of
    more than MOST_CENTRES is refused; the long form holds the same.
    """
    found = rows.select(bin_center).distinct().limit(MOST_CENTRES + 1).collect()
    if len(found) > MOST_CENTRES:
        raise ValueError(f"more than {MOST_CENTRES} bin centres: no dense grid of them is made.")
    # As one literal: a plan with thousands of them takes long to compile.
    centres = F.split(F.lit(",".join(repr(r[0]) for r in found)), ",").cast("array<double>") if found else F.expr("cast(array() as array<double>)")
    full = rows.select(*profile).distinct().withColumn(bin_center, F.explode(centres))
    return full.join(rows, [*profile, bin_center], "left")


def first_by_time(profiles: DataFrame, time: str = "time", order: tuple[str, ...] = ("file_rank", "profile_idx")) -> DataFrame:
    """Of profiles with exactly the same time only the first in input order stays."""
    place = F.row_number().over(Window.partitionBy(time).orderBy(*order))
    return profiles.withColumn("_place", place).where("_place = 1").drop("_place")


def concatenate(parts: list[tuple[DataFrame, DataFrame]], keys: tuple[str, str] = ("deployment_id", "profile_idx"), dense: bool = False) -> tuple[DataFrame, DataFrame]:
    """(profiles, rows) of all deployments from (profiles, rows) of each: deduplicated by time, in time order; dense: on the union grid.

    A bin that a profile lacks has no row, which says the same as a missing value and grows with what is there.

    Profiles and rows belong to their part: where two parts hold the same profile, the rows of the first alone stay.
    """
    own = [*keys, "file_rank"]
    profiles = first_by_time(union([p for p, _ in parts]))
    rows = union([r for _, r in parts]).join(profiles.select(*own), own, "left_semi").drop("file_rank")
    return profiles.drop("file_rank").orderBy("time"), union_grid(rows, list(keys)) if dense else rows


def duplicates(parts: list[DataFrame], time: str = "time") -> int:
    """How many profiles share their time with an earlier one, and so are left out."""
    r = union(parts).agg(F.count("*").alias("n"), F.countDistinct(F.coalesce(F.col(time).cast("string"), F.lit(""))).alias("d")).first()
    n = r["n"] - r["d"]
    if n:
        log.warning("left out %d profile(s) whose time another has", n)
    return n


def agreed(attributes: list[Mapping[str, Any]]) -> tuple[dict[str, Any], list[str]]:
    """The attributes on which all parts that have them agree, and the names of the others."""
    names = sorted(set().union(*attributes)) if attributes else []
    values = {k: [a[k] for a in attributes if k in a] for k in names}
    kept = {k: v[0] for k, v in values.items() if all(x == v[0] for x in v)}
    wrong = [k for k in names if k not in kept]
    if wrong:
        log.warning("left out attributes that differ between deployments: %s", ", ".join(wrong))
    return kept, wrong
