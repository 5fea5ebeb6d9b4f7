"""Positions of profiles: fixed, or interpolated in time on a track."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .model import KEYS, Keys
from .slices import ROWS
from .tables import stores

PARTS = 256  #: into which a track is cut at most


def profile_times(df: DataFrame, time: str = "time", keys: Keys = KEYS) -> DataFrame:
    """(deployment, profile, profile_start_time, profile_end_time)."""
    return df.groupBy(keys.deployment, keys.profile).agg(F.min(time).alias("profile_start_time"), F.max(time).alias("profile_end_time"))


def reference_position(profiles: DataFrame, latitude: float, longitude: float) -> DataFrame:
    return profiles.withColumns({"latitude": F.lit(float(latitude)), "longitude": F.lit(float(longitude)), "position_source": F.lit("reference position")})


def _part(t: Column, borders: list[float], first: int = 0) -> Column:
    """How many of the rising borders are not above t, by halves."""
    if not borders:
        return F.lit(first)
    m = len(borders) // 2
    return F.when(t < borders[m], _part(t, borders[:m], first)).otherwise(_part(t, borders[m + 1 :], first + m + 1))


def interpolated_position(profiles: DataFrame, track: DataFrame, source: str = "track", strict: bool = True, time: str = "profile_start_time", rows: int = ROWS, keys: Keys = KEYS) -> DataFrame:
    """profiles with latitude and longitude, each linear in time between the track points around the start.

    Track points and the times that are asked for are one sequence; each time gets the point before it carried forward and
    the one after it, so no pair of a profile and a point is made but these. The sequence is cut into parts of about `rows`
    times by quantiles, whatever its density; a part also gets the last point before it and the first after it. Of points
    with one time the greatest position counts. (deployment, profile) is unique in profiles. strict: a profile outside the
    track's times is an error, else its position is missing.
    """
    store = stores(profiles.sparkSession)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    points = track.select(micros("time").alias("_t"), F.struct(F.col("latitude").cast("double").alias("a"), F.col("longitude").cast("double").alias("o")).alias("_at"))
    asked = profiles.select(micros(time).alias("_t"), F.lit(None).cast("struct<a:double,o:double>").alias("_at"))
    both = points.withColumn("_ask", F.lit(False)).unionByName(asked.withColumn("_ask", F.lit(True))).where("_t is not null")
    times = store(both.groupBy("_t").agg(F.max("_at").alias("_at"), F.max("_ask").alias("_ask")))
    n = min(math.ceil(times.count() / rows), PARTS)
    borders = sorted(set(times.approxQuantile("_t", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    point = F.when(F.col("_at").isNotNull(), F.struct("_t", "_at.a", "_at.o"))
    cut = times.withColumns({"_part": _part(F.col("_t"), borders), "_point": point})
    ends = cut.groupBy("_part").agg(F.max_by("_point", F.when(F.col("_at").isNotNull(), F.col("_t"))).alias("_last"), F.min_by("_point", F.when(F.col("_at").isNotNull(), F.col("_t"))).alias("_first"))
    # A row a part.
    ends = ends.select(
        "_part", F.last("_last", True).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.last("_first", True).over(Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)).alias("_after"),
    )
    low = F.coalesce(F.last("_point", True).over(Window.partitionBy("_part").orderBy("_t").rowsBetween(Window.unboundedPreceding, Window.currentRow)), "_before")
    following = F.coalesce(F.expr("lead(_point) ignore nulls over (partition by _part order by _t)"), "_after")
    found = cut.join(F.broadcast(ends), "_part").select("_t", "_ask", low.alias("l"), following.alias("h")).where("_ask and l is not null and (h is not null or _t = l._t)")
    found = found.withColumn("h", F.coalesce("h", "l"))
    f = F.when(F.col("h._t") > F.col("l._t"), (F.col("_t") - F.col("l._t")) / (F.col("h._t") - F.col("l._t"))).otherwise(0.0)
    between = lambda c: F.col(f"l.{c}") + f * (F.col(f"h.{c}") - F.col(f"l.{c}"))
    position = found.select(F.col("_t").alias("_start"), between("a").alias("latitude"), between("o").alias("longitude"))
    of = [keys.deployment, keys.profile]
    out = profiles.withColumn("_start", micros(time)).join(position, "_start", "left").select(*of, *(c for c in profiles.columns if c not in of), "latitude", "longitude")
    out = out.withColumn("position_source", F.lit(f"interpolated from {source}"))
    if strict:
        out = store(out)  # or the check would compute all of it a second time
        if out.where("latitude is null").limit(1).count():
            raise ValueError("a profile starts outside the times of the position track.")
    return out
