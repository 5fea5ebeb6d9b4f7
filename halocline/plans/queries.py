"""Queries of the log operators on the driver's tables, and the same in DuckDB SQL.

The events table stands for instrument logs: an event type is a deployment, a user a profile, the event id the order, the
value a channel. Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import seawater as sw
from ..operators import binning, concat, corrections, ctlag, derived, geo, profiles
from ..operators.despike import Despiking, despike, residuals, rolling_median, spike_counts, thresholds
from ..functions.quantiles import quantiles
from ..operators.model import KEYS
from ..operators.slices import PLACE, in_slices, placed
from ..sources import io, naming
from .config import Bin

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

D, P, S = KEYS.deployment, KEYS.profile, KEYS.order
LOG = "log as (select event_type as deployment_id, user_id as profile_idx, event_id as sample_idx, epoch_us(ts) as t, case when event_id % 97 = 0 then null else value end as value, floor(value / 10) as held from events)"


W0 = "window w as (partition by deployment_id order by sample_idx)"


def query(name: str, sql: str | None = None):
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def log(spark: SparkSession, d: str) -> DataFrame:
    e = spark.read.parquet(f"{d}/events.parquet")
    value = F.when(F.col("event_id") % 97 != 0, F.col("value"))
    return e.select(F.col("event_type").alias(D), F.col("user_id").alias(P), F.col("event_id").alias(S), F.col("ts").alias("time"), value.alias("value"), F.floor(F.col("value") / 10).cast("double").alias("held"))


def r6(*names: str) -> dict[str, Column]:
    return {n: F.round(n, 6) for n in names}


# Projections, filters, slicing.
@query("channel_projection", f"with {LOG} select deployment_id, sample_idx, t, round(value, 6) as value from log")
def _(spark, d):
    return corrections.select_channels(log(spark, d), ["value"]).select(D, S, F.unix_micros(F.col("time").cast("timestamp")).alias("t"), F.round("value", 6).alias("value"))


@query("time_range_filter", f"with {LOG} select sample_idx, round(value, 6) as value from log, (select (min(t) + max(t)) // 2 as m from log) where t >= m")
def _(spark, d):
    df = log(spark, d)
    kind = df.schema["time"].dataType.simpleString()
    m = df.agg(F.min(F.unix_micros(F.col("time").cast("timestamp"))) + F.max(F.unix_micros(F.col("time").cast("timestamp")))).first()[0] // 2
    start = spark.range(1).select(F.timestamp_micros(F.lit(m)).cast(kind)).first()[0]
    return corrections.time_range(df, start, None).select(S, F.round("value", 6).alias("value"))


@query("value_range_filter", f"with {LOG} select deployment_id, sample_idx, round(value, 6) as value from log where value >= 20 and value <= 60")
def _(spark, d):
    return corrections.value_range(log(spark, d), "value", 20, 60).select(D, S, F.round("value", 6).alias("value"))


@query("subset_slice", f"with {LOG}, n as (select *, row_number() over (partition by deployment_id order by sample_idx) - 1 as i from log) select deployment_id, sample_idx, held from n where i >= 10 and i < 500 and (i - 10) % 3 = 0")
def _(spark, d):
    return corrections.subset_slice(log(spark, d), 10, 500, 3).select(D, S, "held")


@query("subset_places", f"with {LOG}, n as (select *, row_number() over (partition by deployment_id order by sample_idx) - 1 as i from log) select deployment_id, sample_idx, held from n where i in (0, 5, 7, 100)")
def _(spark, d):
    return corrections.subset_places(log(spark, d), [0, 5, 7, 100]).select(D, S, "held")


@query("monotonic_check", f"with {LOG}, s as (select deployment_id, held > lag(held) over w as up, held < lag(held) over w as down from log window w as (partition by deployment_id order by sample_idx)) select deployment_id, bool_and(coalesce(up, true)) as increasing, bool_and(coalesce(down, true)) as decreasing, bool_and(coalesce(up, true)) or bool_and(coalesce(down, true)) as monotonic from s group by 1")
def _(spark, d):
    return corrections.monotonic(log(spark, d), "held")


@query("deployments_table", f"with {LOG}, s as (select *, t - lag(t) over w as step from log {W0}) select deployment_id, min(t) as a, max(t) as b, count(*)::bigint as n_samples, round(median(step) / 1e6, 6) as sampling_period_seconds, 'events' as source_file from s group by 1")
def _(spark, d):
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    found = io.deployments(log(spark, d), "events")
    return found.select(D, micros("deployment_start_time").alias("a"), micros("deployment_end_time").alias("b"), "n_samples", F.round("sampling_period_seconds", 6).alias("sampling_period_seconds"), "source_file")


@query("channel_slugs", r"select distinct p_name, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from part")
def _(spark, d):
    return spark.read.parquet(f"{d}/part.parquet").select("p_name", naming.slug_column(F.col("p_name")).alias("slug")).distinct()


# Raw channels.
W = "window w as (partition by deployment_id order by sample_idx)"


@query("remove_holds", f"with {LOG} select deployment_id, sample_idx, case when held = lag(held) over w then null else held end as held from log {W}")
def _(spark, d):
    return log(spark, d).withColumn("held", corrections.without_holds(F.col("held"), KEYS.log())).select(D, S, "held")


@query("hold_counts", f"with {LOG}, h as (select deployment_id, held = lag(held) over w as h from log {W}) select deployment_id, sum(case when h then 1 else 0 end)::bigint as held from h group by 1")
def _(spark, d):
    return corrections.hold_counts(log(spark, d), ["held"])


@query("shift_delay", f"with {LOG} select deployment_id, sample_idx, round(lag(value, 3) over w, 6) as value from log {W}")
def _(spark, d):
    return log(spark, d).withColumn("value", corrections.shifted(F.col("value"), 3, KEYS.log())).select(D, S, F.round("value", 6).alias("value"))


@query("shift_advance", f"with {LOG} select deployment_id, sample_idx, round(lead(value, 2) over w, 6) as value from log {W}")
def _(spark, d):
    return log(spark, d).withColumn("value", corrections.shifted(F.col("value"), -2, KEYS.log())).select(D, S, F.round("value", 6).alias("value"))


@query("add_offset", f"with {LOG} select deployment_id, sample_idx, round(value + 1.25, 6) as value from log")
def _(spark, d):
    plan = {"value": corrections.Correction(remove_holds=False, offset=1.25)}
    return corrections.correct(log(spark, d), plan).select(D, S, F.round("value", 6).alias("value"))


@query("raw_channel_chain", f"with {LOG}, a as (select deployment_id, sample_idx, case when value = lag(value) over w then null else value end as value, case when held = lag(held) over w then null else held end as held from log {W}) select deployment_id, sample_idx, lag(held, 1) over w - 5 as held, round(value, 6) as value from a {W}")
def _(spark, d):
    plan = {"held": corrections.Correction(True, 1, -5.0), "value": corrections.Correction(True)}
    return corrections.correct(log(spark, d), plan).select(D, S, "held", F.round("value", 6).alias("value"))


@query("sea_pressure", f"with {LOG} select deployment_id, sample_idx, round(value - 10.1325, 6) as sea_pressure from log")
def _(spark, d):
    return corrections.sea_pressure(log(spark, d).withColumnRenamed("value", "absolute_pressure"), 10.1325).select(D, S, F.round("sea_pressure", 6).alias("sea_pressure"))


# Rolling references and despiking.
C = "window c as (partition by deployment_id, profile_idx order by sample_idx rows between 5 preceding and 5 following)"
RES = f"{LOG}, r as (select *, value - median(value) over c as r from log {C})"


@query("rolling_median", f"with {LOG} select deployment_id, profile_idx, sample_idx, round(median(value) over c, 6) as m from log {C}")
def _(spark, d):
    return log(spark, d).select(D, P, S, F.round(rolling_median(F.col("value"), 11, KEYS.cast()), 6).alias("m"))


@query("moving_mean", f"with {LOG} select deployment_id, profile_idx, sample_idx, round(avg(value) over c, 6) as m from log {C}")
def _(spark, d):
    return log(spark, d).select(D, P, S, F.round(ctlag.moving_mean(F.col("value"), 11, KEYS.cast()), 6).alias("m"))


@query("residual", f"with {RES} select deployment_id, profile_idx, sample_idx, round(r, 6) as r from r")
def _(spark, d):
    return residuals(log(spark, d), "value", Despiking(11), KEYS.cast()).select(D, P, S, F.round("_residual", 6).alias("r"))


ABS = Despiking(11, method="absolute_threshold", threshold=40.0)
PCT = Despiking(11, rejection_percentile=99.0, method="raw_percentile")
THR = f"{RES}, h as (select deployment_id, quantile_cont(abs(r), 0.99) as threshold, count(r) as n from r group by 1)"


@query("despike_absolute", f"with {RES} select deployment_id, profile_idx, sample_idx, round(case when abs(r) > 40 then null else value end, 6) as value from r")
def _(spark, d):
    return despike(log(spark, d), "value", ABS, True)[0].select(D, P, S, F.round("value", 6).alias("value"))


@query("despike_percentile_pooled", f"with {THR} select r.deployment_id, profile_idx, sample_idx, round(case when abs(r) > threshold then null else value end, 6) as value from r join h on r.deployment_id = h.deployment_id")
def _(spark, d):
    return despike(log(spark, d), "value", PCT, True)[0].select(D, P, S, F.round("value", 6).alias("value"))


@query("despike_counts", f"with {THR} select r.deployment_id, profile_idx, sum(case when abs(r) > threshold then 1 else 0 end)::bigint as spikes from r join h on r.deployment_id = h.deployment_id group by 1, 2")
def _(spark, d):
    return spike_counts(log(spark, d), "value", PCT, True)


@query("threshold_table", f"with {THR} select deployment_id, round(threshold, 6) as threshold, 'raw_percentile' as method, false as used_fallback, n::bigint as n from h")
def _(spark, d):
    found = thresholds(residuals(log(spark, d), "value", PCT, KEYS.cast()), PCT)
    return found.select(D, F.round("threshold", 6).alias("threshold"), "method", "used_fallback", "n")


FEW = Despiking(11, 90.0, 99.0, 10_000_000)


@query("despike_gpd_fallback", f"with {THR}, u as (select deployment_id, quantile_cont(abs(r), 0.9) as u from r group by 1), e as (select r.deployment_id, count(*) as e from r join u on r.deployment_id = u.deployment_id where abs(r) > u group by 1) select h.deployment_id, round(threshold, 6) as threshold, true as used_fallback, n::bigint as n, e::bigint as n_exceedances from h join e on h.deployment_id = e.deployment_id")
def _(spark, d):
    found = thresholds(residuals(log(spark, d), "value", FEW, KEYS.cast()), FEW)
    return found.select(D, F.round("threshold", 6).alias("threshold"), "used_fallback", "n", "n_exceedances")


# The profile likelihood of theta = shape / scale on a grid of its own, narrowed twelve times.
_MEAN_LOG = "list_avg(list_transform(x, lambda v: ln(1 + t * v)))"
GPD = f"""with recursive {RES}, h as (select deployment_id, quantile_cont(abs(r), 0.9) as u, quantile_cont(abs(r), 0.999) as top, count(r) as n from r group by 1),
e as (select r.deployment_id, u, n, list(abs(r) - u) as x from r join h on r.deployment_id = h.deployment_id where abs(r) > u group by all),
g0 as (select *, (-1 + 1e-6 + 20.0 * j / 4000) / list_max(x) as t from e, unnest(range(0, 4000)) as k(j)),
i0 as (select deployment_id, arg_max(t, -ln({_MEAN_LOG} / t) - {_MEAN_LOG}) as t, max(20.0 / 4000 / list_max(x)) as w from g0 where abs(t) > 1e-9 group by 1),
it(deployment_id, t, w, k) as (
  select deployment_id, t, w, 0 from i0
  union all
  select deployment_id, arg_max(t, -ln({_MEAN_LOG} / t) - {_MEAN_LOG}), max(w) / 8, max(k) + 1
  from (select it.deployment_id, x, it.t + w * j / 8.0 as t, w, k from it join e on e.deployment_id = it.deployment_id, unnest(range(-8, 9)) as q(j) where k < 12) where abs(t) > 1e-9 and 1 + t * list_max(x) > 0 group by 1),
f as (select deployment_id, arg_max(t, k) as t from it group by 1),
p as (select e.*, t, {_MEAN_LOG} as shape from e join f on e.deployment_id = f.deployment_id)
select h.deployment_id, coalesce(round(p.u + (pow(0.001 * p.n / len(x), -shape) - 1) / t, 2), round(h.top, 2)) as threshold, p.n is null as used_fallback, round(shape, 3) as shape, round(shape / t, 2) as scale, h.n::bigint as n, coalesce(c.c, 0)::bigint as n_exceedances
from h left join (select deployment_id, len(x) as c from e) c on c.deployment_id = h.deployment_id left join p on p.deployment_id = h.deployment_id and c.c >= 20"""


@query("despike_gpd", GPD)
def _(spark, d):
    s = Despiking(11, 90.0, 99.9, 20)
    found = despike(log(spark, d), "value", s, True)[1]
    return found.select(D, F.round("threshold", 2).alias("threshold"), "used_fallback", F.round("shape", 3).alias("shape"), F.round("scale", 2).alias("scale"), "n", "n_exceedances")


# One log over many tasks: slices of 300 samples, with borders.
L11 = "window c as (partition by deployment_id order by sample_idx rows between 5 preceding and 5 following)"


@query("sliced_rolling_median", f"with {LOG} select deployment_id, sample_idx, round(median(value) over c, 6) as m from log {L11}")
def _(spark, d):
    medians = in_slices(log(spark, d), 5, lambda part, k: part.withColumn("m", rolling_median(F.col("value"), 11, k.log())), 300)
    return medians.select(D, S, F.round("m", 6).alias("m"))


@query("sliced_channel_chain", f"with {LOG}, a as (select deployment_id, sample_idx, case when value = lag(value) over w then null else value end as value, case when held = lag(held) over w then null else held end as held from log {W}) select deployment_id, sample_idx, lag(held, 7) over w - 5 as held, round(lead(value, 400) over w, 6) as value from a {W}")
def _(spark, d):
    plan = {"held": corrections.Correction(True, 7, -5.0), "value": corrections.Correction(True, -400)}
    return corrections.correct(log(spark, d), plan, rows=300).select(D, S, "held", F.round("value", 6).alias("value"))


@query("sliced_places", f"with {LOG} select deployment_id, sample_idx, row_number() over w - 1 as place from log {W}")
def _(spark, d):
    return placed(log(spark, d), 300).select(D, S, F.col(PLACE).alias("place"))


@query("sliced_despike_pooled", f"with {LOG}, r as (select *, value - median(value) over c as r from log {L11}), h as (select deployment_id, quantile_cont(abs(r), 0.99) as threshold from r group by 1) select r.deployment_id, sample_idx, round(case when abs(r) > threshold then null else value end, 6) as value from r join h on r.deployment_id = h.deployment_id")
def _(spark, d):
    return despike(log(spark, d), "value", PCT, rows=300)[0].select(D, S, F.round("value", 6).alias("value"))


@query("pooled_quantiles", f"with {LOG} select deployment_id, count(value)::bigint as n, round(quantile_cont(value, 0.001), 6) as a, round(median(value), 6) as b, round(quantile_cont(value, 0.95), 6) as c, round(quantile_cont(held, 0.25), 6) as d from log group by 1")
def _(spark, d):
    df = log(spark, d)
    both = quantiles(df, D, "value", {"a": 0.001, "b": 0.5, "c": 0.95}).join(quantiles(df, D, "held", {"d": 0.25}).drop("n"), D)
    return both.withColumns(r6("a", "b", "c", "d"))


# Lag search. The salinity stands in as conductivity less temperature.
LAG_SQL = f"""{LOG}, s as (select *, (sample_idx % 50) / 10.0 as temperature from log where value >= 5),
l as (select unnest(range(-3, 4)) as lag),
n as (select *, row_number() over (partition by deployment_id, profile_idx order by sample_idx) as i from s),
x as (select a.deployment_id, a.profile_idx, a.sample_idx, l.lag, b.value - a.temperature as s from n a cross join l left join n b on a.deployment_id = b.deployment_id and a.profile_idx = b.profile_idx and b.i = a.i - l.lag),
m as (select *, s - avg(s) over (partition by deployment_id, profile_idx, lag order by sample_idx rows between 2 preceding and 2 following) as r from x),
f as (select deployment_id, lag, stddev_pop(r) as score from m group by 1, 2)"""
SEARCH = ctlag.LagSearch(True, 5.0, None, 5, -3, 3)


def lag_log(spark, d):
    return log(spark, d).withColumns({"temperature": F.col(S) % 50 / 10.0, "sea_pressure": F.col("value"), "electrical_conductivity": F.col("value")})


def stand_in(df, out, c, t, p):
    return df.withColumn(out, F.col(c) - F.col(t))


@query("ct_lag_scores", f"with {LAG_SQL} select deployment_id, lag::int as lag, round(score, 6) as score from f")
def _(spark, d):
    return ctlag.lag_scores(lag_log(spark, d), SEARCH, stand_in).select(D, "lag", F.round("score", 6).alias("score"))


@query("ct_lag_best", f"with {LAG_SQL} select deployment_id, arg_min(lag, (score, abs(lag), lag))::int as lag from f group by 1")
def _(spark, d):
    return ctlag.best_lags(ctlag.lag_scores(lag_log(spark, d), SEARCH, stand_in))


@query("ct_lag_apply", f"with {LOG}, k as (select deployment_id, (ascii(deployment_id) % 5 - 2) as lag from log group by 1), n as (select *, row_number() over (partition by deployment_id order by sample_idx) as i from log) select a.deployment_id, a.sample_idx, round(b.value, 6) as value from n a join k on a.deployment_id = k.deployment_id left join n b on b.deployment_id = a.deployment_id and b.i = a.i - k.lag")
def _(spark, d):
    df = log(spark, d)
    lags = df.select(D).distinct().withColumn("lag", (F.ascii(D) % 5 - 2).cast("int"))
    return ctlag.apply_lags(df, lags, "value").select(D, S, F.round("value", 6).alias("value"))


# Segmentation and extraction.
ZIG = f"""{LOG}, s as (select deployment_id, sample_idx, nullif(sign(held - lag(held) over w), 0) as s from log {W}),
d as (select deployment_id, sample_idx, last_value(s ignore nulls) over (partition by deployment_id order by sample_idx rows between unbounded preceding and current row) as d from s),
t as (select *, case when d <> lag(d) over w then 1 else 0 end as turn from d {W}),
g as (select *, sum(turn) over (partition by deployment_id order by sample_idx) as segment from t)"""


@query("cast_segments", f"with {ZIG} select deployment_id, segment::bigint as segment, max(d)::int as direction, min(sample_idx) as start, max(sample_idx) as stop, count(*)::bigint as n from g group by 1, 2")
def _(spark, d):
    return profiles.zigzag(log(spark, d), "held")


@query("cast_extract", f"with {LOG}, b as (select deployment_id, min(sample_idx) + 100 * k.k as start, min(sample_idx) + 100 * k.k + 40 as down_end, min(sample_idx) + 100 * k.k + 50 as up_start, min(sample_idx) + 100 * k.k + 90 as stop, k.k as k from log, (select unnest(range(0, 3)) as k) k group by deployment_id, k.k), n as (select deployment_id, 2 * k as p, start as a, down_end as b from b union all select deployment_id, 2 * k + 1, up_start, stop from b), g as (select n.deployment_id, n.p, n.b, min(sample_idx) as a from n join log on log.deployment_id = n.deployment_id and log.sample_idx = n.a group by 1, 2, 3) select l.deployment_id, l.sample_idx, g.p::int as profile_idx from log l join g on l.deployment_id = g.deployment_id and l.sample_idx >= g.a and l.sample_idx < g.b")
def _(spark, d):
    df = log(spark, d).drop(P)
    first = df.groupBy(D).agg(F.min(S).alias("m")).withColumn("cycle", F.explode(F.sequence(F.lit(0), F.lit(2))))
    at = lambda n: (F.col("m") + 100 * F.col("cycle") + n).cast("long")
    cycles = first.select(D, "cycle", at(0).alias("down_start"), at(40).alias("down_end"), at(50).alias("up_start"), at(90).alias("up_end"))
    return profiles.extract(df, profiles.slices(cycles, "both")).select(D, S, P)


def _peaks_sql(name: str, x: str, height: str, prominence: float, width: float, distance: int) -> str:
    """Peaks of x by neighbours, walls and crossings; the wave has no plateaus."""
    of = lambda t: x.replace("x", f"{t}.x")
    return f"""{name}0 as (select d, i, x from (select d, i, {x} as x, lag({x}) over w as a, lead({x}) over w as b from s window w as (partition by d order by i)) where x > a and x > b),
{name}1 as (select p.d, p.i, p.x, coalesce(max(case when s.i < p.i and {of('s')} > p.x then s.i end), 0) as l, coalesce(min(case when s.i > p.i and {of('s')} > p.x then s.i end), 1000000000) as r from {name}0 p join s on s.d = p.d group by p.d, p.i, p.x),
{name}2 as (select p.d, p.i, p.x, p.l, p.r, p.x - greatest(min(case when s.i <= p.i then {of('s')} end), min(case when s.i >= p.i then {of('s')} end)) as h from {name}1 p join s on s.d = p.d and s.i > p.l and s.i < p.r group by p.d, p.i, p.x, p.l, p.r),
{name}3 as (select p.d, p.i, p.x, p.h, max(case when s.i < p.i and {of('s')} <= p.x - p.h / 2 then s.i end) as l, min(case when s.i > p.i and {of('s')} <= p.x - p.h / 2 then s.i end) as r from {name}2 p join s on s.d = p.d and s.i > p.l and s.i < p.r group by p.d, p.i, p.x, p.h),
{name}4 as (select q.d, q.i, q.x, q.h, q.r - ((q.x - q.h / 2) - ({of('b')})) / (({of('b1')}) - ({of('b')})) - (q.l + ((q.x - q.h / 2) - ({of('a')})) / (({of('a1')}) - ({of('a')}))) as w
  from {name}3 q join s a on a.d = q.d and a.i = q.l join s a1 on a1.d = q.d and a1.i = q.l + 1 join s b on b.d = q.d and b.i = q.r join s b1 on b1.d = q.d and b1.i = q.r - 1),
{name} as (select d, i from {name}4 p where {height} and h >= {prominence} and w >= {width} and not exists (select 1 from {name}0 o where o.d = p.d and abs(o.i - p.i) < {distance} and (o.x > p.x or (o.x = p.x and o.i > p.i))))"""


PEAKS = f"""with {LOG}, s as (select deployment_id as d, row_number() over (partition by deployment_id order by sample_idx) as i, abs(row_number() over (partition by deployment_id order by sample_idx) % 200 - 100) * -0.5 + 50 as x from log),
n as (select d, max(i) as n from s group by 1),
{_peaks_sql("up", "x", "x >= 25", 25, 20, 20)},
{_peaks_sql("lo", "-x", "true", 2, 5, 5)},
t as (select d, i, lead(x) over w - x as step from s window w as (partition by d order by i)),
g as (select d, i, min(step) over w >= 0.01 and count(step) over w = 4 as down, max(step) over w <= -0.01 and count(step) over w = 4 as rise from t window w as (partition by d order by i rows between current row and 3 following)),
c as (select up.d, up.i as peak, greatest(coalesce((select max(i) from lo where lo.d = up.d and lo.i < up.i), 1), coalesce(lag(up.i) over w, 1)) as low, least(coalesce((select min(i) from lo where lo.d = up.d and lo.i > up.i), n.n), coalesce(lead(up.i) over w, n.n)) as high from up join n on n.d = up.d window w as (partition by up.d order by up.i)),
a as (select c.d, c.peak, c.high, min(case when g.down and g.i >= c.low and g.i < c.peak then g.i end) as start, min(case when g.rise and g.i >= c.peak and g.i < c.high then g.i end) as rise, max(case when g.rise and g.i >= c.peak and g.i < c.high then g.i end) as last from c join g on g.d = c.d group by c.d, c.peak, c.high),
e as (select a.d, a.peak, a.start, a.rise, least(a.last + 4, a.high) as stop, least(max(g.i) + 4, a.peak) as down_end from a join g on g.d = a.d and g.down and g.i >= a.start and g.i < greatest(a.peak - 3, a.start + 1) where a.start is not null and a.last is not null group by a.d, a.peak, a.start, a.rise, a.last, a.high)
select d as deployment_id, (row_number() over (partition by d order by peak) - 1)::bigint as cycle, start as down_start, down_end, greatest(rise, down_end) as up_start, stop as up_end from e"""


@query("find_profiles_peaks", PEAKS)
def _(spark, d):
    df = log(spark, d)
    place = F.row_number().over(KEYS.log())
    saw = df.select(D, place.cast("long").alias(S), (F.abs(place % 200 - 100) * -0.5 + 50).alias("sea_pressure"))
    return profiles.find_cycles(saw, profiles.Detection(peak_distance=20, peak_width=20))


# Positions.
@query("profile_times", f"with {LOG} select deployment_id, profile_idx, min(t) as a, max(t) as b from log group by 1, 2")
def _(spark, d):
    t = geo.profile_times(log(spark, d))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return t.select(D, P, micros("profile_start_time").alias("a"), micros("profile_end_time").alias("b"))


@query("position_reference", f"with {LOG} select distinct deployment_id, profile_idx, 45.5::double as latitude, -125.25::double as longitude, 'reference position' as position_source from log")
def _(spark, d):
    return geo.reference_position(log(spark, d).select(D, P).distinct(), 45.5, -125.25).select(D, P, "latitude", "longitude", "position_source")


TRACK = "track as (select t, (sample_idx % 180) - 90.0 as lat, (sample_idx % 360) - 180.0 as lon from log where sample_idx % 10 = 0 or t = (select max(t) from log) or t = (select min(t) from log))"


@query("position_interpolated", f"with {LOG}, {TRACK}, p as (select deployment_id, profile_idx, min(t) as t from log group by 1, 2), k as (select t as t0, lead(t) over (order by t) as t1, lat, lead(lat) over (order by t) as lat1, lon, lead(lon) over (order by t) as lon1 from track) select deployment_id, profile_idx, round(lat + (p.t - t0) / (t1 - t0) * (lat1 - lat), 6) as latitude, round(lon + (p.t - t0) / (t1 - t0) * (lon1 - lon), 6) as longitude from p join k on t0 <= p.t and p.t < t1 union all select deployment_id, profile_idx, lat, lon from p join track on p.t = track.t where p.t = (select max(t) from track)")
def _(spark, d):
    df = log(spark, d)
    ends = df.agg(F.min("time"), F.max("time")).first()
    track = df.where((F.col(S) % 10 == 0) | F.col("time").isin(*ends)).select("time", (F.col(S) % 180 - 90.0).alias("latitude"), (F.col(S) % 360 - 180.0).alias("longitude"))
    found = geo.interpolated_position(geo.profile_times(df), track)
    return found.select(D, P, *(F.round(c, 6).alias(c) for c in ("latitude", "longitude")))


# Seawater. The SQL adds up the terms one by one.
SEA = "s as (select event_id, 30 + (event_id % 80) / 10.0 as sa, 2 + (event_id % 250) / 10.0 as ct, (event_id % 2000)::double as p, 30 + (event_id * 7 % 250) / 10.0 as c, (event_id % 160) - 80.0 as lat from events)"
XYZ = f"v as (select *, sqrt({sw.SFAC} * sa + {sw.OFFSET}) as x, ct * 0.025 as y, p * 1e-4 as z, sqrt({sw.SFAC} * sa) as u from s)"


def sea(spark, d):
    n = F.col("event_id")
    e = spark.read.parquet(f"{d}/events.parquet")
    return e.select("event_id", (30 + n % 80 / 10.0).alias("sa"), (2 + n % 250 / 10.0).alias("ct"), (n % 2000).cast("double").alias("p"), (30 + n * 7 % 250 / 10.0).alias("c"), (n % 160 - 80.0).alias("lat"))


def terms(table: dict, x: str = "x", y: str = "y", z: str = "z") -> str:
    return "(" + " + ".join(f"({c!r}) * {x}**{i} * {y}**{j} * {z}**{k}" for (i, j, k), c in table.items()) + ")"


def sea_query(name: str, f: Callable[[DataFrame], DataFrame], sql: str, digits: int = 6, scale: float = 1.0) -> None:
    full = f"with {SEA}, {XYZ} select event_id, round({scale!r} * ({sql}), {digits}) as r from v" if "with" not in sql else sql
    query(name, full)(lambda spark, d: f(sea(spark, d)).select("event_id", F.round(F.lit(scale) * F.col("r"), digits).alias("r")))


V = terms(sw.SPECVOL)
sea_query("density", lambda s: s.withColumn("r", sw.rho(F.col("sa"), F.col("ct"), F.col("p"))), f"1 / {V}")
sea_query("density_anomaly", lambda s: s.withColumn("r", sw.sigma0(F.col("sa"), F.col("ct"))), f"1 / {terms({k: c for k, c in sw.SPECVOL.items() if not k[2]})} - 1000")
sea_query("sound_speed", lambda s: s.withColumn("r", sw.sound_speed(F.col("sa"), F.col("ct"), F.col("p"))), f"1e4 * sqrt({V} * {V} / (-1 * {terms({(i, j, k - 1): c * k for (i, j, k), c in sw.SPECVOL.items() if k})}))", 5)
sea_query("thermal_expansion", lambda s: s.withColumn("r", sw.alpha(F.col("sa"), F.col("ct"), F.col("p"))), f"0.025 * {terms({(i, j - 1, k): c * j for (i, j, k), c in sw.SPECVOL.items() if j})} / {V}", scale=1e4)
sea_query("haline_contraction", lambda s: s.withColumn("r", sw.beta(F.col("sa"), F.col("ct"), F.col("p"))), f"-0.5 * {sw.SFAC} * {terms({(i - 1, j, k): c * i for (i, j, k), c in sw.SPECVOL.items() if i})} / (x * {V})", scale=1e4)
sea_query("spiciness", lambda s: s.withColumn("r", sw.spiciness0(F.col("sa"), F.col("ct"))), terms(sw.SPICE))
sea_query("freezing_point", lambda s: s.withColumn("r", sw.ct_freezing(F.col("sa"), F.col("p"))), terms(sw.FREEZING, "sqrt(sa * 1e-2)", "1.0"))
sea_query("absolute_salinity_ref", lambda s: s.withColumn("r", sw.sa_from_sp(F.col("sa"))), "sa * 35.16504 / 35")
X0 = (sw.SFAC * sw.SSO + sw.OFFSET) ** 0.5
H0 = "1e8 * (" + " + ".join(f"({c!r}) * {X0!r}**{i} * z**{k + 1} / {k + 1}" for (i, j, k), c in sw.SPECVOL.items() if not j) + ")"
sea_query(
    "z_from_p", lambda s: s.withColumn("r", sw.z_from_p(F.col("p"), F.col("lat"))),
    f"with {SEA}, {XYZ}, g as (select *, 9.780327 * (1 + 5.2792e-3 * sin(radians(lat))**2 + 2.32e-5 * sin(radians(lat))**4) as b, {H0} as h from v) select event_id, 0.0 + round(-2 * h / (b + sqrt(b * b + 2 * 2.26e-7 * b * h)), 6) as r from g",
)
SPQ = f"""with {SEA}, t as (select *, ct * 1.00024 as t68, c / {sw.C3515} as r from s),
q as (select *, (t68 - 15) / (1 + {sw.PSS_K} * (t68 - 15)) as f, r / ((1 + p * ({sw.PSS_E[0]} + {sw.PSS_E[1]!r} * p + {sw.PSS_E[2]!r} * p * p) / (1 + {sw.PSS_D[0]} * t68 + {sw.PSS_D[1]} * t68 * t68 + ({sw.PSS_D[2]} + {sw.PSS_D[3]} * t68) * r)) * ({" + ".join(f"({c!r}) * t68**{n}" for n, c in enumerate(sw.PSS_C))})) as rt from t)
select event_id, round({" + ".join(f"({c!r}) * sqrt(rt)**{n}" for n, c in enumerate(sw.PSS_A))} + f * ({" + ".join(f"({c!r}) * sqrt(rt)**{n}" for n, c in enumerate(sw.PSS_B))}), 6) as r from q"""
sea_query("practical_salinity", lambda s: sw.with_sp_from_c(s, "r", "c", "ct", "p"), SPQ)


def _pt0_sql(out: str) -> str:
    """Newton on entropy in DuckDB, to the fixed point: four plain steps."""
    part = lambda t, z: f"(-0.025 * {terms(sw.ENTROPY, 'u', f'({t} * 0.025)', z)})"
    slope = lambda t: f"(-0.000625 * {terms({(i, j - 1, k): c * j for (i, j, k), c in sw.ENTROPY.items() if j and not k}, 'u', f'({t} * 0.025)', '1.0')})"
    surface = lambda t: f"(-0.025 * {terms({k: c for k, c in sw.ENTROPY.items() if not k[2]}, 'u', f'({t} * 0.025)', '1.0')})"
    steps = [f"n0 as (select *, {part('ct', 'z')} as e, ct as pt from v)"]
    steps += [f"n{i + 1} as (select * replace (pt - ({surface('pt')} - e) / {slope('pt')} as pt) from n{i})" for i in range(5)]
    return f"with {SEA}, {XYZ}, {', '.join(steps)} select event_id, round({out}, 6) as r from n5"


sea_query("potential_temperature", lambda s: sw.with_pt0_from_t(s, "r", "sa", "ct", "p"), _pt0_sql("pt"))
sea_query("conservative_temperature", lambda s: sw.with_ct_from_t(s, "r", "sa", "ct", "p"), _pt0_sql(f"{terms(sw.POTENTIAL_ENTHALPY, 'u', '(pt * 0.025)', '1.0')} / {sw.CP0}"))
_H = lambda t: terms(sw.POTENTIAL_ENTHALPY, "u", f"({t} * 0.025)", "1.0")
_DH = terms({(i, j - 1, 0): c * j for (i, j, _), c in sw.POTENTIAL_ENTHALPY.items() if j}, "u", "(pt * 0.025)", "1.0")
_O2 = ", ".join([f"o{i + 1} as (select * replace (pt - ({_H('pt')} / {sw.CP0} - ct) / (0.025 * {_DH} / {sw.CP0}) as pt) from o{i})" for i in range(5)])
sea_query(
    "oxygen_concentration", lambda s: sw.with_o2sol(s, "r", "sa", "ct").withColumn("r", F.col("r") * 0.9),
    f"with {SEA}, {XYZ}, o0 as (select *, ct as pt from v), {_O2}, y as (select *, ln((298.15 - pt * 1.00024) / (273.15 + pt * 1.00024)) as w, sa * 35 / 35.16504 as q from o5) select event_id, round(0.9 * exp({' + '.join(f'({c!r}) * w**{n}' for n, c in enumerate(sw.O2_A))} + q * ({' + '.join(f'({c!r}) * w**{n}' for n, c in enumerate(sw.O2_B))}) + ({sw.O2_C!r}) * q * q), 6) as r from y",
)


CHAIN = f"""with {LOG}, a as (select *, 30 + value / 10 as sp from log), ar as (select *, abs(sp - median(sp) over (partition by deployment_id, profile_idx order by sample_idx rows between 5 preceding and 5 following)) as r from a),
ah as (select deployment_id, quantile_cont(r, 0.99) as h from ar group by 1),
b as (select ar.* exclude (sp, r), case when r > h then null else sp end as sp from ar join ah on ar.deployment_id = ah.deployment_id),
e as (select *, sp * {sw.UPS!r} as sa from b), er as (select *, abs(sa - median(sa) over (partition by deployment_id, profile_idx order by sample_idx rows between 5 preceding and 5 following)) as r from e),
eh as (select deployment_id, quantile_cont(r, 0.99) as h from er group by 1)
select er.deployment_id, sample_idx, round(sp, 6) as sp, round(case when r > h then null else sa end, 6) as sa from er join eh on er.deployment_id = eh.deployment_id"""


@query("derive_despike_chain", CHAIN)
def _(spark, d):
    df = log(spark, d).select(D, P, S, (30 + F.col("value") / 10).alias("sp"))
    df, _t = despike(df, "sp", PCT, True)
    df, _t = despike(df.withColumn("sa", sw.sa_from_sp(F.col("sp"))), "sa", PCT, True)
    return df.select(D, S, F.round("sp", 6).alias("sp"), F.round("sa", 6).alias("sa"))


def _derived_sql() -> str:
    """The chain step by step: salinity from conductivity, then temperatures, then what depends on both."""
    salinity = SPQ.replace("select event_id, round(", "select *, ").replace(", 6) as r from q", " as sp from q")
    entropy = lambda t, z: f"(-0.025 * {terms(sw.ENTROPY, 'u', f'({t} * 0.025)', z)})"
    flat = {k: c for k, c in sw.ENTROPY.items() if not k[2]}
    slope = terms({(i, j - 1, 0): c * j for (i, j, _), c in flat.items() if j}, "u", "(pt * 0.025)", "1.0")
    newton = ", ".join(f"m{i + 1} as (select * replace (pt - (-0.025 * {terms(flat, 'u', '(pt * 0.025)', '1.0')} - e) / (-0.000625 * {slope}) as pt) from m{i})" for i in range(5))
    names = {
        "density_anomaly": f"1 / {terms({k: c for k, c in sw.SPECVOL.items() if not k[2]})} - 1000", "potential_temperature": "pt", "sea_water_density": f"1 / {V}", "spiciness": terms(sw.SPICE),
        "speed_of_sound": f"1e4 * sqrt({V} * {V} / (-1 * {terms({(i, j, k - 1): c * k for (i, j, k), c in sw.SPECVOL.items() if k})}))", "freezing_point": terms(sw.FREEZING, "sqrt(sa * 1e-2)", "1.0"),
        "thermal_expansion_coefficient": f"0.025 * {terms({(i, j - 1, k): c * j for (i, j, k), c in sw.SPECVOL.items() if j})} / {V}", "haline_contraction_coefficient": f"-0.5 * {sw.SFAC} * {terms({(i - 1, j, k): c * i for (i, j, k), c in sw.SPECVOL.items() if i})} / (x * {V})",
    }
    scaled = {"thermal_expansion_coefficient": 10, "haline_contraction_coefficient": 10, "speed_of_sound": 5}
    gravity = "9.780327 * (1 + 5.2792e-3 * sin(radians(45.0))**2 + 2.32e-5 * sin(radians(45.0))**4)"
    return f"""with k as ({salinity}), k1 as (select event_id, p, ct as t, sp, sp * 35.16504 / 35 as sa, p * 1e-4 as z from k),
k2 as (select *, sqrt({sw.SFAC} * sa) as u, sqrt({sw.SFAC} * sa + {sw.OFFSET}) as x from k1), m0 as (select *, {entropy("t", "z")} as e, t as pt from k2), {newton},
f as (select *, {terms(sw.POTENTIAL_ENTHALPY, "u", "(pt * 0.025)", "1.0")} / {sw.CP0} as ct, {H0} as h from m5), f2 as (select *, ct * 0.025 as y from f)
select event_id as sample_idx, 0.0 + round(-2 * h / ({gravity} + sqrt({gravity} * {gravity} + 2 * 2.26e-7 * {gravity} * h)), 6) as z, round(sp, 6) as practical_salinity, round(sa, 6) as absolute_salinity, round(ct, 6) as conservative_temperature, {", ".join(f"round({f}, {scaled.get(n, 6)}) as {n}" for n, f in names.items())} from f2"""


@query("derived_variables", _derived_sql())
def _(spark, d):
    df = sea(spark, d).select(F.lit("d").alias(D), (F.col("event_id") % 50).alias(P), F.col("event_id").alias(S), F.col("c").alias("electrical_conductivity"), F.col("ct").alias("temperature"), F.col("p").alias("sea_pressure"), F.lit(45.0).alias("latitude"))
    out, _t, added = derived.derive(df, {v.flag: v.flag != "oxygen_concentration" for v in derived.VARIABLES})
    digits = {"thermal_expansion_coefficient": 10, "haline_contraction_coefficient": 10, "speed_of_sound": 5}
    return out.select(S, *(F.round(c, digits.get(c, 6)).alias(c) for c in added))


# Binning. Ten profiles a deployment, so bins have several values.
BINS = """b0 as (select event_type as deployment_id, user_id % 10 as profile_idx, event_id as sample_idx, case when event_id % 97 = 0 then null else value end as z, (event_id % 1009) / 10.0 as x from events),
e as (select deployment_id, min(z) as first, greatest(ceil((max(z) - min(z)) / 4.0), 1)::int as n from b0 group by 1),
k as (select deployment_id, i, first + 4.0 * i as lo, first + 4.0 * (i + 1) as hi, (first + 4.0 * i + (first + 4.0 * (i + 1))) / 2 as c from e, unnest(range(0, n)) as u(i)),
a as (select b0.*, k.i, k.c from b0 join k on b0.deployment_id = k.deployment_id and z <= hi and (z > lo or (i = 0 and z = lo)))"""


def cells(spark, d):
    e = log(spark, d)
    return e.select(D, (F.col(P) % 10).alias(P), S, F.col("value").alias("z"), (F.col(S) % 1009 / 10.0).alias("x"))


def binned(spark, d):
    df = cells(spark, d)
    return binning.with_bin(df, binning.bin_edges(df, "z", 4.0))


@query("bin_edges", f"with {BINS} select deployment_id, round(first, 6) as first, n as n_bins from e")
def _(spark, d):
    return binning.bin_edges(cells(spark, d), "z", 4.0).select(D, F.round("first", 6).alias("first"), "n_bins")


@query("bin_assign", f"with {BINS} select deployment_id, sample_idx, i::int as bin, round(c, 6) as bin_center from a")
def _(spark, d):
    return binned(spark, d).select(D, S, "bin", F.round("bin_center", 6).alias("bin_center"))


@query("bin_grid", f"with {BINS}, p as (select distinct deployment_id, profile_idx from b0) select p.deployment_id, profile_idx, i::int as bin, round(c, 6) as bin_center from p join k on p.deployment_id = k.deployment_id")
def _(spark, d):
    df = cells(spark, d)
    return binning.grid(df, binning.bin_edges(df, "z", 4.0)).select(D, P, "bin", F.round("bin_center", 6).alias("bin_center"))


def reducer(name: str, method: str, sql: str, **parameters) -> None:
    def run(spark, d):
        out = binning.reduce_bins(binned(spark, d), {"x": (method, parameters)})
        return out.select(D, P, "bin", F.round("x", 6).alias("x"))

    query(name, sql)(run)


GROUPS = f"{BINS}, g as (select deployment_id, profile_idx, i::int as bin, list(x order by x) as l, count(*) as n from a group by 1, 2, 3)"
reducer("bin_mean", "mean", f"with {BINS} select deployment_id, profile_idx, i::int as bin, round(avg(x), 6) as x from a group by 1, 2, 3")
reducer("bin_median", "median", f"with {BINS} select deployment_id, profile_idx, i::int as bin, round(median(x), 6) as x from a group by 1, 2, 3")
_RANKED = f"with {BINS}, r as (select deployment_id, profile_idx, i::int as bin, x, row_number() over (partition by deployment_id, profile_idx, i order by x) as k, count(*) over (partition by deployment_id, profile_idx, i) as n from a), q as (select *, floor(n * 0.2)::int as cut from r)"
reducer("bin_trimmed_mean", "trimmed_mean", f"{_RANKED} select deployment_id, profile_idx, bin, round(avg(x) filter (where n < 3 or (k > cut and k <= n - cut)), 6) as x from q group by 1, 2, 3")
reducer("bin_winsorized_mean", "winsorized_mean", f"{_RANKED}, b as (select *, max(case when k = cut + 1 then x end) over (partition by deployment_id, profile_idx, bin) as lo, max(case when k = n - cut then x end) over (partition by deployment_id, profile_idx, bin) as hi from q) select deployment_id, profile_idx, bin, round(avg(case when n < 3 then x else least(greatest(x, lo), hi) end), 6) as x from b group by 1, 2, 3")


def _irls(weight: str, rounds: int = 100) -> str:
    spread = lambda loc: f"1.4826 * list_median(list_transform(l, lambda v: abs(v - {loc})))"
    body = GROUPS.replace("with ", "")
    return f"""with recursive {body},
s as (select *, list_median(l) as loc, 0 as it from g where n >= 3), s2 as (select *, {spread("loc")} as s from s),
it(deployment_id, profile_idx, bin, l, loc, s, u, done, it) as (
  select deployment_id, profile_idx, bin, l, loc, s, s * 1e-9::double, s = 0, 0 from s2
  union all
  select deployment_id, profile_idx, bin, l, case when w = 0 then loc else na end, case when w = 0 then s else ns end, u, w = 0 or ns = 0 or abs(na - loc) < 1e-8 * ns, it + 1
  from (select *, {spread("na")} as ns from (
    select *, floor(list_sum(list_transform(l, lambda v: ({weight}) * v)) / nullif(list_sum(list_transform(l, lambda v: {weight})), 0) / u + 0.5) * u as na, list_sum(list_transform(l, lambda v: {weight})) as w
    from it where not done and it < {rounds})))
select deployment_id, profile_idx, bin, round(arg_max(loc, it), 6) as x from it group by 1, 2, 3
union all select deployment_id, profile_idx, bin, round(list_avg(l), 6) from g where n < 3"""


# Locations are rounded on both sides: some bins never settle, and then the last digit of a sum would decide.
reducer("bin_huber", "huber", _irls("case when abs((v - loc) / s) <= 1.345 then 1.0::double else 1.345 / abs((v - loc) / s) end"))
reducer("bin_biweight", "biweight", _irls("case when abs((v - loc) / s) <= 4.685 then (1 - ((v - loc) / s / 4.685)**2)**2 else 0.0::double end"))


MIX = {"method": "trimmed_mean", "channels": {"x": {"method": "median"}, "y": {"trimmed_mean": {"proportion_to_cut": 0.1}}}}


@query("bin_method_mix", f"with {BINS.replace('(event_id % 1009) / 10.0 as x', '(event_id % 1009) / 10.0 as x, (event_id % 877) / 10.0 as y, (event_id % 613) / 10.0 as w')}, r as (select deployment_id, profile_idx, i::int as bin, x, y, w, row_number() over (partition by deployment_id, profile_idx, i order by y) as ky, row_number() over (partition by deployment_id, profile_idx, i order by w) as kw, count(*) over (partition by deployment_id, profile_idx, i) as n from a), q as (select *, floor(n * 0.1)::int as cy, floor(n * 0.2)::int as cw from r) select deployment_id, profile_idx, bin, round(median(x), 6) as x, round(avg(y) filter (where n < 3 or (ky > cy and ky <= n - cy)), 6) as y, round(avg(w) filter (where n < 3 or (kw > cw and kw <= n - cw)), 6) as w from q group by 1, 2, 3")
def _(spark, d):
    """Methods by channel, as the settings resolve them: one of its own, one with a parameter of its own, one as all others."""
    settings, k = Bin.of(MIX), F.col(S)
    df = cells(spark, d).withColumns({"y": k % 877 / 10.0, "w": k % 613 / 10.0})
    out = binning.reduce_bins(binning.with_bin(df, binning.bin_edges(df, "z", 4.0)), {c: settings.resolved(c) for c in ("x", "y", "w")})
    return out.select(D, P, "bin", *(F.round(c, 6).alias(c) for c in ("x", "y", "w")))


@query("bin_deployment", f"with {BINS}, p as (select distinct deployment_id, profile_idx from b0), f as (select deployment_id, profile_idx, i, avg(x) as x, median(z) as z from a group by 1, 2, 3) select p.deployment_id, p.profile_idx, k.i::int as bin, round(c, 6) as bin_center, round(x, 6) as x, round(z, 6) as z from p join k on p.deployment_id = k.deployment_id left join f on f.deployment_id = p.deployment_id and f.profile_idx = p.profile_idx and f.i = k.i")
def _(spark, d):
    out = binning.bin_deployment(cells(spark, d), {"x": ("mean", {}), "z": ("median", {})}, "z", 4.0)
    return out.select(D, P, "bin", *(F.round(c, 6).alias(c) for c in ("bin_center", "x", "z")))


@query("profile_rank", f"with {LOG}, p as (select deployment_id, profile_idx, min(t) as t from log group by 1, 2) select deployment_id, profile_idx, (row_number() over (partition by deployment_id order by t, profile_idx) - 1)::int as profile from p")
def _(spark, d):
    return binning.profile_rank(geo.profile_times(log(spark, d)), "profile_start_time").select(D, P, "profile")


@query("profile_attrs_merge", "with a as (select l_returnflag as g, l_linestatus as value, 'status' as key from lineitem union all select l_returnflag, 'same', 'fixed' from lineitem) select g, key, case when min(value) = max(value) then min(value) end as value, min(value) <> max(value) as dropped from a group by 1, 2")
def _(spark, d):
    li = spark.read.parquet(f"{d}/lineitem.parquet")
    attrs = li.select(F.col("l_returnflag").alias("g"), F.lit("status").alias("key"), F.col("l_linestatus").alias("value")).unionAll(li.select("l_returnflag", F.lit("fixed"), F.lit("same")))
    return binning.merged_attributes(attrs, "g")


# Concatenation.
@query("concat_union_grid", "with a as (select event_type as deployment_id, user_id % 10 as profile_idx, floor(value / 5) as bin_center, avg(value) as v from events where event_id % 2 = 0 group by 1, 2, 3), b as (select event_type || '2' as deployment_id, user_id % 10 as profile_idx, floor(value / 7) as bin_center, max(value) as w from events where event_id % 2 = 1 group by 1, 2, 3), u as (select * from a union all by name select * from b), f as (select * from (select distinct deployment_id, profile_idx from u) cross join (select distinct bin_center from u)) select f.deployment_id, f.profile_idx, f.bin_center, round(v, 6) as v, round(w, 6) as w from f left join u on u.deployment_id = f.deployment_id and u.profile_idx = f.profile_idx and u.bin_center = f.bin_center")
def _(spark, d):
    e = spark.read.parquet(f"{d}/events.parquet")
    part = lambda k, dep, width, agg: e.where(F.col("event_id") % 2 == k).groupBy(dep.alias(D), (F.col("user_id") % 10).alias(P), F.floor(F.col("value") / width).cast("double").alias("bin_center")).agg(agg)
    a = part(0, F.col("event_type"), 5, F.avg("value").alias("v"))
    b = part(1, F.concat("event_type", F.lit("2")), 7, F.max("value").alias("w"))
    return concat.union_grid(concat.union([a, b]).drop("file_rank"), [D, P]).select(D, P, "bin_center", F.round("v", 6).alias("v"), F.round("w", 6).alias("w"))


@query("concat_dedup_time", "with a as (select o_orderkey as profile_idx, epoch_us(o_orderdate) as t, 0 as r from orders where o_orderkey % 2 = 0 union all select o_orderkey, epoch_us(o_orderdate), 1 from orders where o_orderkey % 2 = 1) select profile_idx, t from (select *, row_number() over (partition by t order by r, profile_idx) as n from a) where n = 1")
def _(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias(P), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("t"))
    return concat.first_by_time(concat.union([o.where(f"{P} % 2 = 0"), o.where(f"{P} % 2 = 1")]), "t").select(P, "t")


@query(
    "concat_duplicates",
    f"with {BINS}, r as (select deployment_id, profile_idx, i::int as bin, round(c, 6) as bin_center, round(avg(x), 6) as x from a group by 1, 2, 3, 4), t as (select deployment_id, profile_idx, profile_idx * 60 + ascii(deployment_id) * 3600 as s from r group by 1, 2), f as (select t.deployment_id, t.profile_idx, c.bin_center from t cross join (select distinct bin_center from r) c where exists (select 1 from t u where u.s = t.s having min((u.deployment_id, u.profile_idx)) = (t.deployment_id, t.profile_idx))) select f.deployment_id, f.profile_idx, f.bin_center, r.bin, r.x from f left join r on r.deployment_id = f.deployment_id and r.profile_idx = f.profile_idx and r.bin_center = f.bin_center",
)
def _(spark, d):
    """All deployments are given twice, as when an instrument's memory was not wiped: its rows come once."""
    rows = binned(spark, d).groupBy(D, P, "bin", F.round("bin_center", 6).alias("bin_center")).agg(F.round(F.avg("x"), 6).alias("x"))
    start = F.timestamp_seconds(F.col(P) * 60 + F.ascii(D) * 3600)
    part = (rows.select(D, P, start.alias("time")).distinct(), rows)
    _, out = concat.concatenate([part, part], dense=True)
    return out.select(D, P, "bin_center", "bin", "x")


FLAGSHIP = f"""with {LOG}, h as (select *, case when value = lag(value) over w then null else value end as v from log {W}),
r as (select *, v - median(v) over c as r from h {C}),
b0 as (select deployment_id, profile_idx % 10 as profile_idx, case when abs(r) > 40 then null else v end as z, held from r),
e as (select deployment_id, min(z) as first, greatest(ceil((max(z) - min(z)) / 4.0), 1)::int as n from b0 group by 1),
k as (select deployment_id, i, first + 4.0 * i as lo, first + 4.0 * (i + 1) as hi, (first + 4.0 * i + (first + 4.0 * (i + 1))) / 2 as c from e, unnest(range(0, n)) as u(i)),
f as (select b0.deployment_id, profile_idx, i, avg(held) as held from b0 join k on b0.deployment_id = k.deployment_id and z <= hi and (z > lo or (i = 0 and z = lo)) group by 1, 2, 3),
p as (select distinct deployment_id, profile_idx from b0)
select p.deployment_id, p.profile_idx, k.i::int as bin, round(c, 6) as bin_center, round(held, 6) as held
from p join k on p.deployment_id = k.deployment_id left join f on f.deployment_id = p.deployment_id and f.profile_idx = p.profile_idx and f.i = k.i"""


@query("flagship", FLAGSHIP)
def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Holds removed, spikes removed, the mean of the channel in every bin of every profile."""
    df = corrections.correct(log(spark, d), {"value": corrections.Correction()})
    df, _ = despike(df, "value", ABS, True)
    df = df.select(D, (F.col(P) % 10).alias(P), S, F.col("value").alias("z"), "held")
    out = binning.bin_deployment(df, {"held": ("mean", {})}, "z", 4.0)
    return out.select(D, P, "bin", *(F.round(c, 6).alias(c) for c in ("bin_center", "held")))
