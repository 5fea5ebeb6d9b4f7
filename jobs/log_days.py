"""Log days: cleans instrument logs and writes them by deployment and day, with a report of each day.

An event type is a deployment, an event a sample, its value the channel. Held values go (each that equals the one before
it), an offset is added, and spikes against a rolling median go by one threshold for each deployment. Samples are written
by (part, day), with what happened to each, and replace those partitions alone: a day that is run again, or a few days of a
backfill, leave all others as they are. The report counts what is written.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halocline.operators import corrections
from halocline.operators.despike import Despiking, despike
from halocline.operators.slices import PLACE, ROWS, in_slices, placed
from halocline.sources import naming

from . import common

SAMPLES = "deployment_id string, sample_idx long, time timestamp_ntz, raw double, value double, held boolean, spike boolean, part string, day string"
REPORT = "deployment_id string, samples long, held long, spikes long, missing long, mean double, least double, most double, part string, day string"


@dataclass(frozen=True)
class Settings:
    remove_holds: bool = True
    offset: float = 0.0
    window: int = 31
    rejection_percentile: float = 99.5
    first_day: str | None = None
    last_day: str | None = None
    rows_per_slice: int = ROWS

    def despiking(self) -> Despiking:
        return Despiking(self.window, min(90.0, self.rejection_percentile / 2), self.rejection_percentile, method="raw_percentile")


def logs(events: DataFrame) -> DataFrame:
    """Samples of all deployments. Those without type are of `unknown`; those without id have no place and go. Ids are unique."""
    kept = events.where("event_id is not null")
    return kept.select(F.coalesce("event_type", F.lit("unknown")).alias("deployment_id"), F.col("event_id").alias("sample_idx"), F.col("ts").cast("timestamp_ntz").alias("time"), F.col("value").cast("double").alias("raw"))


def cleaned(samples: DataFrame, settings: Settings) -> DataFrame:
    """samples with `value`, and whether it was held or a spike."""
    value = F.when(~F.isnan("raw"), F.col("raw"))
    log = placed(samples.withColumn("value", value), settings.rows_per_slice)
    w = lambda k: corrections.without_holds(F.col("value"), k.log())
    marked = in_slices(log, 1, lambda part, k: part.withColumn("held", F.lit(settings.remove_holds) & F.col("value").isNotNull() & w(k).isNull()), settings.rows_per_slice)
    shifted = marked.withColumn("value", F.when(~F.col("held"), F.col("value") + F.lit(settings.offset)))
    clean, _ = despike(shifted.withColumn("_before", F.col("value")), "value", settings.despiking(), rows=settings.rows_per_slice)
    return clean.withColumn("spike", F.col("_before").isNotNull() & F.col("value").isNull()).drop("_before", PLACE)


def run(spark: SparkSession, events: str, out: str, settings: Settings = Settings()) -> dict[str, int]:
    """Writes out/samples and out/days by (part, day); what it read and wrote. The thresholds are those of whole logs, whichever days are written."""
    counted = common.Counted()
    done = cleaned(logs(counted.of(spark.read.parquet(events), f"read from {events}")), settings)
    slug = naming.slug_column(F.col("deployment_id"))
    day = F.coalesce(F.date_format("time", "yyyy-MM-dd"), F.lit("unknown"))
    done = done.withColumns({"part": F.when(slug != "", slug).otherwise("other"), "day": day})
    if settings.first_day is not None:
        done = done.where(F.col("day") >= settings.first_day)
    if settings.last_day is not None:
        done = done.where(F.col("day") <= settings.last_day)
    names = lambda schema: [x.split()[0] for x in schema.split(", ")]
    common.replace_partitions(counted.of(done.select(names(SAMPLES)), f"written to {out}/samples"), f"{out}/samples", "part", "day")
    written = common.table(spark, f"{out}/samples", SAMPLES)
    count = lambda c: F.sum(c.cast("long"))
    days = written.groupBy("deployment_id", "part", "day").agg(
        F.count("*").alias("samples"), count(F.col("held")).alias("held"), count(F.col("spike")).alias("spikes"), count(F.col("raw").isNull() | F.isnan("raw")).alias("missing"),
        F.avg("value").alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"),
    )
    common.replace_partitions(counted.of(days.select(names(REPORT)), f"written to {out}/days"), f"{out}/days", "part", "day")
    return counted.told()


def read(spark: SparkSession, out: str) -> DataFrame:
    """The report as it stands."""
    return common.table(spark, f"{out}/days", REPORT).drop("part")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job on the whole table events, twice into one folder; the second run replaces every partition by the same."""
    out = common.own_folder(spark, "log-days")
    for _ in range(2):
        run(spark, f"{sf_dir}/events.parquet", out)
    return read(spark, out).withColumns({c: F.round(c, 6) for c in ("mean", "least", "most")})


ORACLE = """with l as (select coalesce(event_type, 'unknown') as d, event_id as i, strftime(ts, '%Y-%m-%d') as day, value as raw from events where event_id is not null),
h as (select *, coalesce(raw = lag(raw) over (partition by d order by i), false) as held from l),
k as (select *, case when not held then raw end as v from h),
r as (select *, v - median(v) over (partition by d order by i rows between 15 preceding and 15 following) as r from k),
t as (select d, quantile_cont(abs(r), 0.995) as threshold from r group by 1),
c as (select r.*, coalesce(abs(r) > threshold, false) as spike, case when not coalesce(abs(r) > threshold, false) then v end as value from r join t on r.d = t.d)
select d as deployment_id, coalesce(day, 'unknown') as day, count(*)::bigint as samples, sum(held::int)::bigint as held, sum(spike::int)::bigint as spikes, sum((raw is null)::int)::bigint as missing,
round(avg(value), 6) as mean, round(min(value), 6) as least, round(max(value), 6) as most from c group by 1, 2"""

PATHS = {"events": "folder with the events as Parquet", "out": "folder for samples and days"}

if __name__ == "__main__":
    sys.exit(common.command_line(__doc__.split("\n")[0], Settings, PATHS, run))
