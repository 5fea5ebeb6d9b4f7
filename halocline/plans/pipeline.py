"""The three stages over any number of deployments at once: process, bin, concatenate."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import binning, concat, corrections, ctlag, derived, geo, profiles
from ..operators.despike import despike, facts
from ..operators.model import KEYS, Keys, floating
from ..operators.slices import PLACE, ROWS
from ..operators.slices import placed as with_places
from ..operators.tables import Tally, stores
from .config import Bin, Process
from .lineage import Lineage

VERBOSE = 15
logging.addLevelName(VERBOSE, "VERBOSE")
log = logging.getLogger("halocline")


@dataclass
class Processed:
    samples: DataFrame
    profiles: DataFrame
    thresholds: dict[str, DataFrame]
    lineage: Lineage


def process(raw: DataFrame, settings: Process, track: DataFrame | None = None, lineage: Lineage | None = None, keys: Keys = KEYS, rows: int = ROWS) -> Processed:
    """Raw samples to casts with positions and derived variables.

    Corrections share one exchange and sort by slices of `rows` samples, so a long log is many tasks' work. Deployments
    with settings of their own are processed by a call each. The history tells how many values each step removed, in all
    deployments of the call; the jobs that write the intermediate tables count them.
    """
    line = (lineage or Lineage()).extended()
    cut, tally = stores(raw.sparkSession), Tally(raw.sparkSession)
    df = corrections.time_range(raw, settings.start_time, settings.end_time)
    df = corrections.select_channels(df, settings.read_channels, keys)
    channels = [c for c in floating(df) if c not in (keys.deployment, keys.order, "time")]
    plan = settings.corrections(channels)
    df = corrections.correct(with_places(df, rows, keys), plan, keys, rows, tally)
    found: dict[str, DataFrame] = {}
    spiky = {c: s for c, s in settings.despiked().items() if c in channels}
    if spiky:
        df = cut(df)
    for c, s in spiky.items():
        df, found[c] = despike(df, c, s, keys=keys, rows=rows, tally=tally)
        df = cut(df)
    df = cut(corrections.sea_pressure(df.drop(PLACE), settings.atmospheric_pressure))
    for c, n in tally.found("held").items():
        line.record(f"removed {n} held value(s)", c)
    for c, s in plan.items():
        if s.shift:
            line.record(f"shifted by {s.shift} sample(s)", c)
        if s.offset is not None:
            line.record(f"added offset {s.offset}", c)
    _record_spikes(line, tally, found)
    cycles = profiles.find_cycles(df, settings.detection(), keys=keys)
    casts = cut(profiles.slices(cycles, settings.profiles.direction, keys))
    search = settings.search()
    if search.enabled:
        scores = ctlag.lag_scores(profiles.extract(df, casts, keys), search, keys=keys)
        df = ctlag.apply_lags(df, cut(ctlag.best_lags(scores, keys)), keys=keys, rows=rows)
    samples = profiles.extract(df, casts, keys)
    times = geo.profile_times(samples, keys=keys)
    g = settings.geolocation
    if track is not None:
        points = track.select(F.col(g.time_variable).alias("time"), F.col(g.latitude_variable).alias("latitude"), F.col(g.longitude_variable).alias("longitude"))
        placed = geo.interpolated_position(times, points, str(g.external_dataset_path))
        line.record(f"attached position (interpolated from {g.external_dataset_path})")
    else:
        placed = geo.reference_position(times, g.reference_latitude, g.reference_longitude)
        line.record("attached position (reference position)")
    placed = cut(placed)
    samples = samples.join(placed.select(keys.deployment, keys.profile, "latitude"), [keys.deployment, keys.profile])
    samples, more, added = derived.derive(samples, settings.derived_variables.as_dict(), settings.despiked(), keys, cut=cut, tally=tally)
    _record_spikes(line, tally, more)
    line.record(f"computed derived variables: {', '.join(added)}")
    for v in derived.VARIABLES:
        if v.key in added:
            line.metadata[v.key] = {"units": v.units, "long_name": v.long_name, "standard_name": v.standard_name}
    log.log(VERBOSE, "planned %d derived variable(s)", len(added))
    return Processed(samples.drop("latitude"), placed, found | more, line)


def _record_spikes(line: Lineage, tally: Tally, channels: Iterable[str]) -> None:
    for c in channels:
        for n in tally.found(f"spikes {c}").values():
            line.record(f"removed {n} spike(s)", c)


def record_thresholds(result: Processed, settings: Process, deployment: str, keys: Keys = KEYS) -> Lineage:
    """The result's lineage with a line for each despiked channel of a deployment; runs the threshold tables."""
    line, rules = result.lineage.extended(), settings.despiked()
    for c, table in result.thresholds.items():
        row = table.where(F.col(keys.deployment) == deployment).first()
        if row is not None:
            line.record(f"despiked {c} (" + ", ".join(f"{k} {v:g}" if isinstance(v, float) else f"{k} {v}" for k, v in facts(rules[c], row).items()) + ")", c)
    return line


def bin_profiles(samples: DataFrame, placed: DataFrame, settings: Bin, keys: Keys = KEYS) -> tuple[DataFrame, DataFrame]:
    """(profiles by start time, grid rows) of all deployments, each on its own grid."""
    channels = [c for c in floating(samples) if c != settings.channel]
    rows = binning.bin_deployment(samples, {c: settings.resolved(c) for c in channels}, settings.channel, settings.step, settings.first, settings.last, keys, placed)
    known = placed.withColumnRenamed("profile_start_time", "time")
    return binning.profile_rank(known, keys=keys), rows


def concatenate(parts: list[tuple[DataFrame, DataFrame]], attributes: list[dict] | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """(profiles, rows, attributes): duplicates by time and attributes that differ are left out, with a warning of how many and which."""
    concat.duplicates([p for p, _ in parts])
    kept, _ = concat.agreed(attributes or [])
    return *concat.concatenate(parts), kept
