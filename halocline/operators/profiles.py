"""Segmentation of a log into casts.

Two ways lead to the four bounds of each turnaround cycle: peaks and troughs of the pressure record (a kernel that sees
one deployment at a time, like the instrument), and a zigzag segmentation in window functions alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .model import KEYS, Keys, require

DIRECTIONS = ("down", "up", "both")


@dataclass(frozen=True)
class Detection:
    apply_smoothing: bool = False
    window_length: int = 9
    polyorder: int = 2
    min_pressure: float = -1.0
    peak_height: float = 25.0
    peak_distance: int = 200
    peak_width: int = 200
    peak_prominence: float = 25.0
    trough_prominence: float = 2.0
    trough_distance: int = 5
    trough_width: int = 5
    run_length: int = 4
    min_pressure_change: float = 0.01
    apply_speed_threshold: bool = False
    min_speed: float = 0.2
    speed_direction: str = "both"
    missing: str = "drop"


def local_maxima(x: np.ndarray) -> np.ndarray:
    """Places above both neighbours; the middle of a plateau."""
    if len(x) < 3:
        return np.zeros(0, np.int64)
    turns = np.flatnonzero(np.diff(x) != 0)
    starts = np.concatenate([[0], turns + 1])
    ends = np.concatenate([turns, [len(x) - 1]])
    v = x[starts]
    inner = np.arange(1, len(v) - 1)
    top = inner[(v[inner] > v[inner - 1]) & (v[inner] > v[inner + 1])]
    return (starts[top] + ends[top]) // 2


def prominences(x: np.ndarray, peaks: np.ndarray) -> np.ndarray:
    """How far each local maximum rises above the higher of the lowest points on either side, up to where x is higher.

    One pass each way over all local maxima, with a stack of those that are still the highest: linear in their number.
    The ends of x count as walls where they are higher.
    """

    def lowest(top: np.ndarray, valley: np.ndarray, wall: float) -> np.ndarray:
        """For each maximum the least value back to the first higher one. valley: the least between it and the one before."""
        out, stack = np.empty(len(top)), [(float("inf"), 0.0)]
        if len(top) and wall > valley[0]:
            stack.append((wall, float("inf")))  # an end of x that descends to the first valley
        for n, (h, low) in enumerate(zip(top.tolist(), valley.tolist(), strict=True)):
            while stack[-1][0] <= h:
                low = min(low, stack.pop()[1])
            out[n] = low
            stack.append((h, low))
        return out

    if not len(peaks):
        return np.zeros(0)
    top = x[peaks]
    cuts = np.concatenate([[0], peaks, [len(x) - 1]])
    valley = np.minimum.reduceat(x, cuts[:-1])  # from each cut to before the next: maxima are no valleys
    valley[-1] = min(valley[-1], x[-1])
    left = lowest(top, valley[:-1], float(x[0]))
    right = lowest(top[::-1], valley[1:][::-1], float(x[-1]))[::-1]
    return top - np.maximum(left, right)


def widths(x: np.ndarray, peaks: np.ndarray, prominence: np.ndarray) -> np.ndarray:
    """The width of each peak at half its prominence, between linearly interpolated crossings; looks no farther than these."""

    def crossing(at: int, level: float, step: int) -> float:
        """From a peak outward to the first sample at the level or below it, back to where the line to it crosses."""
        chunk, edge = 64, at
        while True:
            far = edge + step * chunk
            part = x[edge + 1 : far + 1] if step > 0 else x[max(far, 0) : edge][::-1]
            below = np.flatnonzero(part <= level)
            if len(below):
                i = edge + step * (1 + int(below[0]))
                return i - step * (level - x[i]) / (x[i - step] - x[i]) if x[i] < level else float(i)
            if len(part) < chunk:
                return float(edge + step * len(part))
            edge, chunk = far, 2 * chunk

    levels = x[peaks] - prominence / 2
    return np.array([crossing(int(p), v, 1) - crossing(int(p), v, -1) for p, v in zip(peaks, levels, strict=True)], float).reshape(-1)


def find_peaks(x: np.ndarray, height: float | None = None, distance: int = 1, prominence: float = 0.0, width: float = 0.0) -> np.ndarray:
    """Peaks by height, then distance (higher ones first, of equal ones the later), prominence and width."""
    every = local_maxima(x)
    rises = prominences(x, every)
    tall = x[every] >= height if height is not None else np.ones(len(every), bool)
    peaks, rises = every[tall], rises[tall]
    keep = np.ones(len(peaks), bool)
    if distance > 1:
        near = np.searchsorted(peaks, peaks - distance, "right"), np.searchsorted(peaks, peaks + distance, "left")
        for n, low, high in zip(*(v[np.argsort(x[peaks], kind="stable")[::-1]].tolist() for v in (np.arange(len(peaks)), *near)), strict=True):
            if keep[n]:
                keep[low:high] = False
                keep[n] = True
    keep &= rises >= prominence
    peaks, rises = peaks[keep], rises[keep]
    return peaks[widths(x, peaks, rises) >= width] if width > 0 else peaks


def smooth(x: np.ndarray, window: int, order: int) -> np.ndarray:
    """Least-squares polynomial over a moving window (Savitzky-Golay); the ends by the polynomial of the end window."""
    half, n = window // 2, len(x)
    if n < window:
        return x
    t = np.arange(window) - half
    fit = np.linalg.pinv(np.vander(t, order + 1, increasing=True))
    out = np.convolve(x, fit[0][::-1], "same")
    for part, at in ((x[:window], slice(0, half)), (x[-window:], slice(n - half, n))):
        curve = np.vander(t, order + 1, increasing=True) @ (fit @ part)
        out[at] = curve[:half] if at.start == 0 else curve[window - half :]
    return out


def cycles_of(p: np.ndarray, seconds: np.ndarray | None, s: Detection) -> np.ndarray:
    """Rows (down_start, down_end, up_start, up_end) of each cycle, as places in p.

    A cycle is a peak between the troughs on either side. The descent begins with the first run of run_length steps down
    after the trough before, and the ascent ends with the last such run up before the trough after. down_end and up_start
    are the ends of the peak's plateau of steps too small to count.
    """
    bad = ~np.isfinite(p)
    if bad.any() and s.missing == "raise":
        raise ValueError("sea pressure has missing values.")
    at = np.flatnonzero(~bad)
    x = p[at].astype(float)
    if len(x) < 3:
        return np.zeros((0, 4), np.int64)
    if s.apply_smoothing:
        x = smooth(x, s.window_length, s.polyorder)
    peaks = find_peaks(x, s.peak_height, s.peak_distance, s.peak_prominence, s.peak_width)
    troughs = find_peaks(-x, None, s.trough_distance, s.trough_prominence, s.trough_width)
    step = np.diff(x)
    speed = step / np.diff(seconds[at]) if seconds is not None else None
    down, up = step >= s.min_pressure_change, -step >= s.min_pressure_change
    if s.apply_speed_threshold and speed is not None:
        if s.speed_direction in ("down", "both"):
            down &= speed >= s.min_speed
        if s.speed_direction in ("up", "both"):
            up &= -speed >= s.min_speed

    def run(moves: np.ndarray) -> np.ndarray:
        """Whether a run of run_length begins at each step."""
        n = len(moves) - s.run_length + 1
        return np.convolve(moves, np.ones(s.run_length, int), "valid")[: max(n, 0)] == s.run_length

    down_run, up_run = run(down), run(up)
    found = []
    for k, peak in enumerate(peaks):
        before, after = np.searchsorted(troughs, peak, "left"), np.searchsorted(troughs, peak, "right")
        low = max(troughs[before - 1] if before else 0, peaks[k - 1] if k else 0)
        high = min(troughs[after] if after < len(troughs) else len(x) - 1, peaks[k + 1] if k + 1 < len(peaks) else len(x) - 1)
        a = np.flatnonzero(down_run[low:peak]) + low
        b = np.flatnonzero(up_run[peak:high]) + peak
        if not len(a) or not len(b):
            continue
        start, end = a[0], min(b[-1] + s.run_length, high)
        turn = np.flatnonzero(down_run[start : max(peak - s.run_length + 1, start + 1)]) + start
        down_end, up_start = min(turn[-1] + s.run_length, peak), b[0]
        while start < down_end and x[start] <= s.min_pressure:
            start += 1
        while end > up_start and x[end] <= s.min_pressure:
            end -= 1
        found.append((at[start], at[down_end], at[max(up_start, down_end)], at[end]))
    return np.array(found, np.int64).reshape(-1, 4)


def find_cycles(df: DataFrame, settings: Detection = Detection(), pressure: str = "sea_pressure", time: str = "time", keys: Keys = KEYS) -> DataFrame:
    """(deployment, cycle, down_start, down_end, up_start, up_end): keys of samples. A deployment is one task's group."""
    require(df, [pressure], "Cannot find profiles")
    dep, order = keys.deployment, keys.order
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_order").reset_index(drop=True)
        seconds = (pdf["_t"] - pdf["_t"].iloc[0]).to_numpy() / 1e6 if settings.apply_speed_threshold else None
        c = pdf["_order"].to_numpy()[cycles_of(pdf["_p"].to_numpy(float), seconds, settings)].reshape(-1, 4)
        out = pd.DataFrame(c, columns=["down_start", "down_end", "up_start", "up_end"])
        out.insert(0, "cycle", np.arange(len(out)))
        out.insert(0, dep, pdf[dep].iloc[0])
        return out

    t = F.unix_micros(F.col(time).cast("timestamp")) if settings.apply_speed_threshold else F.lit(0).cast("long")
    own = df.select(dep, F.col(order).cast("long").alias("_order"), F.col(pressure).cast("double").alias("_p"), t.alias("_t"))
    return own.groupBy(dep).applyInPandas(work, f"`{dep}` {kinds[dep]}, cycle long, down_start long, down_end long, up_start long, up_end long")


def slices(cycles: DataFrame, direction: str = "down", keys: Keys = KEYS) -> DataFrame:
    """(deployment, profile, start, stop): half-open casts in order, the dwell between them left out."""
    if direction not in DIRECTIONS:
        raise ValueError(f"direction must be one of {', '.join(DIRECTIONS)}; got {direction!r}.")
    part = lambda n, a, b: F.struct(F.lit(n).alias("part"), F.col(a).alias("start"), F.col(b).alias("stop"))
    both = [part(0, "down_start", "down_end")] * (direction != "up") + [part(1, "up_start", "up_end")] * (direction != "down")
    rows = cycles.select(keys.deployment, "cycle", F.explode(F.array(*both)).alias("s"))
    place = F.row_number().over(Window.partitionBy(keys.deployment).orderBy("cycle", "s.part")) - 1
    return rows.select(keys.deployment, place.alias(keys.profile), F.col("s.start").alias("start"), F.col("s.stop").alias("stop"))


def extract(df: DataFrame, casts: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """df's samples within a cast, with its profile index.

    Casts of a deployment don't overlap, so each is marked at its first sample by an equi-join and carried forward in the
    window that the corrections use already: no range join.
    """
    marks = casts.select(keys.deployment, F.col("start").alias(keys.order), F.struct(keys.profile, "stop").alias("_cast")).where(F.col("start") < F.col("stop"))
    carried = df.join(marks, [keys.deployment, keys.order], "left").withColumn("_cast", F.last("_cast", ignorenulls=True).over(keys.log().rowsBetween(Window.unboundedPreceding, 0)))
    return carried.where(F.col(keys.order) < F.col("_cast.stop")).withColumn(keys.profile, F.col(f"_cast.{keys.profile}")).drop("_cast")


def zigzag(df: DataFrame, pressure: str = "sea_pressure", keys: Keys = KEYS) -> DataFrame:
    """(deployment, segment, direction, start, stop, n): stretches that go one way, by the sign of each step.

    A step without change continues the stretch it is in. stop is the last sample.
    """
    w = keys.log()
    step = df.select(keys.deployment, keys.order, F.signum(F.col(pressure) - F.lag(pressure).over(w)).alias("_s"))
    step = step.withColumn("_s", F.when(F.col("_s") != 0, F.col("_s")))
    held = step.withColumn("_d", F.last("_s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    turns = held.withColumn("_turn", F.when(F.col("_d") != F.lag("_d").over(w), 1).otherwise(0))
    parts = turns.withColumn("segment", F.sum("_turn").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return parts.groupBy(keys.deployment, "segment").agg(F.max("_d").cast("int").alias("direction"), F.min(keys.order).alias("start"), F.max(keys.order).alias("stop"), F.count("*").alias("n"))
