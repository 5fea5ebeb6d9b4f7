"""Small cases with known results for the log operators."""

import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halocline.functions import gpd, robust
from halocline.functions import seawater as sw
from halocline.operators import binning, concat, corrections, ctlag, derived, geo, profiles
from halocline.operators.despike import Despiking, despike, facts, thresholds
from halocline.operators.model import KEYS, nan_to_null, null_to_nan

D, P, S = KEYS.deployment, KEYS.profile, KEYS.order


def channel(spark, values, deployment="d", profile=0):
    rows = [(deployment, profile, i, None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"{D} string, {P} long, {S} long, x double")


def values(df, c="x"):
    return [r[c] for r in df.orderBy(D, P, S).collect()]


def test_missing_value_breaks_a_hold(spark):
    df = channel(spark, [1, 1, None, 1])
    assert values(corrections.correct(df, {"x": corrections.Correction()})) == [1, None, None, 1]
    assert corrections.hold_counts(df, ["x"]).first()["x"] == 1


def test_holds_then_shift_then_offset(spark):
    df = channel(spark, [1, 1, 2, 3, 50, 3, 3])
    out = corrections.correct(df, {"x": corrections.Correction(True, 1, None)})
    assert values(out) == [None, 1, None, 2, 3, 50, 3]
    done, _ = despike(out, "x", Despiking(3, method="absolute_threshold", threshold=10.0))
    assert [i for i, (a, b) in enumerate(zip(values(out), values(done), strict=True)) if a is not None and b is None] == [5, 6]


@pytest.mark.parametrize("shift", [-9, -2, 0, 3, 9])
def test_shift(spark, shift):
    x = [1.0, 2.0, 3.0, 4.0]
    want = [x[i - shift] if 0 <= i - shift < len(x) else None for i in range(len(x))]
    assert values(corrections.correct(channel(spark, x), {"x": corrections.Correction(False, shift)})) == want


def test_nan_is_null_inside(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert nan_to_null(df, ["x"]).where("x is null").count() == 1
    assert null_to_nan(nan_to_null(df, ["x"]), ["x"]).where("isnan(x)").count() == 1


def test_bad_inputs_are_named(spark):
    df = channel(spark, [1])
    with pytest.raises(ValueError, match="no y"):
        corrections.correct(df, {"y": corrections.Correction()})
    with pytest.raises(ValueError, match="floating"):
        corrections.correct(df, {S: corrections.Correction()})
    with pytest.raises(ValueError, match="before"):
        corrections.time_range(df, datetime(2020, 1, 2), datetime(2020, 1, 1))
    with pytest.raises(ValueError):
        corrections.subset_places(df, [3, 1])
    with pytest.raises(ValueError):
        corrections.add_channel(df, "x", F.lit(1))
    with pytest.raises(KeyError):
        corrections.remove_channel(df, "none")
    with pytest.raises(ValueError, match="sea_pressure"):
        corrections.sea_pressure(df, None)
    with pytest.raises(ValueError, match="sea_pressure"):
        profiles.find_cycles(df)


@pytest.mark.parametrize(
    ("x", "gone"),
    [([1, 1.02, 0.98, 1.01, 50, 0.99, 1.03, 0.97, 1], [4]), ([1, 1.02, 0.98, 1000, 1.03, 0.97, 1.01, 5, 0.99, 1], [3, 7]), ([2] * 7, [])],
)
def test_despike_absolute(spark, x, gone):
    out, _ = despike(channel(spark, x), "x", Despiking(3, method="absolute_threshold", threshold=1.0))
    assert [i for i, v in enumerate(values(out)) if v is None] == gone


def test_thresholds(spark):
    rng = np.random.default_rng(0)
    r = rng.uniform(size=500)
    tails = ((1 - r) ** -0.4 - 1) * 1.5 / 0.4
    df = spark.createDataFrame([("a", float(v)) for v in tails] + [("b", None)], f"{D} string, _residual double")
    found = {x[D]: x for x in thresholds(df, Despiking(min_exceedances=40)).collect()}
    assert found["a"]["n"] == 500 and found["a"]["n_exceedances"] == 50 and not found["a"]["used_fallback"]
    assert found["b"]["n"] == 0 and found["b"]["used_fallback"] and found["b"]["threshold"] is None
    told = facts(Despiking(), found["a"])
    assert told["method"] == "gpd_percentile" and told["tail shape"] == found["a"]["shape"] and told["samples"] == found["a"]["n"]
    low = thresholds(df, Despiking()).where(f"{D} = 'a'").first()
    assert low["used_fallback"] and low["threshold"] == pytest.approx(np.percentile(tails, 99.9))
    told = facts(Despiking(), low)
    assert told["excesses"] == 50 and told["method"] == "percentile instead of tail fit" and "tail shape" not in told


def test_gpd_recovers_its_shape():
    u = np.random.default_rng(0).uniform(size=5000)
    x = ((1 - u) ** -0.4 - 1) * 1.5 / 0.4
    shape, scale = gpd.fit(x)
    assert abs(shape - 0.4) < 0.1 and abs(scale - 1.5) < 0.2


def irls(x, weight, rounds=100, tol=1e-8):
    if len(x) < 3:
        return float(np.mean(x))
    at = np.median(x)
    s = 1.4826 * np.median(np.abs(x - at))
    for _ in range(rounds):
        if s == 0:
            return at
        w = weight((x - at) / s)
        if w.sum() == 0:
            return at
        new = (w * x).sum() / w.sum()
        s_new = 1.4826 * np.median(np.abs(x - new))
        done = s_new == 0 or abs(new - at) < tol * s_new
        at, s = new, s_new
        if done:
            return at
    return at


REDUCERS = {
    "mean": np.mean,
    "median": np.median,
    "huber": lambda x: irls(x, lambda u: np.where(np.abs(u) <= 1.345, 1.0, 1.345 / np.maximum(np.abs(u), 1e-300))),
}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-50, 50, width=32), min_size=1, max_size=12))
def test_reducers_match_numpy(spark, x):
    df = spark.createDataFrame([([float(v) for v in x],)], "x array<double>")
    got = df.select(*(robust.reduce(F.col("x"), m).alias(m) for m in REDUCERS)).first()
    for m, f in REDUCERS.items():
        assert got[m] == pytest.approx(f(np.array(x)), rel=1e-9, abs=1e-6)


def test_reducers_known(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 100.0],)], "x array<double>")
    assert df.select(robust.trimmed_mean(F.col("x")), robust.winsorized_mean(F.col("x"))).first()[:] == (3.0, 3.0)
    tied = spark.createDataFrame([([5.0] * 6 + [100.0],)], "x array<double>")
    assert tied.select(robust.huber(F.col("x")), robust.biweight(F.col("x"))).first()[:] == (5.0, 5.0)
    assert spark.createDataFrame([([],)], "x array<double>").select(robust.huber(F.col("x"))).first()[0] is None
    with pytest.raises(ValueError):
        robust.reduce(F.col("x"), "mode")


def edges_of(spark, x, **k):
    df = channel(spark, x)
    e = binning.bin_edges(df, "x", **k)
    n = e.first()["n_bins"]
    return [r[0] for r in e.select(F.explode(F.sequence(F.lit(0), F.lit(n))).alias("i"), "first", "step", "n_bins").select(binning.edge(F.col("i"))).collect()]


def test_edges(spark):
    assert edges_of(spark, [0, 5, 10], step=3.0) == [0, 3, 6, 9, 12]
    down = edges_of(spark, [-10, -2, 3], step=-1.0)
    assert down[-1] == 3 and down[0] <= -10


def test_bins_are_right_closed(spark):
    rows = [("d", 0, i, z, t) for i, (z, t) in enumerate([(-0.1, 10.0), (-0.4, 12.0), (-0.6, 20.0), (-1.4, None)])]
    df = spark.createDataFrame(rows, f"{D} string, {P} long, {S} long, z double, t double")
    out = binning.bin_deployment(df, {"t": ("mean", {})}, "z", -0.5, 0.0, -1.5).orderBy("bin_center").collect()
    assert [(r["bin_center"], r["t"]) for r in out] == [(-1.25, None), (-0.75, 20.0), (-0.25, 11.0)]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-30, 30), min_size=2, max_size=20), st.sampled_from([0.1, 0.3, 1.0, 2.5]))
def test_assignment_matches_search(spark, ticks, step):
    x = [t * step for t in ticks]
    df = channel(spark, x)
    e = edges_of(spark, x, step=step)
    got = {r[S]: r["bin"] for r in binning.with_bin(df, binning.bin_edges(df, "x", step), "x").collect()}
    want = {i: max(int(np.searchsorted(e, v, "left")) - 1, 0) for i, v in enumerate(x) if e[0] <= v <= e[-1]}
    assert got == want


def test_identity_and_attributes(spark):
    one = spark.createDataFrame([("d", "1", "f"), ("d", "2", "f")], "deployment_id string, instrument_serial_number string, source_file string")
    with pytest.raises(ValueError):
        binning.check_one_identity(one)
    attrs = spark.createDataFrame([("g", "a", "1"), ("g", "a", "1"), ("g", "b", "1"), ("g", "b", "2")], "g string, key string, value string")
    assert {r["key"]: r["dropped"] for r in binning.merged_attributes(attrs, "g").collect()} == {"a": False, "b": True}


def test_cycles_and_slices(spark):
    rows = [("d", 0, 0, 4, 5, 9)]
    c = spark.createDataFrame(rows, f"{D} string, cycle long, down_start long, down_end long, up_start long, up_end long")
    pick = lambda way: [(r["start"], r["stop"]) for r in profiles.slices(c, way).orderBy(P).collect()]
    assert pick("down") == [(0, 4)] and pick("up") == [(5, 9)] and pick("both") == [(0, 4), (5, 9)]
    got = profiles.extract(channel(spark, range(10)).drop(P), profiles.slices(c, "both"))
    assert sorted((r[P], r[S]) for r in got.collect()) == [(0, i) for i in range(4)] + [(1, i) for i in range(5, 9)]


def test_synthetic_dives_are_found(spark):
    turn = np.concatenate([np.concatenate([np.linspace(0, 500, 333), np.linspace(500, 0, 333)]) for _ in range(3)])
    df = channel(spark, turn).withColumnRenamed("x", "sea_pressure")
    found = profiles.find_cycles(df).orderBy("cycle").collect()
    assert len(found) == 3
    for r in found:
        assert 0 <= r["down_start"] <= r["down_end"] <= r["up_start"] <= r["up_end"] < len(turn)
    holes = df.withColumn("sea_pressure", F.when(F.col(S) % 50 != 7, F.col("sea_pressure")))
    assert profiles.find_cycles(holes).count() == 3
    with pytest.raises(Exception, match="missing"):
        profiles.find_cycles(holes, profiles.Detection(missing="raise")).collect()


@pytest.mark.parametrize("k", [-2, 0, 3])
def test_injected_lag_is_found(spark, k):
    rng = np.random.default_rng(1)
    t = 0.01 * np.arange(80) + rng.normal(size=80)
    c = np.full(80, np.nan)
    for i in range(80):
        if 0 <= i - k < 80:
            c[i] = t[i - k]
    rows = [("d", 0, i, None if np.isnan(c[i]) else float(c[i]), float(t[i]), 1.0) for i in range(80)]
    df = spark.createDataFrame(rows, f"{D} string, {P} long, {S} long, electrical_conductivity double, temperature double, sea_pressure double")
    stub = lambda d, out, c, t, p: d.withColumn(out, F.col(c) - F.col(t))
    scores = ctlag.lag_scores(df, ctlag.LagSearch(True, window=21, min_lag=-5, max_lag=5), stub)
    assert ctlag.best_lags(scores).first()["lag"] == -k
    flat = df.withColumns({"temperature": F.lit(1.0), "electrical_conductivity": F.lit(2.0)})
    assert ctlag.best_lags(ctlag.lag_scores(flat, ctlag.LagSearch(True, min_lag=-5, max_lag=5), stub)).first()["lag"] == 0


def test_position_on_a_track(spark):
    t = lambda h, m=0: datetime(2020, 1, 1, h, m)
    track = spark.createDataFrame([(t(0), 0.0, -50.0), (t(1), 10.0, -40.0), (t(2), 20.0, -30.0)], "time timestamp_ntz, latitude double, longitude double")
    p = lambda *times: spark.createDataFrame([("d", i, x, x) for i, x in enumerate(times)], f"{D} string, {P} long, profile_start_time timestamp_ntz, profile_end_time timestamp_ntz")
    got = geo.interpolated_position(p(t(0, 30), t(2)), track).orderBy(P).collect()
    assert [(r["latitude"], r["longitude"]) for r in got] == [(5, -45), (20, -30)]
    with pytest.raises(ValueError):
        geo.interpolated_position(p(t(3)), track)


@pytest.mark.parametrize("rows", [7, 1 << 20])
def test_positions_of_a_dense_track(spark, rows):
    """Against numpy, however the times are cut: parts without a point, ends of the track, one point, and no pairs in the plan."""
    r = np.random.default_rng(3)
    start = datetime(2020, 1, 1)
    at = lambda s: start + timedelta(milliseconds=int(s))
    t = np.unique(np.concatenate([[0, 90_000], r.integers(0, 9_000, 60), r.integers(80_000, 90_000, 60)]))
    a, o = r.uniform(-90, 90, len(t)), r.uniform(-180, 180, len(t))
    track = spark.createDataFrame([(at(x), float(y), float(z)) for x, y, z in zip(t, a, o, strict=True)], "time timestamp_ntz, latitude double, longitude double")
    s = np.concatenate([t[:20], [0, 90_000, 90_000], r.integers(0, 90_000, 80)])
    schema = f"{P} long, {D} string, profile_start_time timestamp_ntz"
    profiles = spark.createDataFrame([(i, "d", at(x)) for i, x in enumerate(s)], schema)
    out = geo.interpolated_position(profiles, track, rows=rows)
    assert out.columns == [D, P, "profile_start_time", "latitude", "longitude", "position_source"]
    got = out.orderBy(P).collect()
    assert [g["latitude"] for g in got] == pytest.approx(np.interp(s, t, a)) and [g["longitude"] for g in got] == pytest.approx(np.interp(s, t, o))
    outside = spark.createDataFrame([(0, "d", at(-1)), (1, "d", at(90_001)), (2, "d", None)], schema)
    assert [g["latitude"] for g in geo.interpolated_position(outside, track, strict=False, rows=rows).collect()] == [None] * 3
    one = geo.interpolated_position(spark.createDataFrame([(0, "d", at(0)), (1, "d", at(1))], schema), track.limit(0).union(track.orderBy("time").limit(1)), strict=False, rows=rows)
    assert [g["latitude"] for g in one.orderBy(P).collect()] == [a[0], None]
    plan = geo.interpolated_position(profiles, track, strict=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and plan.count("Join") <= 2


def test_seawater_check_values(spark):
    # Published check values.
    rows = [(34.7118, 28.8099, 10.0, 28.7856, 34.5487), (34.7324, 4.3236, 1000.0, 4.4036, 34.56)]
    df = spark.createDataFrame(rows, "sa double, ct double, p double, t double, c double")
    sa, ct, p = F.col("sa"), F.col("ct"), F.col("p")
    df = df.withColumns({"rho": sw.rho(sa, ct, p), "sigma": sw.sigma0(sa, ct), "spice": sw.spiciness0(sa, ct), "z": sw.z_from_p(p, F.lit(4.0))})
    df = sw.with_sp_from_c(df, "sp", "c", "t", "p")
    a, b = df.orderBy("p").collect()
    assert a["rho"] == pytest.approx(1021.839935738108, abs=1e-9) and b["rho"] == pytest.approx(1032.002453224572, abs=1e-9)
    assert a["sigma"] == pytest.approx(21.797900819337656, abs=1e-9)
    assert a["spice"] == pytest.approx(5.728998558542941, abs=1e-9)
    assert a["z"] == pytest.approx(-9.9445834469453, abs=1e-9)
    assert a["sp"] == pytest.approx(20.009869599086951, abs=1e-9) and b["sp"] == pytest.approx(36.400308494388170, abs=1e-9)
    pt = spark.createDataFrame([(34.7118, 28.7832), (None, 3.0)], "sa double, pt double").select(sw.ct_from_pt(F.col("sa"), F.col("pt"))).collect()
    assert pt[0][0] == pytest.approx(28.809923015982083, abs=1e-9) and pt[1][0] is None


def test_derived_despike_feeds_the_next(spark):
    c = [42.0] * 10
    c[5] = 60.0
    rows = [("d", 0, i, v, 10.0 + i / 100, float(i), 45.0) for i, v in enumerate(c)]
    df = spark.createDataFrame(rows, f"{D} string, {P} long, {S} long, electrical_conductivity double, temperature double, sea_pressure double, latitude double")
    rule = Despiking(3, method="absolute_threshold", threshold=5.0)
    out, found, added = derived.derive(df, despiking={"practical_salinity": rule})
    got = out.orderBy(S).collect()
    assert got[5]["practical_salinity"] is None and got[5]["absolute_salinity"] is None and got[5]["density_anomaly"] is None
    assert got[4]["density_anomaly"] is not None and added[0] == "z" and set(found) == {"practical_salinity"}
    off, _, _ = derived.derive(df, {"practical_salinity": False})
    assert "practical_salinity" not in off.columns and "absolute_salinity" in off.columns
    with pytest.raises(ValueError, match="oxygen"):
        derived.derive(df, {"oxygen_concentration": True})


def test_concatenation(spark):
    t = lambda h: datetime(2020, 1, 1, h)
    prof = lambda d, times: spark.createDataFrame([(d, i, x) for i, x in enumerate(times)], f"{D} string, {P} long, time timestamp_ntz")
    rows = lambda d, n, c: spark.createDataFrame([(d, i, 0.5, 1.0) for i in range(n)], f"{D} string, {P} long, bin_center double, {c} double")
    p, r = concat.concatenate([(prof("a", [t(0), t(1)]), rows("a", 2, "x")), (prof("b", [t(1), t(2)]), rows("b", 2, "y"))])
    assert [(x[D], x["time"]) for x in p.collect()] == [("a", t(0)), ("a", t(1)), ("b", t(2))]
    assert r.count() == 3 and set(r.columns) >= {"x", "y"}
    with pytest.raises(ValueError):
        concat.union([])


def test_empty_log(spark):
    df = channel(spark, [])
    assert corrections.correct(df, {"x": corrections.Correction()}).count() == 0
    assert binning.bin_deployment(df, {"x": ("huber", {})}, "x").count() == 0
    assert despike(df, "x", Despiking())[0].count() == 0
    assert profiles.zigzag(df, "x").count() == 0


def test_infinite_values_stay_out_of_statistics(spark):
    df = channel(spark, [1, 2, math.inf, 3])
    assert binning.bin_edges(df, "x").first()["n_bins"] == 2
