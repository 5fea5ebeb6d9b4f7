"""Logs cut into slices, exact quantiles and tail fits against one-task kernels."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from halocline.functions import gpd
from halocline.functions.quantiles import quantiles
from halocline.operators import corrections, ctlag
from halocline.operators.despike import Despiking, despike, residuals
from halocline.operators.model import KEYS
from halocline.operators.tables import stores
from halocline.operators.slices import PLACE, SLICE, in_slices, placed, sliced


@pytest.fixture(scope="module")
def long_log(spark):
    """One deployment with nearly all samples, one of few, and one of a single sample; numbers of samples are missing here and there."""
    r = np.random.default_rng(11)
    rows = [("long", int(i), None if i % 53 == 0 else float(np.round(v, 1)), float(i // 3 % 7)) for i, v in enumerate(r.normal(size=4000)) if i % 29]
    rows += [("few", 5 * i, float(i % 4), 1.0) for i in range(20)] + [("one", 7, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "deployment_id string, sample_idx long, value double, held double").repartition(5)
    return df.persist()


def rows_of(df, *columns):
    return sorted(map(repr, df.select(*columns).collect()))


def test_places_are_those_of_a_window(long_log):
    want = long_log.select("deployment_id", "sample_idx", (F.row_number().over(KEYS.log()) - 1).cast("long").alias(PLACE))
    for rows in (1, 16, 250, 100_000):
        assert rows_of(placed(long_log, rows), "deployment_id", "sample_idx", PLACE) == rows_of(want, "deployment_id", "sample_idx", PLACE)


@pytest.mark.parametrize("rows", [3, 250, 100_000])
def test_corrections_and_medians_are_equal_in_any_slices(long_log, rows):
    plan = {"value": corrections.Correction(True, 4, 1.5), "held": corrections.Correction(True, -9)}
    whole = corrections.correct(long_log, plan)
    assert rows_of(corrections.correct(long_log, plan, rows=rows), *whole.columns) == rows_of(whole, *whole.columns)
    s = Despiking(31)
    one = residuals(long_log, "value", s, KEYS.log())
    cut = in_slices(long_log, 15, lambda part, k: residuals(part, "value", s, k.log()), rows)
    assert cut.columns == one.columns and rows_of(cut, *one.columns) == rows_of(one, *one.columns)


def test_lags_are_equal_in_any_slices(spark, long_log):
    lags = spark.createDataFrame([("long", 5), ("few", -3), ("one", None)], "deployment_id string, lag int")
    whole = ctlag.apply_lags(long_log, lags, "value")
    want = {r["sample_idx"]: r["value"] for r in long_log.where("deployment_id = 'few'").collect()}
    got = {r["sample_idx"]: r["value"] for r in whole.where("deployment_id = 'few'").collect()}
    assert got == {i: want.get(i + 15) for i in want}
    assert rows_of(ctlag.apply_lags(long_log, lags, "value", rows=100), *whole.columns) == rows_of(whole, *whole.columns)
    assert whole.columns == long_log.columns and whole.where("deployment_id = 'one' and value = 1.0").count() == 1
    assert ctlag.apply_lags(long_log, lags.where("lag is null"), "value") is long_log


def test_sixteen_slices_are_even_work(spark, long_log):
    """The longest task has at most twice the rows of the median one, and windows take no exchange of their own."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        long = placed(long_log.where("deployment_id = 'long'"), 250)
        cut = sliced(long, 15, 250)
        sizes = sorted(r["count"] for r in cut.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) > 1 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
        assert cut.where("_own").count() == long.count() and cut.where("_own").select(SLICE).distinct().count() == 16
        plan = in_slices(long, 15, lambda part, k: residuals(part, "value", Despiking(31), k.log()), 250)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange rangepartitioning") == 1 and "_slice" not in "".join(x for x in plan.split("\n") if "Exchange hashpartitioning" in x)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_despiking_in_slices(long_log):
    for s in (Despiking(11, 90.0, 99.5, 20), Despiking(11, method="absolute_threshold", threshold=2.0)):
        whole, a = despike(long_log, "value", s)
        cut, b = despike(long_log, "value", s, rows=100)
        assert rows_of(whole, *whole.columns) == rows_of(cut, *whole.columns)
        near = lambda t: [tuple(f"{v:.9g}" if isinstance(v, float) else v for v in r) for r in t.orderBy("deployment_id").collect()]
        assert near(a) == near(b)


def test_no_group_meets_in_one_task(long_log):
    for df in (quantiles(long_log, "deployment_id", "value", {"a": 0.9}), gpd.fits(long_log.where("value > 0"), "deployment_id", "value", rounds=2)):
        plan = df._jdf.queryExecution().analyzed().toString()
        assert "percentile(" not in plan and "FlatMapGroups" not in plan and "collect_list(_x" not in plan


def test_tail_fits_sort_no_rows_and_send_none(spark, long_log, tmp_path):
    """Rows small enough to be broadcast stay where they are: what is broadcast is a row a group, and only sums are kept."""
    long_log.where("value > 0").write.parquet(str(tmp_path / "x"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = gpd.fits(spark.read.parquet(str(tmp_path / "x")), "deployment_id", "value", rounds=3)._jdf.queryExecution().executedPlan().toString()
        joins = [x for x in plan.split("\n") if "HashJoin" in x or "MergeJoin" in x]
        assert len(joins) == 3 and all("BuildRight" in x for x in joins)
        assert "Sort" not in plan.replace("array_sort", "")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


SAMPLES = st.lists(st.one_of(st.floats(allow_nan=True, allow_infinity=True), st.sampled_from([0.0, -0.0, 1.0, 1.5, -2.0, 1e-300, 5e-324, None])), max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(SAMPLES, min_size=1, max_size=3))
def test_quantiles_match_numpy(spark, groups):
    wanted = {"a": 0.0, "b": 0.37, "c": 0.5, "d": 1.0}
    names = [None, "a", "b"]
    df = spark.createDataFrame([(names[i], v) for i, g in enumerate(groups) for v in [*g, None]], "g string, v double")
    got = {r["g"]: r for r in quantiles(df, "g", "v", wanted, stores(spark)).collect()}
    for i, g in enumerate(groups):
        x = sorted(v for v in g if v is not None and math.isfinite(v))
        r = got[names[i]]
        assert r["n"] == len(x)
        for name, q in wanted.items():
            if not x:
                assert r[name] is None
                continue
            place = q * (len(x) - 1)
            low, high = x[int(place)], x[min(int(place) + 1, len(x) - 1)]
            part = place - int(place)
            assert r[name] == pytest.approx(low if low == high else (1 - part) * low + part * high, rel=1e-12)


def test_quantiles_of_ties_and_many_values(spark):
    r = np.random.default_rng(2)
    x = np.concatenate([np.zeros(20_000), r.lognormal(0, 3, 20_000), -r.exponential(1e-6, 5000), np.full(3000, 7.25)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double").withColumn("g", F.lit(1))
    got = quantiles(df, "g", "v", {f"q{i}": q for i, q in enumerate((0.001, 0.1, 0.5, 0.9, 0.9999))}).first()
    assert got["n"] == len(x)
    for i, q in enumerate((0.001, 0.1, 0.5, 0.9, 0.9999)):
        assert got[f"q{i}"] == pytest.approx(float(np.quantile(x, q)), rel=1e-12)


def test_tail_fits_match_the_fit_of_one_group(spark):
    r = np.random.default_rng(4)
    u = r.uniform(size=3000)
    groups = {"heavy": 2.0 * (u[:1000] ** -0.3 - 1) / 0.3, "light": r.exponential(5.0, 1500), "bounded": 3.0 * (1 - u[1000:2000] ** 0.4) / 0.4, "two": np.array([1.0, 2.0])}
    df = spark.createDataFrame([(k, float(v)) for k, x in groups.items() for v in x], "g string, x double")
    got = {r["g"]: r for r in gpd.fits(df, "g", "x").collect()}
    assert set(got) == set(groups)
    for k, x in groups.items():
        shape, scale = gpd.fit(np.sort(x))
        assert got[k]["shape"] == pytest.approx(shape, abs=1e-4) and got[k]["scale"] == pytest.approx(scale, rel=1e-4)
    assert gpd.fits(df.where("false"), "g", "x").collect() == []
