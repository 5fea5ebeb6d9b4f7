"""Settings, names, lineage, files, pipeline and command line."""

import sqlite3
from datetime import UTC, datetime, timedelta, timezone
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from halocline import cli
from halocline.operators import corrections, tables
from halocline.operators.despike import spike_counts
from halocline.plans import config, pipeline
from halocline.plans.lineage import Lineage, attributes, parse_history
from halocline.sources import io, naming

POSITION = ["process.geolocation.reference_latitude=45.0", "process.geolocation.reference_longitude=-125.0"]
PATHS = ['paths.raw_directory="raw"', 'paths.profiles_directory="profiles"', 'paths.binned_directory="binned"']


def loaded(*more):
    return config.load(None, [*PATHS, *POSITION, *more])


def test_overrides():
    assert config.parse_override("a.b=[1, 2]") == {"a": {"b": [1, 2]}}
    with pytest.raises(ValueError):
        config.parse_override("a")
    with pytest.raises(ValueError):
        config.parse_override("a=nope")
    base = {"a": {"b": 1, "c": 2}}
    assert config.deep_merge(base, {"a": {"b": 3}}) == {"a": {"b": 3, "c": 2}} and base["a"]["b"] == 1


def test_precedence_and_eager_checks():
    s = loaded('instruments.7.process.atmospheric_pressure=1.0', 'deployments.x.process.atmospheric_pressure=2.0', 'instruments.7.process.raw_channels.t.shift=3')
    assert s.process_for("7").atmospheric_pressure == 1.0
    assert s.process_for("7", "x").atmospheric_pressure == 2.0
    assert s.process_for("7", "x").raw_channels["t"].shift == 3
    assert s.process_for("8").atmospheric_pressure is None
    with pytest.raises(ValueError) as e:
        loaded("deployments.x.process.nope=1")
    assert "deployments.x" in "".join(e.value.__notes__)


@pytest.mark.parametrize(
    "bad",
    [
        "process.despiking.reference_window_length=4", "process.despiking.fit_percentile=99.95", "process.despiking.min_exceedances=0", 'process.despiking.rejection_method="absolute_threshold"', "process.despiking.rejection_threshold=1.0",
        "process.ct_lag.window_length=2", "process.ct_lag.min_lag=30", "bin.step=0", "bin.huber.k=0", 'process.output_dtype="int32"', "process.nope=1", 'process.geolocation.external_dataset_path="x.parquet"',
    ],
)
def test_refused(bad):
    with pytest.raises(ValueError):
        loaded(bad)


def test_bin_sides_and_methods():
    with pytest.raises(ValueError):
        loaded("bin.first=1", "bin.last=0")
    assert loaded("bin.first=1", "bin.last=0", "bin.step=-1").bin.last == 0
    s = loaded('bin.channels.x.method="trimmed_mean"', "bin.channels.x.trimmed_mean.proportion_to_cut=0.1").bin
    assert s.resolved("x") == ("trimmed_mean", {"share": 0.1}) and s.resolved("y")[0] == "huber"


def test_times_are_naive_utc():
    s = loaded("process.start_time=2020-01-01T01:00:00+01:00")
    assert s.process.start_time == datetime(2020, 1, 1) and s.process.start_time.tzinfo is None
    assert datetime(2020, 1, 1, 1, tzinfo=timezone(timedelta(hours=1))).astimezone(UTC).hour == 0


def test_names():
    assert naming.channel_key("conductivity") == "electrical_conductivity"
    assert naming.channel_key("temperature_corrected") == "temperature_thermal_lag_corrected"
    assert naming.channel_key("dissolved_o2_saturation") == "dissolved_oxygen_saturation"
    assert naming.channel_key("sea water") == "sea_water"
    assert naming.channel_key("specific_conductivity") == "specific_conductivity_referenced_to_25_c"
    assert naming.channel_key("My Channel 1") == "my_channel_1" and naming.names("My Channel 1").standard_name is None
    assert naming.channel_keys(["salinity", "Practical salinity"]) == {"salinity": "practical_salinity", "Practical salinity": "Practical salinity"}


def test_lineage():
    line = Lineage(["a"])
    more = line.extended("b")
    assert line.dataset == ["a"] and more.dataset == ["a", "b"]
    assert attributes({"u": None, "n": np.float64(2.0), "t": datetime(2020, 1, 1)}, ["x", "y"]) == {"n": 2.0, "t": "2020-01-01T00:00:00", "history": "x; y"}
    assert parse_history("x; y") == ["x", "y"] and parse_history("") == []


def test_discovery(tmp_path):
    for n in ("b.PARQUET", "a.parquet", "c.txt"):
        (tmp_path / n).write_text("")
    assert [p.name for p in io.found_files(tmp_path, (".parquet",))] == ["a.parquet", "b.PARQUET"]
    assert [p.name for p in io.found_files(tmp_path, (".parquet",), ["b.PARQUET", "a.parquet"])] == ["b.PARQUET", "a.parquet"]
    for bad in ("../x.parquet", "c.txt", "none.parquet"):
        with pytest.raises(ValueError):
            io.found_files(tmp_path, (".parquet",), [bad])
    with pytest.raises(ValueError):
        io.found_deployments(tmp_path / "none")


def dive(spark, path, spikes=False):
    n = 666
    p = np.concatenate([np.linspace(0, 500, n // 2), np.linspace(500, 0, n // 2)])
    p = np.tile(p, 2)
    start = datetime(2021, 5, 1)
    rows = [(i, start + timedelta(seconds=i), float(35 + 0.001 * v + 0.0001 * (i % 7)), float(15 - 0.02 * v), float(v + 10.1325)) for i, v in enumerate(p)]
    df = spark.createDataFrame(rows, "sample_idx long, time timestamp_ntz, conductivity double, temperature double, pressure double")
    df.coalesce(1).write.parquet(str(path))


def test_process_bin_concatenate(spark, tmp_path, capsys):
    for name in ("one", "two"):
        dive(spark, tmp_path / "raw" / f"{name}.parquet")
    toml = tmp_path / "config.toml"
    toml.write_text(
        '[paths]\nraw_directory="raw"\nprofiles_directory="profiles"\nbinned_directory="binned"\nconcatenated_file="all"\n'
        "[process]\natmospheric_pressure=10.1325\n[process.geolocation]\nreference_latitude=45.0\nreference_longitude=-125.0\n"
        "[process.ct_lag]\nenabled=true\nmin_lag=-2\nmax_lag=2\n[process.channels.practical_salinity]\ndespike=true\n[bin]\nstep=-25.0\n"
    )
    (tmp_path / "raw/one.json").write_text('{"instrument_serial_number": 42, "instrument_model": "m"}')
    assert cli.main(["process", "--config", str(toml)]) == 0, capsys.readouterr()
    known = spark.read.parquet(str(tmp_path / "profiles/one/deployment")).first()
    assert known["instrument_serial_number"] == "42" and known["sampling_period_seconds"] == 1.0 and known["source_file"].endswith("one.parquet")
    samples, line = io.read_profiles(spark, str(tmp_path / "profiles/one/samples"))
    assert samples.select("profile_idx").distinct().count() == 2
    assert dict(samples.dtypes)["density_anomaly"] == "float" and line.metadata["density_anomaly"]["units"] == "kg m-3"
    assert any(x.startswith("computed derived variables: z, practical_salinity") for x in line.dataset)
    assert any("despiked" in x for x in line.channels["practical_salinity"])
    assert cli.main(["bin", "--config", str(toml)]) == 0, capsys.readouterr()
    profiles, rows = io.read_binned(spark, str(tmp_path / "binned/one"))
    assert profiles.count() == 2 and rows.where("temperature is not null").count() > 20
    assert io.wide(rows, "temperature").count() == 2
    assert cli.main(["concatenate", "--config", str(toml)]) == 0, capsys.readouterr()
    every, _ = io.read_binned(spark, str(tmp_path / "all"))
    assert every.count() == 2  # both files have the same times
    assert cli.main(["process", "--config", str(toml), "--target", "none.parquet"]) == 1


def test_every_deployment_is_tried_and_failures_are_rows(spark, tmp_path, capsys):
    dive(spark, tmp_path / "raw" / "good.parquet")
    for name in ("bad", "worse"):
        spark.range(5).selectExpr("id as sample_idx", "timestamp_ntz'2021-05-01' as time", "1d as temperature").write.parquet(str(tmp_path / "raw" / f"{name}.parquet"))
    toml = tmp_path / "config.toml"
    toml.write_text(
        '[paths]\nraw_directory="raw"\nprofiles_directory="profiles"\nbinned_directory="binned"\n'
        "[process]\natmospheric_pressure=10.1325\n[process.geolocation]\nreference_latitude=45.0\nreference_longitude=-125.0\n"
    )
    assert cli.main(["process", "--config", str(toml)]) == 1
    said = capsys.readouterr().err
    errors = {r["deployment_id"]: r["error"] for r in io.read_errors(spark, str(tmp_path / "profiles")).collect()}
    assert set(errors) == {"bad", "worse"} and all(f"{k}: {v}" in said and "absolute_pressure" in v for k, v in errors.items())
    assert [p.name for p in io.found_deployments(tmp_path / "profiles")] == ["good"]
    samples, line = io.read_profiles(spark, str(tmp_path / "profiles/good/samples"))
    assert samples.count() > 600 and any(x.startswith("removed") for x in line.channels["temperature"])
    assert cli.main(["process", "--config", str(toml), "--target", "good.parquet"]) == 0
    assert io.read_errors(spark, str(tmp_path / "profiles")).count() == 0


def test_concatenation_keeps_one_copy_and_agreed_attributes(spark, caplog):
    from halocline.operators import concat

    p = spark.createDataFrame([("a", 0, datetime(2021, 1, 1)), ("a", 1, datetime(2021, 1, 2))], "deployment_id string, profile_idx int, time timestamp_ntz")
    r = spark.createDataFrame([("a", i, float(z), 1.0) for i in (0, 1) for z in (1, 2)], "deployment_id string, profile_idx int, bin_center double, v double")
    with caplog.at_level("WARNING", logger="halocline"):
        profiles, rows, about = pipeline.concatenate([(p, r), (p, r)], [{"project": "x", "source": "a"}, {"project": "x", "source": "b", "only": 1}])
    assert (profiles.count(), rows.count()) == (2, 4) and about == {"project": "x", "only": 1}
    assert any("2 profile(s)" in m for m in caplog.messages) and any("source" in m for m in caplog.messages)
    assert concat.duplicates([p]) == 0 and concat.agreed([]) == ({}, [])


def test_init(tmp_path):
    path = cli.init(tmp_path / "p", "name")
    assert path.is_file() and (tmp_path / "p/raw").is_dir() and "0.0" in path.read_text()
    with pytest.raises(FileExistsError):
        cli.init(tmp_path / "p", "name")
    cli.init(tmp_path / "p", "name", force=True)


def test_sqlite_logs(spark, tmp_path):
    path = tmp_path / "x.rsk"
    with sqlite3.connect(path) as con:
        con.execute("create table channels (channelID integer, longName text)")
        con.executemany("insert into channels values (?, ?)", [(1, "conductivity"), (2, "temperature")])
        con.execute("create table data (tstamp integer, channel01 real, channel02 real)")
        con.executemany("insert into data values (?, ?, ?)", [(1000, 35.0, 10.0), (2000, 35.1, None)])
    df = io.read_sqlite_logs(spark, [str(path)], ["conductivity", "temperature"]).orderBy("sample_idx")
    got = df.collect()
    assert [r["electrical_conductivity"] for r in got] == [35.0, 35.1] and got[1]["temperature"] is None
    assert got[0]["time"] == datetime(1970, 1, 1, 0, 0, 1)


def test_streamed_arrivals(spark, tmp_path):
    from halocline.streaming.ingest import process_arrivals

    seen = []
    spark.range(3).write.parquet(str(tmp_path / "in"))
    q = process_arrivals(spark, str(tmp_path / "in"), "id long", lambda df, n: seen.append(df.count()), str(tmp_path / "state"))
    q.awaitTermination(60)
    assert seen == [3]


def test_profile_key(spark):
    df = spark.createDataFrame([("dep", 7)], "deployment_id string, profile_idx long")
    assert io.profile_key(df).first()["profile_key"] == "dep_p0007"
    assert df.select(naming.slug_column(F.lit("  A (b) C ")).alias("s")).first()["s"] == "a_b_c"
    assert Path("x").suffix == "" and pipeline.VERBOSE == 15


@pytest.mark.parametrize("rows", [100, 1 << 20])
def test_history_counts_what_was_removed(spark, tmp_path, rows):
    n = 666
    p = np.tile(np.concatenate([np.linspace(0, 500, n // 2), np.linspace(500, 0, n // 2)]), 2)
    start = datetime(2021, 5, 1)
    t = [15 - 0.02 * v for v in p]
    for i in (200, 201, 900):
        t[i] = t[199]  # one differs from the value before it, one does not
    t[198] = t[199] = 1.0
    t[500] += 3.0
    held = sum(a == b for a, b in zip(t, t[1:]))
    data = [("d", i, start + timedelta(seconds=i), float(35 + 0.0001 * (i % 7)), float(t[i]), float(v + 10)) for i, v in enumerate(p)]
    df = spark.createDataFrame(data, "deployment_id string, sample_idx long, time timestamp_ntz, electrical_conductivity double, temperature double, absolute_pressure double")
    settings = loaded(
        "process.atmospheric_pressure=10.0", "process.channels.temperature.despike=true", 'process.channels.temperature.despiking.rejection_method="absolute_threshold"', "process.channels.temperature.despiking.rejection_threshold=1.5",
        "process.raw_channels.electrical_conductivity.remove_holds=false",
    ).process_for("1", "d")
    done = pipeline.process(df, settings, rows=rows)
    found = done.lineage.channels
    before = corrections.correct(df, settings.corrections(["temperature"]))
    spikes = spike_counts(before, "temperature", settings.despiked()["temperature"]).first()["spikes"]
    assert spikes >= 1 and found["temperature"][:2] == [f"removed {held} held value(s)", f"removed {spikes} spike(s)"]
    assert not any("held" in x for x in found.get("electrical_conductivity", []))
    assert found["absolute_pressure"] == ["removed 3 held value(s)"]  # the three turns
    empty = pipeline.process(df.limit(0), settings, rows=rows).lineage.channels
    assert empty["temperature"][:2] == ["removed 0 held value(s)", "removed 0 spike(s)"]


def test_nothing_is_counted_without_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(tables, "shared_folder", lambda _: None)
    df = spark.range(3)
    tally = tables.Tally(spark)
    assert tally.watch(df, "x", {"a": F.col("id") > 0}) is df and tally.found("x") == {}
