"""netCDF and Zarr: bytes, files, and the stages through them."""

import struct
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from halocline import cli
from halocline.plans.lineage import Lineage
from halocline.sources import grids, io, netcdf, zarr

KINDS = ["i1", "i2", "i4", "f4", "f8"]


@settings(max_examples=40, deadline=None)
@given(st.sampled_from(KINDS), st.lists(st.integers(0, 5), min_size=0, max_size=3), st.text(max_size=5))
def test_netcdf_round_trip(kind, shape, text):
    x = np.arange(int(np.prod(shape))).reshape(shape).astype(kind)
    data = netcdf.encode({"x": (tuple(f"d{i}" for i in range(len(shape))), x, {"units": text, "n": 3, "f": 1.5})}, {"history": text, "list": [1, 2]})
    found, about = netcdf.decode(data)
    over, y, own = found["x"]
    assert (y == x).all() and y.dtype == x.dtype and y.shape == x.shape and own == {"units": text, "n": 3, "f": 1.5} and about == {"history": text, "list": [1, 2]}
    assert over == tuple(f"d{i}" for i in range(len(shape)))


def test_netcdf_text_times_and_layout():
    t = np.array(["2021-05-01T00:00:00.123456", "NaT"], "datetime64[us]")
    data = netcdf.encode({"t": (("n",), t, {}), "s": (("n",), np.array(["é", ""], object), {}), "big": (("n",), np.array([1, 2**40]), {})}, {})
    assert data[:4] == b"CDF\x02" and struct.unpack(">i", data[4:8]) == (0,) and len(data) % 4 == 0
    found, _ = netcdf.decode(data)
    assert found["s"][1].tolist() == ["é", ""] and found["big"][1].tolist() == [1.0, 2.0**40]
    assert found["t"][1][0] == t[0].astype(np.int64) and np.isnan(found["t"][1][1])
    with pytest.raises(ValueError):
        netcdf.decode(b"\x89HDF....")
    with pytest.raises(ValueError):
        netcdf.encode({"a": (("n",), np.zeros(2), {}), "b": (("n",), np.zeros(3), {})}, {})


@pytest.mark.parametrize("codec", [None, "zstd", "zlib", "lz4"])
@pytest.mark.parametrize("shuffle", [False, True])
def test_zarr_chunks(codec, shuffle):
    of = zarr.layout((5, 3), (4, 3), "<f4", codec, 3, shuffle)
    x = np.random.default_rng(0).normal(size=(1, 3)).astype("f4")
    y = zarr.decode(zarr.encode(x, of), of)
    assert (y[:1] == x).all() and np.isnan(y[1:]).all() and y.shape == (4, 3)
    assert of["compressor"] == (None if codec is None else {"id": "zlib" if codec == "zlib" else "zstd", "level": 3})


@pytest.fixture
def grid(spark):
    start = datetime(2021, 5, 1)
    p = spark.createDataFrame([("b", 0, start + timedelta(hours=3), 45.0, -125.0), ("a", 0, start, 44.0, None), ("a", 1, start + timedelta(microseconds=1500), 44.5, -124.0)], "deployment_id string, profile_idx long, time timestamp_ntz, latitude double, longitude double")
    r = spark.createDataFrame([("a", 0, -1.5, 10.0, 35.0), ("a", 0, -0.5, 11.0, None), ("a", 1, -0.5, 12.0, 33.0), ("b", 0, -2.5, 13.0, 34.0)], "deployment_id string, profile_idx long, bin_center double, temperature double, salinity double")
    return p, r


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.mark.parametrize("kind", ["nc", "zarr"])
def test_binned_round_trip(spark, grid, tmp_path, kind):
    p, r = grid
    path = str(tmp_path / f"all.{kind}")
    if kind == "nc":
        grids.write_binned_netcdf(p, r, path, {"project": "x", "n": 3})
        back = grids.read_binned_netcdf(spark, path)
    else:
        grids.write_binned_zarr(p, r, path, {"project": "x", "n": 3}, chunk=2)
        back = grids.read_binned_zarr(spark, path)
        assert sorted(x.name for x in (tmp_path / "all.zarr/temperature").iterdir() if not x.name.startswith(".")) == ["0.0", "1.0"]
    assert rows(back[0]) == rows(p) and rows(back[1]) == rows(r) and back[2] == {"project": "x", "n": 3}


@pytest.mark.parametrize("kind", ["nc", "zarr"])
def test_empty_grid(spark, grid, tmp_path, kind):
    p, r = grid
    path = str(tmp_path / f"none.{kind}")
    if kind == "zarr":
        grids.write_binned_zarr(p.limit(0), r.limit(0), path)
        back = grids.read_binned_zarr(spark, path)
        assert back[0].count() == 0 and back[1].count() == 0


def test_profile_files_round_trip(spark, tmp_path):
    start = datetime(2021, 5, 1)
    df = spark.createDataFrame([("d", k, i, start + timedelta(seconds=i), None if i == 2 else 10.0 + i, 35.0) for k in (0, 1) for i in range(5)], "deployment_id string, profile_idx long, sample_idx long, time timestamp_ntz, temperature double, salinity double")
    line = Lineage(["read from x"], {"temperature": ["shifted", "despiked"]}, {"temperature": {"units": "degree_C"}})
    paths = [r["path"] for r in grids.write_profiles_netcdf(df, str(tmp_path), line, {"temperature": "float", "salinity": "double"}).collect()]
    assert sorted(p.rsplit("/", 1)[1] for p in paths) == ["d_p0000.nc", "d_p0001.nc"]
    back, told = grids.read_profiles_netcdf(spark, str(tmp_path))
    assert dict(back.dtypes)["temperature"] == "float" and dict(back.dtypes)["salinity"] == "double"
    assert rows(back.select(df.columns)) == rows(df) and told.dataset == ["read from x"] and told.channels["temperature"] == ["shifted", "despiked"] and told.metadata["temperature"] == {"units": "degree_C"}
    one, _ = grids.read_profiles_netcdf(spark, paths[:1])
    assert one.count() == 5
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError):
        grids.read_profiles_netcdf(spark, str(tmp_path / "none"))


def test_track_and_split_pages(spark, tmp_path):
    hours = np.array([0.0, 1.0, 2.0])
    (tmp_path / "track.nc").write_bytes(netcdf.encode({"time": (("time",), hours, {"units": "hours since 2021-05-01 00:00:00"}), "lat": (("time",), hours * 10, {}), "name": (("one",), np.array(["x"], object), {})}, {}))
    track = io.load(spark, str(tmp_path / "track.nc"))
    assert [tuple(r) for r in track.orderBy("time").collect()] == [(datetime(2021, 5, 1, h), 10.0 * h) for h in range(3)]
    t = pa.table({"a": np.arange(1000) / 7, "b": np.arange(1000)})
    pq.write_table(t, tmp_path / "split.parquet", use_dictionary=False, use_byte_stream_split=["a"], compression="zstd")
    pq.write_table(t, tmp_path / "plain.parquet")
    for name in ("split", "plain"):
        got = io.load(spark, str(tmp_path / f"{name}.parquet"))
        assert got.count() == 1000 and got.where("b = 7").first()["a"] == 1.0
    # A folder of both, the split pages in the larger file.
    (tmp_path / "both dir").mkdir()
    pq.write_table(t.slice(0, 10), tmp_path / "both dir" / "a b.parquet")
    pq.write_table(t.slice(10), tmp_path / "both dir" / "c.parquet", use_dictionary=False, use_byte_stream_split=["a"])
    both = io.load(spark, str(tmp_path / "both dir"))
    assert both.count() == 1000 and sorted(r["a"] for r in both.collect()) == t["a"].to_pylist()
    with pytest.raises(ValueError):
        io.load(spark, "x.csv")


@pytest.mark.parametrize("kind,suffix", [("netcdf", ".nc"), ("zarr", ".zarr")])
def test_stages_through_formats(spark, tmp_path, capsys, kind, suffix):
    n, start = 333, datetime(2021, 5, 1)
    p = np.tile(np.concatenate([np.linspace(0, 500, n), np.linspace(500, 0, n)]), 2)
    for k, name in enumerate(("one", "two")):
        made = [(i, start + timedelta(days=k, seconds=i), float(35 + 0.001 * v), float(15 - 0.02 * v), float(v + 10.1325)) for i, v in enumerate(p)]
        spark.createDataFrame(made, "sample_idx long, time timestamp_ntz, conductivity double, temperature double, pressure double").coalesce(1).write.parquet(str(tmp_path / f"raw/{name}.parquet"))
    toml = tmp_path / "config.toml"
    toml.write_text(
        f'[paths]\nraw_directory="raw"\nprofiles_directory="profiles"\nbinned_directory="binned"\nconcatenated_file="all{suffix}"\n[process]\natmospheric_pressure=10.1325\nprofile_format="netcdf"\n'
        f'[process.geolocation]\nreference_latitude=45.0\nreference_longitude=-125.0\n[bin]\nstep=-25.0\noutput_format="{kind}"\n'
    )
    for stage in ("process", "bin", "concatenate"):
        assert cli.main([stage, "--config", str(toml)]) == 0, capsys.readouterr()
    assert len(list((tmp_path / "profiles/one/netcdf").glob("*.nc"))) == 2 and (tmp_path / f"binned/two{suffix}").exists()
    profiles, grid_rows, about = grids.read_binned_netcdf(spark, str(tmp_path / "all.nc")) if kind == "netcdf" else grids.read_binned_zarr(spark, str(tmp_path / "all.zarr"))
    assert profiles.count() == 4 and grid_rows.where("temperature is not null").count() > 40 and about["sampling_period_seconds"] == 1.0
