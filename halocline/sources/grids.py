"""Exchange formats: profiles as netCDF files, gridded datasets as netCDF files or Zarr stores.

Tasks write through pyarrow's file systems, so a path is one that driver and executors both reach, a local one or a URI. A
file is written aside and moved, so a task that runs twice leaves one whole file.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping
from datetime import datetime
from typing import Any

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.model import KEYS, Keys, floating, nan_to_null
from ..plans.lineage import Lineage, attributes, parse_history
from . import netcdf, zarr

TIMES = {"units": "microseconds since 1970-01-01 00:00:00", "calendar": "standard", "standard_name": "time"}


def put(path: str, data: bytes) -> None:
    """Writes a file whole."""
    store, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    store.create_dir(name.rsplit("/", 1)[0], recursive=True)
    aside = f"{name}.{np.random.default_rng().integers(1 << 62):x}.part"
    with store.open_output_stream(aside) as out:
        out.write(data)
    store.move(aside, name)


def get(path: str) -> bytes:
    store, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    with store.open_input_stream(name) as f:
        return f.read()


def _times(x: pd.Series) -> np.ndarray:
    x = pd.to_datetime(x)
    return (x.dt.tz_localize(None) if x.dt.tz is not None else x).to_numpy().astype("datetime64[us]")


def _micros(x: np.ndarray) -> np.ndarray:
    return np.where(np.isnan(x), np.datetime64("NaT"), np.nan_to_num(x).astype(np.int64).astype("datetime64[us]"))


def write_profiles_netcdf(df: DataFrame, path: str, lineage: Lineage, types: Mapping[str, str], keys: Keys = KEYS) -> DataFrame:
    """One file for each profile, <deployment>_p<index>.nc: the time, and each floating channel in its output type with its attributes and history; the paths.

    A missing value is NaN. The classic format holds no compression.
    """
    channels = floating(df)
    about = {c: attributes(lineage.metadata.get(c, {}), lineage.channels.get(c, [])) for c in channels}
    whole = attributes({}, lineage.dataset)
    kinds = {c: np.float32 if types.get(c) == "float" else np.float64 for c in channels}
    dep, profile, order = keys.deployment, keys.profile, keys.order

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        d, p = str(pdf[dep].iloc[0]), int(pdf[profile].iloc[0])
        variables = {"time": (("time",), _times(pdf["time"]), TIMES | {"axis": "T"}), order: (("time",), pdf[order].to_numpy(), {})}
        variables |= {c: (("time",), pdf[c].to_numpy(kinds[c]), about[c]) for c in channels}
        name = f"{path.rstrip('/')}/{d}_p{p:04d}.nc"
        put(name, netcdf.encode(variables, whole | {dep: d, profile: p}))
        return pd.DataFrame({"path": [name]})

    return df.select(dep, profile, order, "time", *channels).groupBy(dep, profile).applyInPandas(write, "path string")


def read_profiles_netcdf(spark: SparkSession, path: str | list[str], keys: Keys = KEYS) -> tuple[DataFrame, Lineage]:
    """Samples of all netCDF profiles of a folder, or of the files named; NaN becomes NULL. Channels, attributes and history are those of the first file by name."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.nc")
    files = reader.load(path)
    first = files.orderBy("path").select("content").first()
    if first is None:
        raise ValueError(f"no netCDF files in {path}.")
    variables, about = netcdf.decode(bytes(first["content"]))
    line = Lineage(parse_history(about.get("history")))
    for name, (_, _, own) in variables.items():
        line.metadata[name] = {k: v for k, v in own.items() if k != "history"}
        if "history" in own:
            line.channels[name] = parse_history(own["history"])
    channels = {n: "float" if x.dtype.itemsize == 4 else "double" for n, (_, x, _) in variables.items() if x.dtype.kind == "f" and n not in ("time", keys.order)}
    schema = f"`{keys.deployment}` string, `{keys.profile}` long, `{keys.order}` long, time timestamp_ntz, " + ", ".join(f"`{n}` {k}" for n, k in channels.items())
    names = [keys.deployment, keys.profile, keys.order, "time", *channels]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                found, of = netcdf.decode(content)
                n = len(found["time"][1])
                out = {keys.deployment: str(of[keys.deployment]), keys.profile: int(of[keys.profile]), "time": _micros(found["time"][1])}
                out[keys.order] = found[keys.order][1].astype(np.int64) if keys.order in found else np.arange(n)
                out |= {c: found[c][1] if c in found else np.full(n, np.nan) for c in channels}
                yield pd.DataFrame(out, index=range(n))[names]

    return nan_to_null(files.select("content").mapInPandas(parse, schema), channels), line


def _grid(profiles: DataFrame, rows: DataFrame, keys: Keys) -> tuple[DataFrame, list[float], list[str]]:
    """Rows with the place of their profile by time; the bin centres, ascending; the channels."""
    centres = sorted(r[0] for r in rows.select("bin_center").distinct().limit(1_000_001).collect())
    if len(centres) > 1_000_000:
        raise ValueError("more than a million bin centres: no dense grid of them is written.")
    placed = profiles.withColumn("_place", F.row_number().over(Window.orderBy("time", keys.deployment, keys.profile)) - 1)
    channels = [c for c in floating(rows) if c != "bin_center"]
    return placed, centres, channels


def _dense(pdf: pd.DataFrame, first: int, n: int, centres: np.ndarray, channel: str) -> np.ndarray:
    out = np.full((n, len(centres)), np.nan)
    at = pdf["bin_center"].notna().to_numpy()
    out[pdf["_place"].to_numpy()[at] - first, np.searchsorted(centres, pdf["bin_center"].to_numpy()[at])] = pdf[channel].to_numpy(float)[at]
    return out


PLACES = ("latitude", "longitude")


def write_binned_netcdf(profiles: DataFrame, rows: DataFrame, path: str, attrs: Mapping[str, Any] | None = None, vertical: str = "z", types: Mapping[str, str] | None = None, keys: Keys = KEYS) -> None:
    """One dataset as one file on (profile, vertical), written by one task: an export of what one machine can hold."""
    placed, centres, channels = _grid(profiles, rows, keys)
    grid, whole, wide = np.array(centres), dict(attrs or {}), {c: (types or {}).get(c, "double") for c in channels}
    own = [c for c in PLACES if c in profiles.columns]
    both = placed.select(keys.deployment, keys.profile, "_place", "time", *own).join(rows.select(keys.deployment, keys.profile, "bin_center", *channels), [keys.deployment, keys.profile], "left")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["_place"].max()) + 1
        one = pdf.drop_duplicates("_place").sort_values("_place")
        variables = {vertical: ((vertical,), grid, {}), "time": (("profile",), _times(one["time"]), TIMES), keys.deployment: (("profile",), one[keys.deployment].astype(str).to_numpy(object), {}), keys.profile: (("profile",), one[keys.profile].to_numpy(), {})}
        variables |= {c: (("profile",), one[c].to_numpy(float), {}) for c in own}
        variables |= {c: (("profile", vertical), _dense(pdf, 0, n, grid, c).astype("f4" if wide[c] == "float" else "f8"), {}) for c in channels if c != vertical}
        put(path, netcdf.encode(variables, whole))
        return pd.DataFrame({"path": [path]})

    both.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(write, "path string").collect()


def _long(variables: Mapping[str, netcdf.Variable], vertical: str, keys: Keys, first: int = 0) -> pd.DataFrame:
    """(deployment, profile, bin_center, channels) of arrays on (profile, vertical); rows without any value are left out."""
    grid = variables[vertical][1]
    channels = [n for n, (over, _, _) in variables.items() if over == ("profile", vertical)]
    n = len(variables[keys.profile][1])
    out = {keys.deployment: np.repeat(variables[keys.deployment][1], len(grid)), keys.profile: np.repeat(np.asarray(variables[keys.profile][1]).astype(np.int64), len(grid)), "bin_center": np.tile(grid, n)}
    out |= {c: np.asarray(variables[c][1], float).ravel() for c in channels}
    frame = pd.DataFrame(out)
    return frame[frame[channels].notna().any(axis=1)] if channels else frame


def read_binned_netcdf(spark: SparkSession, path: str, vertical: str = "z", keys: Keys = KEYS) -> tuple[DataFrame, DataFrame, dict[str, Any]]:
    """(profiles, rows, attributes) of a file that write_binned_netcdf wrote."""
    content = spark.read.format("binaryFile").load(path).select("content").first()
    variables, about = netcdf.decode(bytes(content["content"]))
    profiles = _profiles(spark, {n: x for n, (over, x, _) in variables.items() if over == ("profile",)}, keys)
    return profiles, _frame(spark, _long(variables, vertical, keys), keys), about


def _profiles(spark: SparkSession, of: Mapping[str, np.ndarray], keys: Keys) -> DataFrame:
    places = [c for c in PLACES if c in of]
    time = [None if np.isnan(t) else datetime(1970, 1, 1) + pd.Timedelta(microseconds=int(t)).to_pytimedelta() for t in of["time"]]
    rows = [(str(d), int(p), t, *(None if np.isnan(of[c][i]) else float(of[c][i]) for c in places)) for i, (d, p, t) in enumerate(zip(of[keys.deployment], of[keys.profile], time, strict=True))]
    return spark.createDataFrame(rows, f"`{keys.deployment}` string, `{keys.profile}` long, time timestamp_ntz" + "".join(f", {c} double" for c in places))


def _schema(channels: list[str], keys: Keys) -> str:
    return f"`{keys.deployment}` string, `{keys.profile}` long, bin_center double" + "".join(f", `{c}` double" for c in channels)


def _frame(spark: SparkSession, long: pd.DataFrame, keys: Keys) -> DataFrame:
    channels = [c for c in long.columns if c not in (keys.deployment, keys.profile, "bin_center")]
    df = spark.createDataFrame(list(long.itertuples(index=False, name=None)), _schema(channels, keys))
    return nan_to_null(df, channels)


def write_binned_zarr(
    profiles: DataFrame, rows: DataFrame, path: str, attrs: Mapping[str, Any] | None = None, vertical: str = "z", codec: str | None = "zstd", level: int = 5, shuffle: bool = False, chunk: int = 256, types: Mapping[str, str] | None = None, keys: Keys = KEYS
) -> None:
    """A dataset on (profile, vertical) as a Zarr store; `chunk` profiles make a chunk, which one task writes, so any number of profiles will do."""
    placed, centres, channels = _grid(profiles, rows, keys)
    channels = [c for c in channels if c != vertical]
    n, grid = profiles.count(), np.array(centres, float)
    kind = lambda c: "<f4" if (types or {}).get(c) == "float" else "<f8"
    own = [c for c in PLACES if c in profiles.columns]
    longest = profiles.agg(F.max(F.octet_length(F.col(keys.deployment).cast("string")))).first()[0] or 1
    plain = {keys.deployment: f"S{longest}", keys.profile: "<i8", **{c: "<f8" for c in own}}
    meta: dict[str, Any] = {".zgroup": {"zarr_format": 2}, ".zattrs": dict(attrs or {})}

    def array(name: str, of: dict, over: list[str], **about) -> None:
        meta[f"{name}/.zarray"], meta[f"{name}/.zattrs"] = of, {"_ARRAY_DIMENSIONS": over, **about}

    array(vertical, zarr.layout((len(grid),), (len(grid),), "<f8", None), [vertical])
    array("time", zarr.layout((n,), (chunk,), "<i8", None), ["profile"], **TIMES)
    for name, k in plain.items():
        array(name, zarr.layout((n,), (chunk,), k, None), ["profile"])
    for c in channels:
        array(c, zarr.layout((n, len(grid)), (chunk, len(grid)), kind(c), codec, level, shuffle), ["profile", vertical])
    both = placed.select(keys.deployment, keys.profile, "_place", "time", *own).join(rows.select(keys.deployment, keys.profile, "bin_center", *channels), [keys.deployment, keys.profile], "left")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["_place"].iloc[0]) // chunk
        one = pdf.drop_duplicates("_place").sort_values("_place")
        values = {"time": _times(one["time"]).astype(np.int64), keys.deployment: one[keys.deployment].astype(str).str.encode("utf-8").to_numpy("S"), keys.profile: one[keys.profile].to_numpy(), **{c: one[c].to_numpy(float) for c in own}}
        for name, x in values.items():
            put(f"{path}/{name}/{zarr.chunk_name(number)}", zarr.encode(x, meta[f"{name}/.zarray"]))
        for c in channels:
            put(f"{path}/{c}/{zarr.chunk_name(number, 0)}", zarr.encode(_dense(pdf, number * chunk, len(one), grid, c), meta[f"{c}/.zarray"]))
        return pd.DataFrame({"n": [len(one)]})

    both.withColumn("_chunk", F.floor(F.col("_place") / chunk)).groupBy("_chunk").applyInPandas(write, "n long").collect()
    if len(grid):
        put(f"{path}/{vertical}/{zarr.chunk_name(0)}", zarr.encode(grid, meta[f"{vertical}/.zarray"]))
    for name, value in meta.items():
        put(f"{path}/{name}", json.dumps(value, default=str).encode())
    put(f"{path}/.zmetadata", json.dumps({"zarr_consolidated_format": 1, "metadata": meta}, default=str).encode())


def read_binned_zarr(spark: SparkSession, path: str, vertical: str = "z", keys: Keys = KEYS) -> tuple[DataFrame, DataFrame, dict[str, Any]]:
    """(profiles, rows, attributes) of a store that write_binned_zarr wrote; its chunks of channels are read by as many tasks."""
    meta = json.loads(get(f"{path}/.zmetadata"))["metadata"]  # hidden from Spark's readers by its name
    arrays = {k.split("/")[0]: (v, meta[f"{k.split('/')[0]}/.zattrs"]["_ARRAY_DIMENSIONS"]) for k, v in meta.items() if k.endswith("/.zarray")}
    load = lambda name: spark.read.format("binaryFile").load(f"{path}/{name}/[0-9]*")

    def whole(name: str) -> np.ndarray:
        of = arrays[name][0]
        if not of["shape"][0]:
            return np.zeros(0, of["dtype"])
        parts = sorted((int(r["path"].rsplit("/", 1)[1]), zarr.decode(bytes(r["content"]), of)) for r in load(name).select("path", "content").collect())
        return np.concatenate([x for _, x in parts])[: of["shape"][0]]

    flat = {n: whole(n) for n, (_, over) in arrays.items() if over == ["profile"]}
    flat[keys.deployment] = np.array([x.decode() for x in flat[keys.deployment]], object)
    profiles = _profiles(spark, flat | {"time": flat["time"].astype(float)}, keys)
    channels = [n for n, (_, over) in arrays.items() if over == ["profile", vertical]]
    if not channels or not len(flat[keys.profile]):
        return profiles, spark.createDataFrame([], _schema(channels, keys)), meta[".zattrs"]
    grid, height = whole(vertical), arrays[channels[0]][0]["chunks"][0]
    files = load("{" + ",".join(channels) + "}").select(F.element_at(F.split("path", "/"), -2).alias("name"), F.element_at(F.split(F.element_at(F.split("path", "/"), -1), r"\."), 1).cast("int").alias("number"), "content")
    names = [keys.deployment, keys.profile, "bin_center", *channels]
    layouts = {c: arrays[c][0] for c in channels}

    def parse(pdf: pd.DataFrame) -> pd.DataFrame:
        at = int(pdf["number"].iloc[0]) * height
        n = min(height, len(flat[keys.profile]) - at)
        variables = {vertical: ((vertical,), grid, {}), **{k: (("profile",), flat[k][at : at + n], {}) for k in (keys.deployment, keys.profile)}}
        variables |= {c: (("profile", vertical), zarr.decode(bytes(x), layouts[c])[:n], {}) for c, x in zip(pdf["name"], pdf["content"], strict=True)}
        long = _long(variables, vertical, keys)
        return long.reindex(columns=names)

    return profiles, nan_to_null(files.groupBy("number").applyInPandas(parse, _schema(channels, keys)), channels), meta[".zattrs"]
