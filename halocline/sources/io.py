"""Reading and writing logs, profiles and gridded deployments as Parquet; finding files."""

from __future__ import annotations

import json
import sqlite3
from collections.abc import Iterator, Mapping
from datetime import UTC, datetime, timedelta
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.model import KEYS, Keys, floating, nan_to_null, null_to_nan
from ..plans.lineage import Lineage
from . import netcdf
from .naming import channel_keys, names


def found_files(root: Path, suffixes: tuple[str, ...], targets: list[str] | None = None) -> list[Path]:
    """The targets within root, in their order, or all files of root with a suffix, sorted. Case of the suffix doesn't matter."""
    root = root.resolve()
    if not root.is_dir():
        raise ValueError(f"{root} is not a directory.")
    if not targets:
        every = sorted(p for p in root.iterdir() if p.suffix.lower() in suffixes)
        if not every:
            raise ValueError(f"no {' or '.join(suffixes)} files in {root}.")
        return every
    out = []
    for t in targets:
        p = (root / t).resolve()
        if not p.is_relative_to(root):
            raise ValueError(f"{t} is outside {root}.")
        if p.suffix.lower() not in suffixes:
            raise ValueError(f"{t} is not a {' or '.join(suffixes)} file.")
        if not p.exists():
            raise ValueError(f"{t} does not exist in {root}.")
        out.append(p)
    return out


#: Beside the deployments: what went wrong in the last run.
ERRORS = "_errors"
ERRORS_SCHEMA = "deployment_id string, error string"


def write_errors(spark: SparkSession, root: str, failed: list[tuple[str, str]]) -> None:
    """A row for each deployment that failed in this run, in place of those of the run before; there may be none."""
    spark.createDataFrame(failed, ERRORS_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/{ERRORS}")


def read_errors(spark: SparkSession, root: str) -> DataFrame:
    """(deployment_id, error) of the last run."""
    return spark.read.schema(ERRORS_SCHEMA).json(f"{root.rstrip('/')}/{ERRORS}")


def found_deployments(root: Path, targets: list[str] | None = None) -> list[Path]:
    """Subfolders of root by name, or all of them but the errors, sorted."""
    root = root.resolve()
    every = sorted(p for p in root.iterdir() if p.is_dir() and p.name != ERRORS) if root.is_dir() else []
    if targets:
        every = [(root / t).resolve() for t in targets]
        for t, p in zip(targets, every, strict=True):
            if not p.is_relative_to(root) or not p.is_dir():
                raise ValueError(f"{t} is no deployment of {root}.")
    if not every:
        raise ValueError(f"no deployments in {root}.")
    return every


def read_log(spark: SparkSession, path: str, deployment_id: str | None = None, keys: Keys = KEYS) -> tuple[DataFrame, Lineage]:
    """A log from Parquet: NaN becomes NULL, instrument names become channel keys. The deployment is the file's stem, unless it is a column."""
    df = spark.read.parquet(path)
    fixed = [c for c in (keys.deployment, keys.order, "time") if c in df.columns]
    mapped = channel_keys([c for c in df.columns if c not in fixed])
    df = df.select(*fixed, *(F.col(n).alias(k) for n, k in mapped.items()))
    if keys.deployment not in df.columns:
        df = df.withColumn(keys.deployment, F.lit(deployment_id or Path(path).stem))
    line = Lineage([f"read from {path}"])
    for n, k in mapped.items():
        line.metadata[k] = {"long_name": names(n).long_name, "standard_name": names(n).standard_name}
    return nan_to_null(df, floating(df)), line


#: What an instrument tells of itself.
INSTRUMENT = ("instrument_model", "instrument_serial_number", "instrument_firmware_version", "deployment_comment")


def instrument_of(path: Path) -> dict[str, str]:
    """The instrument's fields from <stem>.json beside a log; unknown fields are refused, without the file all are missing."""
    side = path.with_suffix(".json")
    found = json.loads(side.read_text()) if side.is_file() else {}
    wrong = sorted(set(found) - set(INSTRUMENT))
    if wrong:
        raise ValueError(f"{side}: unknown fields {', '.join(wrong)}.")
    return {k: None if v is None else str(v) for k, v in found.items()}


def deployments(df: DataFrame, source_file: str | None = None, project: str | None = None, instrument: Mapping[str, str] | None = None, time: str = "time", keys: Keys = KEYS) -> DataFrame:
    """The dimension table, a row a deployment: source, instrument, project, first and last time, samples, sampling period.

    The period is the median step in seconds, missing for a single sample.
    """
    step = F.unix_micros(F.col(time).cast("timestamp")) - F.lag(F.unix_micros(F.col(time).cast("timestamp"))).over(keys.log())
    found = df.withColumn("_step", step).groupBy(keys.deployment).agg(
        F.min(time).alias("deployment_start_time"), F.max(time).alias("deployment_end_time"), F.count("*").alias("n_samples"), (F.median("_step") / 1e6).alias("sampling_period_seconds")
    )
    fixed = {"source_file": source_file, "project_name": project, **{k: (instrument or {}).get(k) for k in INSTRUMENT}}
    return found.withColumns({k: F.lit(v).cast("string") for k, v in fixed.items()})


def cast_channels(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in floating(df)})


def profile_key(df: DataFrame, keys: Keys = KEYS) -> DataFrame:
    """df with `profile_key`, <deployment>_p<index of four digits>."""
    return df.withColumn("profile_key", F.format_string("%s_p%04d", F.col(keys.deployment).cast("string"), F.col(keys.profile).cast("int")))


def write_profiles(df: DataFrame, path: str, lineage: Lineage, types: Mapping[str, str], compressed: bool = True, level: int | None = None, keys: Keys = KEYS, mode: str = "overwrite") -> None:
    """A folder for each deployment, its samples sorted by profile, so that a profile's are read from few row groups; floating channels cast, NULL as NaN, attributes in column metadata, history beside the data."""
    channels = floating(df)
    out = lineage.attach(cast_channels(null_to_nan(df, channels), types))
    spark = df.sparkSession
    # By profile, so that a long deployment is many tasks' work; a task may write several deployments.
    writer = out.repartition(keys.deployment, keys.profile).sortWithinPartitions(keys.deployment, keys.profile, keys.order).write.mode(mode).partitionBy(keys.deployment)
    writer = writer.option("compression", "zstd" if compressed else "none").option("parquet.enable.dictionary", "false")
    if compressed and level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    writer.parquet(path)
    rows = [(json.dumps(lineage.dataset), json.dumps({k: v for k, v in lineage.metadata.items()}, default=str))]
    spark.createDataFrame(rows, "history string, metadata string").coalesce(1).write.mode(mode).json(f"{path.rstrip('/')}.lineage")


def read_profiles(spark: SparkSession, path: str) -> tuple[DataFrame, Lineage]:
    """What write_profiles wrote: NaN becomes NULL again."""
    df = spark.read.parquet(path)
    line = Lineage()
    for f in df.schema.fields:
        meta = dict(f.metadata or {})
        history = meta.pop("history", None)
        line.metadata[f.name] = meta
        if history:
            line.channels[f.name] = history.split("; ")
    stored = spark.read.json(f"{path.rstrip('/')}.lineage").first()
    line.dataset = json.loads(stored["history"])
    return nan_to_null(df, floating(df)), line


def load(spark: SparkSession, path: str) -> DataFrame:
    """By suffix: Parquet files or folders, also those with BYTE_STREAM_SPLIT pages; the one-dimensional variables of a netCDF file.

    Times of a netCDF file, by their units, are timestamps without zone.
    """
    suffix = Path(path).suffix.lower()
    if suffix in ("", ".parquet"):
        return parquet(spark, path)
    if suffix == ".nc":
        return _series(spark, path)
    raise ValueError(f"cannot read {suffix} files; expected .parquet or .nc.")


def parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or folder. Spark's vectorised reader can't read BYTE_STREAM_SPLIT pages, so the files that have some are read in Arrow batches.

    Each file's footer says which it is, whatever the others are; tasks look at them.
    """
    files = spark.read.parquet(path)
    names, schema = files.columns, files.schema
    every = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_split_pages(content) for content in batch.column(1)], pa.bool_())], ["path", "split"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for part in pq.ParquetFile(pa.BufferReader(content.as_buffer())).iter_batches():
                    yield part.select(names)

    found = every.select("path", "content").mapInArrow(marked, "path string, split boolean").collect()  # names of files alone
    split, plain = ([r["path"] for r in found if r["split"] == wanted] for wanted in (True, False))
    if not split:
        return files
    arrow = spark.read.format("binaryFile").load(split).select("content").mapInArrow(read, schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*plain).unionByName(arrow) if plain else arrow


def _split_pages(content: pa.Scalar) -> bool:
    """Whether a file has columns with BYTE_STREAM_SPLIT pages."""
    meta = pq.ParquetFile(pa.BufferReader(content.as_buffer())).metadata
    return any("BYTE_STREAM_SPLIT" in meta.row_group(g).column(c).encodings for g in range(meta.num_row_groups) for c in range(meta.num_columns))


#: Units of time in microseconds.
MICROS = {"microseconds": 1, "milliseconds": 1e3, "seconds": 1e6, "minutes": 6e7, "hours": 3.6e9, "days": 8.64e10}


def _series(spark: SparkSession, path: str) -> DataFrame:
    """The variables of a netCDF file that have the dimension of the longest one-dimensional variable, as columns. The file is one track or log, read at once."""
    content = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    variables, _ = netcdf.decode(bytes(content))
    flat = {n: (over[0], x, about) for n, (over, x, about) in variables.items() if len(over) == 1}
    if not flat:
        raise ValueError(f"{path} has no one-dimensional variables.")
    main = max(flat.values(), key=lambda v: len(v[1]))[0]
    columns, kinds = {}, {}
    for n, (over, x, about) in flat.items():
        if over != main:
            continue
        unit, _, since = str(about.get("units", "")).partition(" since ")
        if unit in MICROS and since:
            start = datetime.fromisoformat(since.replace("T", " ").removesuffix("Z").strip())
            columns[n], kinds[n] = [None if v != v else start + timedelta(microseconds=round(float(v) * MICROS[unit])) for v in x.tolist()], "timestamp_ntz"
        elif x.dtype.kind == "f":
            columns[n], kinds[n] = [None if v != v else v for v in x.tolist()], "double"
        else:
            columns[n], kinds[n] = x.tolist(), "string" if x.dtype.kind == "O" else "long"
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"`{n}` {k}" for n, k in kinds.items()))


def found_binned(root: Path, targets: list[str] | None = None) -> list[Path]:
    """Gridded deployments of root, in any format: folders, .zarr stores and .nc files; those of the targets, which go without suffix, in their order."""
    root = root.resolve()
    every = {p.stem if p.suffix in (".nc", ".zarr") else p.name: p for p in sorted(root.iterdir()) if p.is_dir() or p.suffix == ".nc"} if root.is_dir() else {}
    lacking = [t for t in targets or [] if t not in every]
    if lacking:
        raise ValueError(f"{', '.join(lacking)}: no deployment of {root}.")
    if not every:
        raise ValueError(f"no deployments in {root}.")
    return [every[t] for t in targets] if targets else list(every.values())


def write_binned(profiles: DataFrame, rows: DataFrame, path: str, keys: Keys = KEYS, mode: str = "overwrite", attributes: Mapping[str, Any] | None = None) -> None:
    """The long form of a grid: profiles and (profile, bin) rows, and the dataset's attributes."""
    spark = profiles.sparkSession
    spark.createDataFrame([(json.dumps(dict(attributes or {}), default=str),)], "attributes string").coalesce(1).write.mode(mode).json(f"{path}/attributes")
    profiles.write.mode(mode).option("compression", "zstd").parquet(f"{path}/profiles")
    rows.write.mode(mode).option("compression", "zstd").partitionBy(keys.deployment).parquet(f"{path}/bins")


def read_binned(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/profiles"), spark.read.parquet(f"{path}/bins")


def binned_attributes(spark: SparkSession, path: str) -> dict[str, Any]:
    """The attributes that write_binned kept."""
    return json.loads(spark.read.schema("attributes string").json(f"{path}/attributes").first()["attributes"])


def wide(rows: DataFrame, channel: str, keys: Keys = KEYS) -> DataFrame:
    """One row a profile, one column a bin centre: an export of one channel of one grid."""
    return rows.groupBy(keys.deployment, keys.profile).pivot("bin_center").agg(F.first(channel))


class SqliteLog(DataSource):
    """Instrument logs in SQLite containers: a `channels` table (longName) and a `data` table (tstamp in ms, channelNN).

    Options: path, or several separated by commas; each file is a partition. start and end, in milliseconds and both
    included, bound what is read in the container's own query. The executors must see the files.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite_log"

    def schema(self) -> str:
        return "deployment_id string, sample_idx long, tstamp long, channel string, value double"

    def reader(self, schema) -> DataSourceReader:
        return _SqliteReader(self.options)


class _SqliteReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = [p for p in options["path"].split(",") if p]
        self.bounds = [int(options.get("start", -(1 << 62))), int(options.get("end", 1 << 62))]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        path = partition.value
        with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as con:
            channels = [r[0] for r in con.execute("select longName from channels order by channelID")]
            columns = [r[1] for r in con.execute("pragma table_info(data)") if r[1].startswith("channel")]
            # Numbered over the whole log, so that bounds change no sample's place.
            before = con.execute("select count(*) from data where tstamp < ?", self.bounds[:1]).fetchone()[0]
            for i, (t, *values) in enumerate(con.execute(f"select tstamp, {', '.join(columns)} from data where tstamp between ? and ? order by tstamp", self.bounds), before):
                for c, v in zip(channels, values, strict=False):
                    yield Path(path).stem, i, t, c, v


def read_sqlite_logs(spark: SparkSession, paths: list[str], channels: list[str], start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Logs in wide form, with a timestamp without zone in UTC; start and end, in UTC if they have no zone, are included."""
    spark.dataSource.register(SqliteLog)
    reader = spark.read.format("sqlite_log").option("path", ",".join(paths))
    for name, t in (("start", start), ("end", end)):
        if t is not None:
            since = (t if t.tzinfo else t.replace(tzinfo=UTC)) - datetime(1970, 1, 1, tzinfo=UTC)
            reader = reader.option(name, str(-((-since) // timedelta(milliseconds=1)) if name == "start" else since // timedelta(milliseconds=1)))
    long = reader.load()
    keys = channel_keys(channels)
    values = [F.max(F.when(F.col("channel") == n, F.col("value"))).alias(k) for n, k in keys.items()]
    wide_form = long.groupBy("deployment_id", "sample_idx", "tstamp").agg(*values)
    return wide_form.withColumn("time", F.timestamp_millis("tstamp").cast("timestamp_ntz")).drop("tstamp")
