"""What the jobs share: settings from a small TOML file, a log of rows read and written, the command line's frame, a folder for the registered queries."""

from __future__ import annotations

import argparse
import atexit
import logging
import re
import shutil
import sys
import tempfile
import tomllib
import uuid
from collections.abc import Callable
from dataclasses import fields
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("halocline.jobs")


def settings_from(kind: type, path: str | None):
    """The dataclass `kind` with the values of a TOML file; unknown keys are refused."""
    if path is None:
        return kind()
    with open(path, "rb") as f:
        found = tomllib.load(f)
    wrong = sorted(set(found) - {f.name for f in fields(kind)})
    if wrong:
        raise ValueError(f"{path}: unknown settings {', '.join(wrong)}.")
    return kind(**found)


class Counted:
    """Counts rows of tables while a job's own actions read or write them, and logs them at the end: no job of its own."""

    def __init__(self) -> None:
        self.seen: list[tuple[str, Observation]] = []

    def of(self, df: DataFrame, what: str) -> DataFrame:
        seen = Observation()
        self.seen.append((what, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def told(self) -> dict[str, int]:
        found = {}
        for what, seen in self.seen:
            try:
                found[what] = seen.get["rows"]
            except Py4JJavaError:  # Spark drops an observation together with a relation that it finds to be empty
                found[what] = 0
            log.info("%s: %d rows", what, found[what])
        return found


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Writes df by partition; those that it has are replaced, all others stay. Runs again with the same result."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What replace_partitions wrote; no rows if it had none to write yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def own_folder(spark: SparkSession, name: str) -> str:
    """A new folder where driver and executors share one: under spark.checkpoint.dir, or, in local mode without it, in one that goes at the end."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share.")
        root = tempfile.mkdtemp(prefix="halocline-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def command_line(about: str, kind: type, paths: dict[str, str], run: Callable, argv: list[str] | None = None) -> int:
    """Parses paths and --config, makes a session, runs, and stops it."""
    parser = argparse.ArgumentParser(description=about)
    for name, what in paths.items():
        parser.add_argument(f"--{name}", required=True, help=what)
    parser.add_argument("--config", help="TOML file with settings; each has a default")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s", stream=sys.stdout)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    try:
        settings = settings_from(kind, args.config and str(Path(args.config)))
    except (OSError, ValueError) as e:
        print(e, file=sys.stderr)
        return 1
    spark = SparkSession.builder.appName(about.split(":")[0]).config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        run(spark, *(getattr(args, name) for name in paths), settings)
    finally:
        spark.stop()
    return 0
