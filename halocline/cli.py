"""Command line: init, process, bin, concatenate."""

from __future__ import annotations

import argparse
import atexit
import logging
import re
import shutil
import sys
import tempfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from .plans import config
from .plans.lineage import attributes, sanitised
from .plans.pipeline import VERBOSE

TEMPLATE = """[project]
name = "{name}"

[paths]
raw_directory = "raw"
profiles_directory = "profiles"
binned_directory = "binned"
concatenated_file = "concatenated.parquet"

[process]
# One of a reference position and an external track.
# geolocation = {{ reference_latitude = 0.0, reference_longitude = 0.0 }}

[bin]
channel = "z"
step = 1.0
method = "huber"
"""


def init(folder: Path, name: str, force: bool = False) -> Path:
    """Writes a starter configuration and makes its folders; an existing one stays unless forced."""
    path = folder / "config.toml"
    if path.exists() and not force:
        raise FileExistsError(f"{path} exists; use --force to replace it.")
    text = TEMPLATE.format(name=name)
    # Valid but for the position, which only the user knows.
    checked = config.load_text(text, {"process": {"geolocation": {"reference_latitude": 0.0, "reference_longitude": 0.0}}})
    folder.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    for d in (checked.paths.raw_directory, checked.paths.profiles_directory, checked.paths.binned_directory):
        (folder / d).mkdir(parents=True, exist_ok=True)
    return path


def configure_logging(level: int, log_file: Path | None, error_file: Path | None) -> None:
    """To standard output and to a file what is below ERROR, to an error file the rest."""
    root = logging.getLogger("halocline")
    root.handlers.clear()
    root.setLevel(level)
    below = lambda r: r.levelno < logging.ERROR
    for handler, keep in ((logging.StreamHandler(sys.stdout), None), (log_file and logging.FileHandler(log_file), below), (error_file and logging.FileHandler(error_file), lambda r: not below(r))):
        if handler:
            handler.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
            if keep:
                handler.addFilter(keep)
            root.addHandler(handler)


#: Deployments that are processed side by side: their jobs share the executors.
AT_ONCE = 4


def _process_one(spark, settings: config.Settings, path: Path) -> None:
    from .plans import pipeline
    from .sources import grids, io

    raw, line = io.read_log(spark, str(path))
    instrument = io.instrument_of(path)
    own = settings.process_for(instrument.get("instrument_serial_number"), path.stem)
    g = own.geolocation.external_dataset_path
    track = io.load(spark, str(g)) if g else None
    done = pipeline.process(raw, own, track, line)
    line = pipeline.record_thresholds(done, own, path.stem)
    types = {c: own.spark_type(c) for c in done.samples.columns}
    out = f"{settings.paths.profiles_directory}/{path.stem}"
    compression = own.parquet_compression
    if own.profile_format == "netcdf":
        grids.write_profiles_netcdf(done.samples, f"{out}/netcdf", line, types).collect()  # a path a profile
    else:
        io.write_profiles(done.samples, f"{out}/samples", line, types, compression.enabled, compression.level)
    done.profiles.write.mode("overwrite").parquet(f"{out}/profiles")
    io.deployments(raw, str(path), settings.project.name, instrument).write.mode("overwrite").parquet(f"{out}/deployment")


def _process(spark, settings: config.Settings, targets: list[str]) -> list[str]:
    """All deployments are tried; those that failed are told, and written as the table of errors of this run."""
    from pyspark import inheritable_thread_target

    from .sources import io

    def tried(path: Path) -> str | None:
        try:
            _process_one(spark, settings, path)
        except Exception as e:  # one deployment's failure must not stop the others
            logging.getLogger("halocline").error("%s: %s", path.stem, e)
            return str(e)

    paths = io.found_files(settings.paths.raw_directory, (".parquet",), targets)
    with ThreadPoolExecutor(AT_ONCE) as pool:
        # Wrapped for each deployment: local properties, such as a query's id, must not be shared by threads.
        found = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(tried), p) for p in paths]]
    failed = [(p.stem, e) for p, e in zip(paths, found, strict=True) if e is not None]
    io.write_errors(spark, str(settings.paths.profiles_directory), failed)
    return [f"{name}: {e}" for name, e in failed]


#: What a gridded deployment's name ends in, by format.
SUFFIXES = {"parquet": "", "netcdf": ".nc", "zarr": ".zarr"}


def _write_binned(profiles, rows, path: str, of: config.Bin, about: dict) -> None:
    """By the path's suffix."""
    from .sources import grids, io

    if path.endswith(".nc"):
        grids.write_binned_netcdf(profiles, rows, path, about, of.channel)
    elif path.endswith(".zarr"):
        z = of.zarr_compression
        grids.write_binned_zarr(profiles, rows, path, about, of.channel, z.cname if z.enabled else None, z.clevel, z.shuffle in ("shuffle", "bitshuffle"))
    else:
        io.write_binned(profiles, rows, path, attributes=about)


def _read_binned(spark, path: str, vertical: str) -> tuple:
    """(profiles, rows, attributes), by the path's suffix."""
    from .sources import grids, io

    if path.endswith(".nc"):
        return grids.read_binned_netcdf(spark, path, vertical)
    if path.endswith(".zarr"):
        return grids.read_binned_zarr(spark, path, vertical)
    return *io.read_binned(spark, path), io.binned_attributes(spark, path)


def _bin(spark, settings: config.Settings, targets: list[str]) -> list[str]:
    from .operators import binning
    from .plans import pipeline
    from .sources import grids, io

    failures = []
    for folder in io.found_deployments(settings.paths.profiles_directory, targets):
        try:
            known = spark.read.parquet(f"{folder}/deployment")
            binning.check_one_identity(known)
            samples, line = grids.read_profiles_netcdf(spark, f"{folder}/netcdf") if (folder / "netcdf").is_dir() else io.read_profiles(spark, f"{folder}/samples")
            profiles, rows = pipeline.bin_profiles(samples, spark.read.parquet(f"{folder}/profiles"), settings.bin)
            about = {k: sanitised(v) for k, v in known.first().asDict().items() if v is not None} | attributes({}, line.dataset)
            _write_binned(profiles, rows, f"{settings.paths.binned_directory}/{folder.name}{SUFFIXES[settings.bin.output_format]}", settings.bin, about)
        except Exception as e:  # one deployment's failure must not stop the others
            logging.getLogger("halocline").error("%s: %s", folder.name, e)
            failures.append(f"{folder.name}: {e}")
    return failures


def _concatenate(spark, settings: config.Settings, targets: list[str]) -> list[str]:
    from .plans import pipeline
    from .sources import io

    if settings.paths.concatenated_file is None:
        raise ValueError("paths.concatenated_file is not set.")
    parts = [_read_binned(spark, str(f), settings.bin.channel) for f in io.found_binned(settings.paths.binned_directory, targets)]
    profiles, rows, about = pipeline.concatenate([p[:2] for p in parts], [p[2] for p in parts])
    _write_binned(profiles, rows, str(settings.paths.concatenated_file), settings.bin, about)
    return []


def share(spark) -> None:
    """Lineage is cut with tables in spark.checkpoint.dir; local mode may do with a folder of its own, a cluster must name one."""
    from .operators.tables import shared_folder

    if shared_folder(spark):
        return
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share.")
    own = tempfile.mkdtemp(prefix="halocline-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", own)


COMMANDS = {"process": _process, "bin": _bin, "concatenate": _concatenate}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="halocline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    start = commands.add_parser("init")
    start.add_argument("folder", type=Path)
    start.add_argument("--name", default="my_project")
    start.add_argument("--force", action="store_true")
    for name in COMMANDS:
        p = commands.add_parser(name)
        p.add_argument("--config", type=Path)
        p.add_argument("--set", action="append", default=[], dest="overrides", metavar="KEY=VALUE")
        p.add_argument("--target", action="append", default=[])
        p.add_argument("--verbose", action="store_true")
    args = parser.parse_args(argv)
    try:
        if args.command == "init":
            print(init(args.folder, args.name, args.force))
            return 0
        settings = config.load(args.config, args.overrides)
        configure_logging(VERBOSE if args.verbose else logging.INFO, settings.paths.log_file, settings.paths.error_log_file)
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("halocline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
        share(spark)
        failures = COMMANDS[args.command](spark, settings, args.target)
    except (ValueError, OSError) as e:
        print(e, *getattr(e, "__notes__", []), sep="\n", file=sys.stderr)
        return 1
    for f in failures:
        print(f, file=sys.stderr)
    return int(bool(failures))


if __name__ == "__main__":
    sys.exit(main())
