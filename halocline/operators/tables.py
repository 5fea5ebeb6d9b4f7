"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

Store = Callable[[DataFrame], DataFrame]


def shared_folder(spark: SparkSession) -> str | None:
    """The folder that driver and executors share, as the session names it."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def stores(spark: SparkSession) -> Store:
    """Cuts lineage with a table in the shared folder; where none is set, nothing is cut."""
    root = shared_folder(spark)

    def cut(df: DataFrame) -> DataFrame:
        if not root:
            return df
        path = f"{root.rstrip('/')}/halocline-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return cut


class Tally:
    """Counts of rows, taken by the jobs that write tables and not by jobs of their own.

    Without a shared folder no tables are written, and nothing is counted. Rows must be counted in the last stage before
    their table: a task there counts once however often it runs, while a stage that is read again, or sampled for
    ranges, would count again.
    """

    def __init__(self, spark: SparkSession) -> None:
        self._on = bool(shared_folder(spark))
        self._seen: dict[str, tuple[list[str], Observation]] = {}

    def watch(self, df: DataFrame, step: str, marks: Mapping[str, Column]) -> DataFrame:
        """df, of whose rows those with a true mark are counted for each name when df is next written."""
        if not self._on or not marks:
            return df
        seen = Observation()
        self._seen[step] = list(marks), seen
        return df.observe(seen, *(F.sum(m.cast("long")).alias(name) for name, m in marks.items()))

    def found(self, step: str) -> dict[str, int]:
        """The counts by name, once the table is written; none for a step that was not watched. Without rows they are 0."""
        if step not in self._seen:
            return {}
        names, seen = self._seen[step]
        try:
            return {name: seen.get[name] or 0 for name in names}
        except Py4JJavaError:  # Spark drops an observation together with a relation that it finds to be empty
            return dict.fromkeys(names, 0)
