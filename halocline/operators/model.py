"""Keys and missing values of instrument logs.

Internally a missing value is NULL; NaN is turned to NULL on the way in and back on the way out. An infinity stays a
value for the rolling kernels and is left out of statistics.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


@dataclass(frozen=True)
class Keys:
    """Names of the key columns. `order` is unique within a deployment and gives the order of the samples."""

    deployment: str = "deployment_id"
    profile: str = "profile_idx"
    order: str = "sample_idx"

    def log(self) -> WindowSpec:
        """Samples of a deployment in order. One specification throughout: Spark then sorts once."""
        return Window.partitionBy(self.deployment).orderBy(self.order)

    def cast(self) -> WindowSpec:
        """Samples of a profile in order."""
        return Window.partitionBy(self.deployment, self.profile).orderBy(self.order)


KEYS = Keys()


def nan_to_null(df: DataFrame, channels: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in channels})


def null_to_nan(df: DataFrame, channels: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(float("nan"))) for c in channels})


def finite(x: Column) -> Column:
    """x, or NULL where it is missing or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def floating(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]


def require(df: DataFrame, channels: Iterable[str], what: str) -> None:
    """Raises for channels that df lacks, before any job runs."""
    lacking = sorted(set(channels) - set(df.columns))
    if lacking:
        raise ValueError(f"{what}: dataset has no {', '.join(lacking)} channel.")


def require_floating(df: DataFrame, channels: Iterable[str], what: str) -> None:
    require(df, channels, what)
    wrong = sorted(set(channels) - set(floating(df)))
    if wrong:
        raise ValueError(f"{what} needs floating-point data; got {', '.join(wrong)}.")
