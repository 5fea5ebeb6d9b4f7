"""History of a dataset and its channels, and what goes into column metadata."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR = "; "


@dataclass
class Lineage:
    """Steps in order, of the dataset and of each channel; kept on the driver and attached to columns at a sink only."""

    dataset: list[str] = field(default_factory=list)
    channels: dict[str, list[str]] = field(default_factory=dict)
    metadata: dict[str, dict[str, Any]] = field(default_factory=dict)

    def record(self, step: str, channel: str | None = None) -> None:
        (self.dataset if channel is None else self.channels.setdefault(channel, [])).append(step)

    def extended(self, *steps: str) -> Lineage:
        """A copy with more dataset steps; this one stays as it is."""
        return Lineage([*self.dataset, *steps], {k: [*v] for k, v in self.channels.items()}, {k: dict(v) for k, v in self.metadata.items()})

    def attach(self, df: DataFrame) -> DataFrame:
        """df with each column's attributes and history as its metadata."""
        return df.select(*(F.col(c).alias(c, metadata=attributes(self.metadata.get(c, {}), self.channels.get(c, []))) for c in df.columns))


def sanitised(value: Any) -> str | int | float:
    """Text and numbers stay, numpy scalars become numbers, times ISO text, all else text."""
    if hasattr(value, "item") and not isinstance(value, (str, bytes)):
        value = value.item()
    if isinstance(value, (str, int, float)):
        return value
    return value.isoformat() if hasattr(value, "isoformat") else str(value)


def attributes(metadata: Mapping[str, Any], history: list[str]) -> dict[str, Any]:
    out = {k: sanitised(v) for k, v in metadata.items() if v is not None}
    return out | ({"history": SEPARATOR.join(history)} if history else {})


def parse_history(text: str | None) -> list[str]:
    return text.split(SEPARATOR) if text else []
