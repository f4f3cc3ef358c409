"""Where things are: layers, tables and sources of one environment."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.relational import Relations
from millrace.sources.tables import SnapshotTable

# Environment -> suffix of its layer folders.
ENVIRONMENTS = {"hmg": "-hmg", "prd": ""}


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str
    environment: str = "hmg"
    relations: Relations | None = None
    documents: Callable[[], DataFrame] | None = None
    owner: str = ""

    def __post_init__(self):
        if self.environment not in ENVIRONMENTS:
            raise ValueError(
                f"Invalid environment: {self.environment!r}"
                f" (options: {sorted(ENVIRONMENTS)})"
            )

    def layer_path(self, layer: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}{ENVIRONMENTS[self.environment]}"

    @property
    def events_path(self) -> str:
        """Root of the bronze event lines."""
        return f"{self.layer_path('bronze')}/kafka/sensor_events"

    @property
    def quality_path(self) -> str:
        """Root of the stored check results."""
        return self.layer_path("quality")

    def table(self, path: str) -> SnapshotTable:
        """Table of a ``layer/source/table`` path."""
        layer, source, name = path.strip("/").split("/")[-3:]
        return SnapshotTable(self.spark, f"{self.layer_path(layer)}/{source}/{name}")

    def read(self, path: str, **where) -> DataFrame:
        return self.table(path).read(where)
