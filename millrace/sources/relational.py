"""Relational extracts: whole tables, time windows, children of a window."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.filters import in_days


#: The name a window's timestamp travels under.
WINDOW = "_window"


class Relations(Protocol):
    """What a table job may ask of a relational source."""

    def table(self, name: str) -> DataFrame: ...

    def window(
        self, name: str, column: str, first: dt.date, last: dt.date
    ) -> DataFrame: ...

    def children_of_window(
        self,
        child: str,
        foreign_key: str,
        parent: str,
        primary_key: str,
        column: str,
        first: dt.date,
        last: dt.date,
    ) -> DataFrame: ...


@dataclass(frozen=True)
class Partitioning:
    """How to split a JDBC scan into parallel range reads."""

    column: str
    lower: str
    upper: str
    count: int


@dataclass(frozen=True)
class JdbcRelations:
    spark: SparkSession
    url: str
    namespace: str = ""
    options: Mapping[str, str] = field(default_factory=dict)
    # Tables too big for one connection, with their ranges.
    partitioning: Mapping[str, Partitioning] = field(default_factory=dict)
    # Parallel reads of a time window (its bounds are known).
    window_reads: int = 1

    def _name(self, table: str) -> str:
        parts = [p for p in (self.namespace, table) if p]
        return ".".join(f'"{p}"' for p in parts)

    def _read(self, dbtable: str, split: Partitioning | None = None) -> DataFrame:
        reader = (
            self.spark.read.format("jdbc")
            .option("url", self.url)
            .option("dbtable", dbtable)
            .options(**self.options)
        )
        if split:
            reader = (
                reader.option("partitionColumn", split.column)
                .option("lowerBound", split.lower)
                .option("upperBound", split.upper)
                .option("numPartitions", split.count)
            )
        return reader.load()

    def table(self, name: str) -> DataFrame:
        return self._read(self._name(name), self.partitioning.get(name))

    def window(
        self, name: str, column: str, first: dt.date, last: dt.date
    ) -> DataFrame:
        """The range is a plain comparison, so Spark sends it to the database."""
        split = self._ranges(column, first, last)
        return self._read(self._name(name), split).filter(in_days(column, first, last))

    def children_of_window(
        self,
        child: str,
        foreign_key: str,
        parent: str,
        primary_key: str,
        column: str,
        first: dt.date,
        last: dt.date,
    ) -> DataFrame:
        """The join runs in the database: only the window's rows travel.

        The parent's timestamp comes along under another name, so that the
        window can be read in parallel ranges like a table's.
        """
        text = children_sql(
            self._name(child), foreign_key, self._name(parent), primary_key, column, first, last
        )
        return self._read(text, self._ranges(WINDOW, first, last)).drop(WINDOW)

    def _ranges(self, column: str, first: dt.date, last: dt.date) -> Partitioning | None:
        if self.window_reads < 2:
            return None
        end = last + dt.timedelta(days=1)
        return Partitioning(column, f"{first} 00:00:00", f"{end} 00:00:00", self.window_reads)


def children_sql(
    child: str, foreign_key: str, parent: str, primary_key: str, column: str,
    first: dt.date, last: dt.date,
) -> str:
    """The children of a window of parents; times in the form every JDBC driver reads."""
    end = last + dt.timedelta(days=1)
    return (
        f'(SELECT c.*, p."{column}" AS "{WINDOW}" FROM {child} c'
        f' INNER JOIN {parent} p ON c."{foreign_key}" = p."{primary_key}"'
        f" WHERE p.\"{column}\" >= {{ts '{first} 00:00:00'}}"
        f" AND p.\"{column}\" < {{ts '{end} 00:00:00'}}) f"
    )


@dataclass(frozen=True)
class FrameRelations:
    """The same source over tables Spark already reads (files, views)."""

    load: Callable[[str], DataFrame]

    def table(self, name: str) -> DataFrame:
        return self.load(name)

    def window(
        self, name: str, column: str, first: dt.date, last: dt.date
    ) -> DataFrame:
        return self.load(name).filter(in_days(column, first, last))

    def children_of_window(
        self,
        child: str,
        foreign_key: str,
        parent: str,
        primary_key: str,
        column: str,
        first: dt.date,
        last: dt.date,
    ) -> DataFrame:
        """A semi join: the parent key is unique, so it equals the inner join."""
        parents = self.window(parent, column, first, last).select(primary_key)
        children = self.load(child)
        return children.join(
            parents, children[foreign_key] == parents[primary_key], "left_semi"
        )
