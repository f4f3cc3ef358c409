"""Tables as data: what a table is made of, checked by and keyed on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from millrace.operators.columns import cast_columns
from millrace.operators.dedup import keep_latest
from millrace.operators.quality import Rule

if TYPE_CHECKING:
    from millrace.plans.lake import Lake

@dataclass(frozen=True)
class Consuming:
    """A batch of what was not read before; ``note`` remembers that it now is."""

    rows: DataFrame
    note: Callable[[], None]


# Builds a table's batch for a run date. The observation, if used, counts
# rows before deduplication.
Build = Callable[["Lake", dt.date, Observation | None], DataFrame | Consuming]


@dataclass(frozen=True)
class TableSpec:
    """One table. ``path`` is ``layer/source/table``.

    Without keys a load replaces the run date's partition (bronze); with keys
    it upserts. ``replaces_day`` first drops the rows of the run date (facts).
    ``keys_stay`` says that a key is only ever loaded into one partition, which
    saves the upsert a look at the others. ``indexed`` keeps an index of the keys
    beside the table, for keys that may come again in any partition.
    ``skips_unchanged`` leaves rows, and whole partitions, that a new extract does not
    change as they are, with the stamps of the load that brought them. ``reads`` names the tables the batch is
    built from, which a run of many tables loads first.
    """

    path: str
    build: Build
    rules: tuple[Rule, ...] = ()
    keys: tuple[str, ...] = ()
    null_safe: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    replaces_day: bool = False
    keys_stay: bool = False
    indexed: bool = False
    skips_unchanged: bool = False
    counts_duplicates: bool = False
    reads: tuple[str, ...] = ()

    @property
    def layer(self) -> str:
        return self.path.strip("/").split("/")[-3]

    @property
    def source(self) -> str:
        return self.path.strip("/").split("/")[-2]

    @property
    def name(self) -> str:
        return self.path.strip("/").split("/")[-1]


@dataclass(frozen=True)
class Refinement:
    """How a bronze table becomes a silver batch."""

    keys: tuple[str, ...]
    casts: Mapping[str, str]
    filters: Callable[[], tuple[Column, ...]]
    order_by: tuple[str, ...] = ("_execution_date", "_processed_at")
    derive: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    drop: tuple[str, ...] = ()

    def apply(self, bronze: DataFrame, before: Observation | None = None) -> DataFrame:
        """Cast, derive, filter, then keep the newest row per key."""
        if self.derive:
            bronze = bronze.withColumns({n: make() for n, make in self.derive.items()})
        typed = cast_columns(bronze, self.casts, self.drop)
        for predicate in self.filters():
            typed = typed.filter(predicate)
        if before is not None:
            typed = typed.observe(before, F.count(F.lit(1)).alias("rows"))
        return keep_latest(typed, self.keys, self.order_by)
