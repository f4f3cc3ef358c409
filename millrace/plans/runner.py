"""Run tables for a date: build, stage, check, publish."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Observation, Row
from pyspark.sql import functions as F

from millrace.operators.columns import STAMPS, add_metadata
from millrace.operators.merge import GUARD
from millrace.operators.quality import (
    Level,
    QualityError,
    broken_rules,
    gate,
    measure,
    report,
)
from millrace.plans.bronze import BRONZE
from millrace.plans.gold import DIMENSIONS, FACTS, RECOMPUTED_FACTS
from millrace.plans.lake import Lake
from millrace.plans.silver import LATE_EVENTS, SILVER
from millrace.plans.spec import Consuming, TableSpec
from millrace.sources.key_index import KeyIndex
from millrace.sources.plain import overwrite_partitions
from millrace.sources.tables import key_bounds, key_ranges

log = logging.getLogger(__name__)

# A layer only reads the ones before it.
ALL_TABLES = (*BRONZE, *SILVER, *DIMENSIONS, *FACTS)

#: The same, with events taken whenever they arrive and facts counted anew where they fall.
LATE_TABLES = tuple(
    {spec.path: spec for spec in (*ALL_TABLES, LATE_EVENTS, *RECOMPUTED_FACTS)}.values()
)


@dataclass(frozen=True)
class RunResult:
    table: str
    status: str  # loaded, empty
    rows: int = 0
    duplicates: int | None = None
    warnings: tuple[str, ...] = ()
    rewritten: tuple[str, ...] = ()


def find_table(path: str, tables: Iterable[TableSpec] = ALL_TABLES) -> TableSpec:
    wanted = path.strip("/")
    for spec in tables:
        if spec.path == wanted:
            return spec
    raise KeyError(f"unknown table: {path}")


def run(lake: Lake, spec: TableSpec, day: dt.date) -> RunResult:
    """Load one table for a run date.

    The batch is computed once and written beside the table; rules, row count
    and key bounds are one aggregate over what was written. Nothing is
    published if an Error rule fails. What a batch consumes is noted after it is
    published: if that comes to nothing, the next run reads it again, which an
    upsert of the same rows does not mind.
    """
    log.info("%s: building batch of %s for %s", spec.path, day, lake.owner or "-")
    before = Observation() if spec.counts_duplicates else None
    built = spec.build(lake, day, before)
    if not isinstance(built, Consuming):
        built = Consuming(built, lambda: None)
    batch = add_metadata(built.rows, day, spec.source)

    table = lake.table(spec.path)
    # Batches of tables stored by run date hold a single one.
    staged = table.stage(batch, spec.partition_by, constant=[GUARD])
    bounds = [k for k in spec.keys if k not in spec.null_safe]
    measured = measure(table.read_staged(staged), spec.rules, key_bounds(bounds)).first()
    if measured["rows"] == 0:
        log.warning("%s: no rows, nothing loaded", spec.path)
        table.discard(staged)
        built.note()
        return RunResult(spec.path, "empty")

    _store_report(lake, spec, measured, day)
    warnings = tuple(broken_rules(measured, spec.rules, Level.WARNING))
    for label in warnings:
        log.warning("%s: rule failed: %s", spec.path, label)
    try:
        gate(measured, spec.rules)
    except QualityError:
        table.discard(staged)
        raise

    rewritten: Iterable[str] = ()
    if spec.keys:
        rewritten = table.merge(
            staged,
            spec.keys,
            null_safe=spec.null_safe,
            replace_day=day if spec.replaces_day else None,
            key_ranges=key_ranges(measured, bounds),
            keys_stay=spec.keys_stay,
            index=KeyIndex(table, spec.keys, spec.null_safe) if spec.indexed else None,
            content=[c for c in batch.columns if c not in STAMPS] if spec.skips_unchanged else (),
        )
    else:
        table.replace_partitions(staged, where={"_execution_date": day.isoformat()})
    built.note()
    duplicates = before.get["rows"] - measured["rows"] if before else None
    if duplicates:
        log.warning("%s: %d duplicates removed by %s", spec.path, duplicates, spec.keys)
    return RunResult(
        spec.path, "loaded", measured["rows"], duplicates, warnings, tuple(rewritten)
    )


def _store_report(lake: Lake, spec: TableSpec, measured: Row, day: dt.date) -> None:
    """Keep the check results: one partition per table and run date."""
    if not spec.rules:
        log.warning("%s: no rules declared", spec.path)
        return
    counts = lake.spark.createDataFrame(
        [tuple(measured[c] for c in _count_columns(spec))],
        ", ".join(
            f"{c} {'double' if c.startswith('share_') else 'long'}" for c in _count_columns(spec)
        ),
    )
    results = report(counts, spec.rules, day).withColumn("table_path", F.lit(spec.path))
    overwrite_partitions(
        results.coalesce(1), lake.quality_path, ["table_path", "_execution_date"]
    )


def _count_columns(spec: TableSpec) -> list[str]:
    shares = [f"share_{i}" for i, rule in enumerate(spec.rules) if rule.kind == "isUnique"]
    return ["rows", *[f"rule_{i}" for i in range(len(spec.rules))], *shares]


def run_all(
    lake: Lake, day: dt.date, tables: Iterable[TableSpec] = ALL_TABLES
) -> list[RunResult]:
    """Load tables in layer order; the first failure stops the run."""
    return [run(lake, spec, day) for spec in tables]


__all__ = ["ALL_TABLES", "QualityError", "RunResult", "find_table", "run", "run_all"]
