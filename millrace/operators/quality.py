"""Data-quality rules as plain aggregates.

A suite of rules is one aggregate over the data, turned into one result row
per rule. Error rules stop a load, warning rules are reported.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from enum import Enum
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


class Level(str, Enum):
    ERROR = "Error"
    WARNING = "Warning"


class QualityError(RuntimeError):
    """At least one Error rule failed."""


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    level: Level = Level.ERROR
    argument: tuple | str | None = None

    @property
    def label(self) -> str:
        if self.argument is None:
            return f"{self.kind}({self.column})"
        shown = (
            self.argument
            if isinstance(self.argument, str)
            else "[" + ",".join(str(v) for v in self.argument) + "]"
        )
        return f"{self.kind}({self.column},{shown})"

    def violations(self) -> Column:
        """Aggregate: how many rows break the rule. NULL breaks only ``isComplete``."""
        column = F.col(self.column)
        if self.kind == "isComplete":
            return F.count_if(column.isNull())
        if self.kind == "isContainedIn":
            return F.count_if(~column.isin(*self.argument))
        if self.kind == "isNonNegative":
            return F.count_if(column < 0)
        if self.kind == "hasDataType":
            return F.count_if(
                column.isNotNull() & column.try_cast(self.argument).isNull()
            )
        raise ValueError(f"unknown rule: {self.kind}")


def complete(*columns: str, level: Level = Level.ERROR) -> tuple[Rule, ...]:
    return tuple(Rule("isComplete", c, level) for c in columns)


def unique(column: str, level: Level = Level.ERROR) -> Rule:
    return Rule("isUnique", column, level)


def contained_in(column: str, values: Iterable, level: Level = Level.ERROR) -> Rule:
    return Rule("isContainedIn", column, level, tuple(values))


def non_negative(column: str, level: Level = Level.ERROR) -> Rule:
    return Rule("isNonNegative", column, level)


def has_type(column: str, type_name: str, level: Level = Level.ERROR) -> Rule:
    return Rule("hasDataType", column, level, type_name)


def measure(
    df: DataFrame, rules: Sequence[Rule], extra: Sequence[Column] = ()
) -> DataFrame:
    """One row: ``rows``, a violation count per rule, and any extra aggregates.

    All rules are one aggregate, but for those of uniqueness: each counts the
    values of its column alone, which reads that column and no other. They
    add ``share_<i>``, how many of the known values occur once.
    """
    unique_ones = {i: rule for i, rule in enumerate(rules) if rule.kind == "isUnique"}
    counts = [
        rule.violations().alias(f"rule_{i}")
        for i, rule in enumerate(rules)
        if i not in unique_ones
    ]
    parts = [df.agg(F.count(F.lit(1)).alias("rows"), *counts, *extra)]
    for i, rule in unique_ones.items():
        known = df.select(F.col(rule.column).alias("v")).filter("v IS NOT NULL")
        values, known = known.groupBy("v").agg(F.count(F.lit(1)).alias("n")), F.sum("n")
        parts.append(
            values.agg(
                F.coalesce(known - F.count(F.lit(1)), F.lit(0)).alias(f"rule_{i}"),
                F.coalesce(F.count_if(F.col("n") == 1) / F.nullif(known, F.lit(0)), F.lit(1.0))
                .alias(f"share_{i}"),
            )
        )
    if len(parts) == 1:
        return parts[0]
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # one row of each part, so that every column has one value
    return joined.agg(*[F.max(c).alias(c) for c in joined.columns])


def report(measured: DataFrame, rules: Sequence[Rule], day: dt.date) -> DataFrame:
    """Unpivot a measured row to one result row per rule."""

    def result(i: int, rule: Rule) -> Column:
        broken = F.col(f"rule_{i}")
        share = F.lit(1.0) - broken / F.greatest(F.col("rows"), F.lit(1))
        kept = (F.col(f"share_{i}") if rule.kind == "isUnique" else share).cast("decimal(7,6)")
        return F.struct(
            F.lit(rule.label).alias("constraint"),
            F.lit(rule.level.value).alias("check_level"),
            F.when(broken == 0, "Success").otherwise("Failure").alias("constraint_status"),
            F.when(broken == 0, "")
            .otherwise(
                F.concat(
                    F.lit("Value: "),
                    kept.cast("string"),
                    F.lit(" does not meet the constraint requirement!"),
                )
            )
            .alias("constraint_message"),
            broken.alias("violations"),
            F.col("rows").alias("rows"),
        )

    results = F.array(*[result(i, rule) for i, rule in enumerate(rules)])
    return measured.select(F.inline(results)).withColumns(
        {"_execution_date": F.lit(day), "_processed_at": F.current_timestamp()}
    )


def evaluate(df: DataFrame, rules: Sequence[Rule], day: dt.date) -> DataFrame:
    """The result table of a suite; empty suites are the caller's business."""
    return report(measure(df, rules), rules, day)


def failures(results: DataFrame, level: Level | None = None) -> DataFrame:
    failed = results.filter(F.col("constraint_status") != "Success")
    return failed if level is None else failed.filter(F.col("check_level") == level.value)


def broken_rules(measured: Row, rules: Sequence[Rule], level: Level) -> list[str]:
    """Labels of the failed rules of one level, from a collected measured row."""
    return [
        rule.label
        for i, rule in enumerate(rules)
        if rule.level is level and measured[f"rule_{i}"]
    ]


def gate(measured: Row, rules: Sequence[Rule]) -> None:
    """Raise if an Error rule failed."""
    broken = broken_rules(measured, rules, Level.ERROR)
    if broken:
        raise QualityError(f"quality rules failed: {', '.join(broken)}")
