"""Check results of a whole stored table, kept by partition and added up."""

from __future__ import annotations

import datetime as dt
import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quality import Rule, report
from millrace.session import session_conf
from millrace.sources.files import input_bytes, matching
from millrace.sources.tables import SnapshotTable

LOAD = "_load"
#: Bytes of files for each partition that values are counted in.
PIECE = 8 << 20


class CheckState:
    """What each partition of a table contributes to its rules.

    A partition's state is its rows, the violations of each rule, and for rules of
    uniqueness how often it holds each value. States add up to the report of the whole table,
    exactly: a value that is in two partitions is found by adding its counts. They belong
    to a partition's snapshot, which never changes, so a later run reads only the
    partitions that are new or were rewritten. State of other rules is kept apart.

    Counts are written after the values of the same load; values whose counts are
    missing were left by a run that failed, and do not count.
    """

    def __init__(self, table: SnapshotTable, rules: Sequence[Rule]):
        self.table, self.rules, self.spark = table, tuple(rules), table.spark
        suite = zlib.crc32("\n".join(rule.label for rule in rules).encode())
        self.path = f"{table.path}/_checks/{suite:08x}"
        self.unique = [i for i, rule in enumerate(self.rules) if rule.kind == "isUnique"]
        self.plain = [i for i in range(len(self.rules)) if i not in self.unique]

    def _read(self, name: str, schema: str) -> DataFrame:
        if not matching(self.spark, f"{self.path}/{name}/{LOAD}=*"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def counts(self) -> DataFrame:
        """One row for each partition and snapshot that was looked at."""
        numbers = "".join(f", rule_{i} long" for i in self.plain)
        held = self._read("counts", f"part string, snapshot string, rows long{numbers}, {LOAD} string")
        return held.dropDuplicates(["part", "snapshot"])

    def _current(self) -> DataFrame:
        manifest = self.table.manifest()
        parts = sorted(manifest.parts.items()) if manifest else []
        return self.spark.createDataFrame(parts, "part string, snapshot string")

    def refresh(self) -> list[str]:
        """Look at the partitions that have no state yet; returns their folders."""
        missing = self._current().join(self.counts(), ["part", "snapshot"], "left_anti").collect()
        if not missing:
            return []
        manifest, load = self.table.manifest(), uuid.uuid4().hex
        parts = [r["part"] for r in missing]
        # The folder as the table names it, by the folder as addresses of files spell it.
        names = self.spark.createDataFrame(list(map(tuple, missing)), "part string, snapshot string")
        rows = self.table.read_with_parts(manifest, parts)
        decoded = F.url_decode(F.replace("_part", F.lit("+"), F.lit("%2B")))
        spelt = F.when(F.contains("_part", F.lit("%")), decoded).otherwise(F.col("_part"))
        rows = rows.withColumn("_part", spelt)
        if self.unique:
            each = F.explode(
                F.array(*[
                    F.struct(F.lit(i).alias("rule"), F.col(self.rules[i].column).cast("string").alias("value"))
                    for i in self.unique
                ])
            )
            values = rows.select("_part", each.alias("e")).select("_part", "e.*").filter("value IS NOT NULL")
            values = values.groupBy("_part", "rule", "value").agg(F.count(F.lit(1)).alias("n"))
            with session_conf(self.spark, self._small_tasks(rows)):
                self._write(values, names, "values", load)
        counted = rows.groupBy("_part").agg(
            F.count(F.lit(1)).alias("rows"),
            *[self.rules[i].violations().alias(f"rule_{i}") for i in self.plain],
        )
        self._write(counted, names, "counts", load)
        return sorted(parts)

    def _small_tasks(self, rows: DataFrame) -> dict[str, str]:
        """Settings with which a task holds the values of few rows, however many there are.

        A value is often in one row only, so that neither side of the shuffle has fewer
        values to hold than rows. Adaptive execution merges what are too small partitions.
        """
        number = self._pieces(rows)
        if not number:
            return {}
        return {
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(number),
            "spark.sql.files.maxPartitionBytes": str(2 * PIECE),
        }

    def _pieces(self, rows: DataFrame) -> int:
        """Partitions by the size of the rows' files; 0 if the session's own number is enough."""
        number = input_bytes(rows) // PIECE
        return number if number > int(self.spark.conf.get("spark.sql.shuffle.partitions")) else 0

    def _write(self, state: DataFrame, names: DataFrame, name: str, load: str) -> None:
        # The list of partitions comes from the driver; a shuffle by it would make a task of each.
        named = F.broadcast(names).join(state.withColumnRenamed("_part", "part"), "part")
        target = f"{self.path}/{name}/{LOAD}={load}"
        named.write.mode("overwrite").parquet(target)

    def measured(self) -> DataFrame:
        """The row that ``quality.measure`` gives for the whole table, from the states."""
        held = self.counts().join(self._current(), ["part", "snapshot"], "left_semi")
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", *(f"rule_{i}" for i in self.plain))]
        total = held.agg(*sums)
        schema = f"part string, snapshot string, rule int, value string, n long, {LOAD} string"
        values = self._read("values", schema)
        number = self._pieces(values)
        values = values.join(held, ["part", "snapshot", LOAD], "left_semi")
        if number:  # a value is there once for each partition at most, so none is hot
            values = values.select("rule", "value", "n").repartition(number, "value")
        values = values.groupBy("rule", "value").agg(F.sum("n").alias("n"))
        for i in self.unique:
            known = F.sum("n")
            one = values.filter(F.col("rule") == i).agg(
                F.coalesce(known - F.count(F.lit(1)), F.lit(0)).alias(f"rule_{i}"),
                F.coalesce(F.count_if(F.col("n") == 1) / F.nullif(known, F.lit(0)), F.lit(1.0)).alias(f"share_{i}"),
            )
            total = total.join(F.broadcast(one))  # one row each
        return total

    def report(self, day: dt.date) -> DataFrame:
        """The report of the whole table, after a look at what is new."""
        self.refresh()
        return report(self.measured(), self.rules, day)
