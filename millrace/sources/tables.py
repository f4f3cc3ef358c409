"""Snapshot tables: partitioned parquet with an atomic pointer.

A table is a folder of ``_snapshot=<id>`` folders, each in Hive layout, and
numbered manifests that say which snapshot holds each partition. A load
writes a new snapshot, then publishes it by creating the next manifest:
readers see the old table or the new one, and partitions a load does not
touch are neither read nor written.
"""

from __future__ import annotations

import datetime as dt
import json
import posixpath
import uuid
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import TYPE_CHECKING
from urllib.parse import unquote

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.merge import GUARD, key_match, upsert
from millrace.sources.checksums import equal_parts
from millrace.sources.files import create_text, delete_tree, matching, read_text

if TYPE_CHECKING:
    from millrace.sources.key_index import KeyIndex

_SNAPSHOT = "_snapshot"


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    partition_by: tuple[str, ...]
    # Partition folder ("" for an unpartitioned table) -> snapshot id.
    parts: Mapping[str, str]

    def to_json(self) -> str:
        return json.dumps(
            {
                "version": self.version,
                "schema": json.loads(self.schema.json()),
                "partition_by": list(self.partition_by),
                "parts": dict(self.parts),
            }
        )

    @classmethod
    def from_json(cls, text: str) -> "Manifest":
        raw = json.loads(text)
        return cls(
            raw["version"],
            T.StructType.fromJson(raw["schema"]),
            tuple(raw["partition_by"]),
            raw["parts"],
        )


@dataclass(frozen=True)
class Staged:
    """A batch written as a snapshot of its own, not yet part of the table."""

    snapshot: str
    schema: T.StructType
    partition_by: tuple[str, ...]
    parts: tuple[str, ...]


def _in_partition(part: str, where: Mapping[str, object]) -> bool:
    """Whether a partition folder can hold rows with the given column values."""
    values = dict(s.split("=", 1) for s in part.split("/") if s)
    return all(
        unquote(values[c]) in map(str, v if isinstance(v, (list, tuple)) else [v])
        for c, v in where.items()
        if c in values
    )


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # -- state -----------------------------------------------------------

    def _manifests(self) -> list[str]:
        return sorted(matching(self.spark, f"{self.path}/_manifest/*.json"))

    def manifest(self) -> Manifest | None:
        found = self._manifests()
        return Manifest.from_json(read_text(self.spark, found[-1])) if found else None

    def exists(self) -> bool:
        return bool(self._manifests())

    # -- read ------------------------------------------------------------

    def read(self, where: Mapping[str, object] | None = None) -> DataFrame:
        """The current table; ``where`` keeps rows with the given values (or one of a list).

        Values of partition columns select folders before anything is listed.
        """
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no table at {self.path}")
        where = where or {}
        parts = [p for p in manifest.parts if _in_partition(p, where)]
        df = self._read_parts(manifest, parts)
        for column, value in where.items():
            several = isinstance(value, (list, tuple))
            df = df.filter(F.col(column).isin(*value) if several else F.col(column) == F.lit(value))
        return df

    def _folder(self, snapshot: str, part: str) -> str:
        folder = f"{self.path}/{_SNAPSHOT}={snapshot}"
        return f"{folder}/{part}" if part else folder

    def _load(
        self, schema: T.StructType, folders: Sequence[str], file_column: str | None = None
    ) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        files = self.spark.read.schema(schema).option("basePath", self.path)
        extra = [F.col("_metadata.file_path").alias(file_column)] if file_column else []
        return files.parquet(*folders).select(*schema.names, *extra)

    def _read_parts(
        self, manifest: Manifest, parts: Collection[str], file_column: str | None = None
    ) -> DataFrame:
        folders = [self._folder(manifest.parts[p], p) for p in sorted(parts)]
        return self._load(manifest.schema, folders, file_column)

    def read_with_parts(self, manifest: Manifest, parts: Collection[str]) -> DataFrame:
        """Rows of some partitions with the folder of each as ``_part``, as in file addresses."""
        return self._with_part(self._read_parts(manifest, parts, "_file"), manifest.partition_by)

    def read_staged_with_parts(self, staged: Staged) -> DataFrame:
        folders = [self._folder(staged.snapshot, p) for p in staged.parts]
        return self._with_part(self._load(staged.schema, folders, "_file"), staged.partition_by)

    @staticmethod
    def _with_part(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
        depth = len(partition_by)
        if "_file" not in df.columns or not depth:  # no folders, so no files
            return df.withColumn("_part", F.lit("")).drop("_file")
        # The folders above the file's name, cut out for each row: a regular expression
        # takes several times as long as reading the row.
        part = F.substring_index(F.substring_index("_file", "/", -depth - 1), "/", depth)
        return df.withColumn("_part", part).drop("_file")

    # -- write -----------------------------------------------------------

    def stage(
        self,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        constant: Sequence[str] = (),
    ) -> Staged:
        """Write a batch beside the table. Nothing changes for readers.

        Rows are rebalanced by the partition columns into few, well-sized
        files: adaptive execution merges small shuffle blocks and splits those
        of a hot partition. Columns known to be ``constant`` in the batch need
        no such shuffle.
        """
        snapshot = f"s-{uuid.uuid4().hex}"
        folder = self._folder(snapshot, "")
        varying = [c for c in partition_by if c not in constant]
        write = (df.hint("rebalance", *varying) if varying else df).write.mode("overwrite")
        if partition_by:
            write = write.partitionBy(*partition_by)
        write.parquet(folder)
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        parts = ("",)
        if partition_by:
            found = matching(self.spark, posixpath.join(folder, *["*=*"] * len(partition_by)))
            marker = f"{_SNAPSHOT}={snapshot}/"
            parts = tuple(p.split(marker, 1)[1] for p in found)
        return Staged(snapshot, schema, tuple(partition_by), parts)

    def discard(self, staged: Staged) -> None:
        """Delete a batch that will not be published."""
        delete_tree(self.spark, self._folder(staged.snapshot, ""))

    def read_staged(self, staged: Staged) -> DataFrame:
        return self._load(
            staged.schema, [self._folder(staged.snapshot, p) for p in staged.parts]
        )

    def _publish(
        self, staged: Staged, parts: Mapping[str, str], previous: Manifest | None
    ) -> None:
        version = previous.version + 1 if previous else 1
        manifest = Manifest(version, staged.schema, staged.partition_by, parts)
        create_text(
            self.spark, f"{self.path}/_manifest/{version:010d}.json", manifest.to_json()
        )

    def replace(self, staged: Staged) -> None:
        """The staged batch becomes the whole table."""
        self._publish(staged, {p: staged.snapshot for p in staged.parts}, self.manifest())

    def replace_partitions(
        self, staged: Staged, where: Mapping[str, object] | None = None
    ) -> None:
        """The staged partitions replace those of the same name.

        ``where`` also removes partitions the batch no longer fills.
        """
        previous = self.manifest()
        kept = {}
        if previous:
            self._require_same_shape(previous, staged)
            kept = {
                p: s
                for p, s in previous.parts.items()
                if not (where and _in_partition(p, where))
            }
        kept.update({p: staged.snapshot for p in staged.parts})
        self._publish(staged, kept, previous)

    def merge(
        self,
        staged: Staged,
        keys: Sequence[str],
        *,
        null_safe: Sequence[str] = (),
        replace_day: dt.date | None = None,
        use_row_hash: bool = False,
        key_ranges: Mapping[str, tuple] | None = None,
        keys_stay: bool = False,
        index: "KeyIndex | None" = None,
        content: Sequence[str] = (),
    ) -> list[str]:
        """Upsert a staged batch; returns the partitions that were rewritten.

        Only partitions that hold a matching key, or that the batch falls in,
        are read and rewritten; the others keep their snapshot. Matching keys
        are looked for in a scan of the key columns alone, narrowed by
        ``key_ranges`` (lowest and highest key of the batch). With
        ``keys_stay`` the caller states that a key never changes partition,
        and the scan is saved. An ``index`` of the keys leaves the scan only the
        partitions that it names; the batch is entered into it while the partitions are
        rewritten, and before the table shows it.

        With ``content`` a row replaces its match only if it differs in these columns, and
        a partition of the batch that holds the very rows of the table's is not
        merged at all: keys are unique, so its keys are nowhere else.
        """
        previous = self.manifest()
        if previous and content:
            self._require_same_shape(previous, staged)
            both = set(staged.parts) & set(previous.parts)
            same = equal_parts(
                self.read_staged_with_parts(replace(staged, parts=tuple(sorted(both)))),
                self.read_with_parts(previous, both),
                content,
            )
            staged = replace(staged, parts=tuple(p for p in staged.parts if p not in same))
            if not staged.parts:
                self.discard(staged)
                return []
        if previous is None:
            if index:
                index.add(staged, 1)
            self.replace(staged)
            return []
        self._require_same_shape(previous, staged)
        if index:
            index.cover(previous)
        source = self.read_staged(staged)

        base = dict(previous.parts)
        if replace_day is not None:
            if GUARD not in previous.partition_by:
                raise ValueError("replace-by-date needs tables partitioned by run date")
            day = {GUARD: replace_day.isoformat()}
            base = {p: s for p, s in base.items() if not _in_partition(p, day)}
        kept = Manifest(previous.version, previous.schema, previous.partition_by, base)

        touched = set(staged.parts) & set(base)
        if previous.partition_by and set(base) - touched and not keys_stay:
            candidates = set(base) - touched
            if index:
                candidates &= index.parts_of(source)
            touched |= self._matched_parts(
                kept, candidates, source, keys, null_safe, key_ranges or {}
            )
        result = staged
        # Neither needs the other, and each leaves cores idle while its last tasks run.
        with ThreadPoolExecutor(1, thread_name_prefix="index") as beside:
            if index:
                enter = inheritable_thread_target(self.spark)(index.add)
                entered = beside.submit(enter, staged, previous.version + 1)
            if touched:
                merged = upsert(
                    self._read_parts(kept, touched),
                    source,
                    keys,
                    null_safe=null_safe,
                    use_row_hash=use_row_hash,
                    content=content,
                )
                result = self.stage(merged, previous.partition_by)
            if index:
                entered.result()
        parts = {p: s for p, s in base.items() if p not in touched}
        parts.update({p: result.snapshot for p in result.parts})
        self._publish(result, parts, previous)
        return sorted(touched)

    def _matched_parts(
        self,
        kept: Manifest,
        candidates: Collection[str],
        source: DataFrame,
        keys: Sequence[str],
        null_safe: Sequence[str],
        key_ranges: Mapping[str, tuple],
    ) -> set[str]:
        """Partition folders with a row whose key is in the source.

        The answer has at most one row per partition folder.
        """
        if not candidates:
            return set()
        probe = self.read_with_parts(kept, candidates)
        for key, (low, high) in key_ranges.items():
            if low is not None and key not in null_safe:
                probe = probe.filter(F.col(key).between(F.lit(low), F.lit(high)))
        folders = (
            probe.select(*keys, "_part").alias("t")
            .join(
                source.select(*keys).alias("s"),
                key_match("t", "s", keys, null_safe),
                "left_semi",
            )
            .select("_part")
            .distinct()
        )
        return {unquote(row[0]) for row in folders.collect()}

    @staticmethod
    def _require_same_shape(previous: Manifest, staged: Staged) -> None:
        def shape(schema: T.StructType) -> dict[str, str]:
            return {f.name: f.dataType.simpleString() for f in schema}

        if shape(previous.schema) != shape(staged.schema):
            raise ValueError(
                f"batch columns {shape(staged.schema)} differ from the table's "
                f"{shape(previous.schema)}"
            )
        if previous.partition_by != staged.partition_by:
            raise ValueError("batch and table are partitioned differently")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete snapshots that none of the last ``keep`` manifests uses."""
        used = {
            snapshot
            for path in self._manifests()[-keep:]
            for snapshot in Manifest.from_json(read_text(self.spark, path)).parts.values()
        }
        stale = [
            path
            for path in matching(self.spark, f"{self.path}/{_SNAPSHOT}=*")
            if path.rsplit("=", 1)[1] not in used
        ]
        for path in stale:
            delete_tree(self.spark, path)
        return stale


def key_bounds(keys: Sequence[str]) -> list:
    """Extra aggregates for ``measure``: lowest and highest value of each key."""
    return [
        aggregate
        for key in keys
        for aggregate in (F.min(key).alias(f"low_{key}"), F.max(key).alias(f"high_{key}"))
    ]


def key_ranges(measured: Row, keys: Sequence[str]) -> dict[str, tuple]:
    return {key: (measured[f"low_{key}"], measured[f"high_{key}"]) for key in keys}
