"""Where the keys of a stored table are: an index beside it, in buckets of key hashes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.tables import Manifest, SnapshotTable, Staged

BUCKET, LOAD = "_bucket", "_load"


def known_keys(keys: Sequence[str], null_safe: Sequence[str]) -> Column:
    """Whether a row's key can match another's."""
    strict = [F.col(k).isNotNull() for k in keys if k not in null_safe]
    return reduce(lambda a, b: a & b, strict, F.lit(True))


class KeyIndex:
    """Which partitions each key of a table was ever loaded into.

    An upsert by keys that say nothing about their partition would have to look
    for them in all history. The index holds a 64-bit hash of each key and the
    partition it went to, in folders by bucket of the hash. A batch reads the
    buckets of its own keys, and then the key columns of the partitions found there; the
    data of all others is left alone.

    It errs on the side of too much: a key that has moved is still listed in its
    old partition, and two keys may share a hash, so what it names is looked at
    before it is rewritten. It never names too little: a load is entered before
    the table shows it, under the version it is going to have, and an index that is behind
    the table (older than it, or written past it) is built anew from the table.
    Entries of ``most_loads`` loads are merged into one.
    """

    def __init__(
        self,
        table: SnapshotTable,
        keys: Sequence[str],
        null_safe: Sequence[str] = (),
        buckets: int = 64,
        most_loads: int = 8,
    ):
        self.owner, self.keys, self.null_safe = table, tuple(keys), tuple(null_safe)
        self.buckets, self.most_loads = buckets, most_loads
        self.table = SnapshotTable(table.spark, f"{table.path}/_keys")

    def _hashed(self, df: DataFrame) -> DataFrame:
        key = F.xxhash64(*[F.col(k).cast("string") for k in self.keys])
        return df.filter(known_keys(self.keys, self.null_safe)).withColumn("_key", key)

    def _bucket(self) -> Column:
        return F.pmod("_key", F.lit(self.buckets)).cast("int")

    def _loads(self) -> set[int]:
        manifest = self.table.manifest()
        parts = manifest.parts if manifest else ()
        return {int(p.rsplit(f"{LOAD}=", 1)[1]) for p in parts}

    def _entries(self, rows: DataFrame, version: int) -> DataFrame:
        """Keys and partitions of rows that carry their folder as ``_part``.

        One for each row: keys of a load are unique, so looking for repeated ones would
        shuffle all entries once more to find none.
        """
        return self._hashed(rows).select(
            "_key", "_part", self._bucket().alias(BUCKET), F.lit(version).alias(LOAD)
        )

    def _stage(self, entries: DataFrame) -> Staged:
        return self.table.stage(entries, (BUCKET, LOAD), constant=[LOAD])

    def cover(self, current: Manifest) -> None:
        """Build the index anew if the table has loads that it lacks."""
        if max(self._loads(), default=0) < current.version:
            rows = self.owner.read_with_parts(current, current.parts)
            self.table.replace(self._stage(self._entries(rows, current.version)))

    def add(self, staged: Staged, version: int) -> None:
        """Enter a staged batch that is about to become a version of the table."""
        entries = self._stage(self._entries(self.owner.read_staged_with_parts(staged), version))
        if entries.parts:
            self.table.replace_partitions(entries)
        else:
            self.table.discard(entries)
        if len(self._loads()) > self.most_loads:
            whole = self.table.read().withColumn(LOAD, F.lit(version)).distinct()
            self.table.replace(self._stage(whole))
            self.table.vacuum()

    def parts_of(self, source: DataFrame) -> set[str]:
        """Partitions that may hold a key of the source; at most one row each is collected."""
        wanted = self._hashed(source).select("_key", self._bucket().alias(BUCKET))
        buckets = sorted(r[0] for r in wanted.select(BUCKET).distinct().collect())
        entries = self.table.read({BUCKET: buckets})
        found = entries.join(wanted, [BUCKET, "_key"], "left_semi").select("_part").distinct()
        return {unquote(r[0]) for r in found.collect()}

