"""Keyed upsert as a join expression."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GUARD = "_execution_date"
ROW_HASH = "_row_hash"

_RANK = "_key_rank"


def row_hash(columns: Sequence[str]) -> Column:
    """Digest of the named columns. JSON keeps NULLs and names apart."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job if two rows share a key.

    Partitioned like the join that follows, so it adds no shuffle to it.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1)))
    ranked = df.withColumn(_RANK, rank).filter(
        F.when(
            (F.col(_RANK) > 1) & known,
            F.raise_error(F.lit(f"several source rows share the key {list(keys)}")),
        ).otherwise(F.lit(True))
    )
    # Ranks start at 1, so this changes no value. It keeps a key that is one
    # literal in the whole source (a run date) from being folded out of the
    # join, which would then match on the remaining keys alone.
    return ranked.select(
        *[
            F.when(F.col(_RANK) > 0, F.col(c)).alias(c) if c in keys else F.col(c)
            for c in df.columns
        ]
    )


def key_match(
    left: str, right: str, keys: Sequence[str], null_safe: Sequence[str] = ()
) -> Column:
    def one(key: str) -> Column:
        a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        return a.eqNullSafe(b) if key in null_safe else a == b

    return reduce(lambda a, b: a & b, [one(k) for k in keys])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    null_safe: Sequence[str] = (),
    use_row_hash: bool = False,
    content: Sequence[str] = (),
) -> DataFrame:
    """Target after the source has been merged into it.

    A source row replaces its match unless it is older (``_execution_date``)
    or the guard is NULL; with ``use_row_hash`` it must also differ in
    ``_row_hash``, with ``content`` in one of these columns. Rows without a match are kept from either side. Keys
    compare as in SQL, so a NULL key matches nothing unless ``null_safe``.
    Repeated source keys fail the job.
    """
    missing = set(target.columns) - set(source.columns)
    if missing:
        raise ValueError(f"source lacks target columns: {sorted(missing)}")
    # NULL keys match nothing: those rows go round the join, where all of them
    # would be one group.
    strict = [k for k in keys if k not in null_safe]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in strict], F.lit(True))
    loose = [df.filter(~whole).select(*target.columns) for df in (target, source) if strict]
    target, source = target.filter(whole), require_unique(source.filter(whole), keys)
    newer = F.col(f"s.{GUARD}") >= F.col(f"t.{GUARD}")
    if use_row_hash:
        newer = newer & ~F.col(f"s.{ROW_HASH}").eqNullSafe(F.col(f"t.{ROW_HASH}"))
    if content:
        same = [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in content]
        newer = newer & ~reduce(lambda a, b: a & b, same)
    take_source = F.col("t._in_target").isNull() | (
        F.col("s._in_source").isNotNull() & F.coalesce(newer, F.lit(False))
    )
    joined = (
        target.withColumn("_in_target", F.lit(True)).alias("t")
        .join(
            source.withColumn("_in_source", F.lit(True)).alias("s"),
            key_match("t", "s", keys, null_safe),
            "full_outer",
        )
    )
    merged = joined.select(
        *[
            F.when(take_source, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
            for c in target.columns
        ]
    )
    return reduce(DataFrame.unionByName, loose, merged)


def replace_date(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    day: dt.date,
    null_safe: Sequence[str] = (),
) -> DataFrame:
    """Drop the target rows of a run date, then upsert the source."""
    other_days = target.filter(~F.col(GUARD).eqNullSafe(F.lit(day)))
    return upsert(other_days, source, keys, null_safe=null_safe)
