"""Whether partitions of a batch say the same as those of a table, in any order of rows."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "_part"


SUMS = ("first_high", "first_low", "second_high", "second_low")


def row_hash64(columns: Sequence[str], salt: str) -> Column:
    """A 64-bit hash of a row's columns in which NULL differs from any value."""
    values = [part for c in columns for part in (F.col(c).isNull(), F.col(c))]
    return F.xxhash64(F.lit(salt), *values)


def checksums(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each partition folder, its rows and two sums of row hashes.

    Sums do not depend on the order of rows, and repeated rows do not cancel out; they
    are aggregated before the shuffle, to one row a task and partition. Each sum is
    that of the high and that of the low 32 bits, as longs, which are added far faster than
    decimals and stay exact up to two thousand million rows; beyond, a sum is NULL,
    which equals nothing.
    """
    hashed = rows.select(
        PART, row_hash64(columns, "a").alias("first"), row_hash64(columns, "b").alias("second")
    )
    halves = [
        half
        for c in ("first", "second")
        for half in (F.shiftright(c, 32), F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)))
    ]
    return hashed.groupBy(PART).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.try_sum(half).alias(name) for half, name in zip(halves, SUMS)],
    )


def equal_parts(one: DataFrame, other: DataFrame, columns: Sequence[str]) -> set[str]:
    """Partition folders that hold the same rows on both sides; one row each is collected."""
    sums = [checksums(df, columns) for df in (one, other)]
    same = sums[0].join(sums[1], [PART, "rows", *SUMS]).select(PART)
    return {unquote(r[0]) for r in same.collect()}
