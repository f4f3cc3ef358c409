"""Projections: casts, flattening, renames and metadata columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a load adds to every row, which says nothing about its content.
STAMPS = ("_execution_date", "_processed_at", "_data_source")


def cast_columns(
    df: DataFrame, types: Mapping[str, str], drop: Iterable[str] = ()
) -> DataFrame:
    """Cast the named columns in one projection; the rest pass through.

    ``try_cast``: outside data that does not parse becomes NULL for the next
    filter or rule to catch, instead of failing the job.
    """
    unknown = set(types) - set(df.columns)
    if unknown:
        raise ValueError(f"columns to cast are missing: {sorted(unknown)}")
    dropped = set(drop)
    return df.select(
        *[
            F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
            for c in df.columns
            if c not in dropped
        ]
    )


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select ``{output name: source column or nested path}``."""
    return df.select(*[F.col(path).alias(name) for name, path in columns.items()])


def add_metadata(df: DataFrame, day: dt.date, source: str) -> DataFrame:
    """``_execution_date`` and ``_data_source`` if absent, ``_processed_at`` always."""
    columns = {"_processed_at": F.current_timestamp()}
    if "_execution_date" not in df.columns:
        columns["_execution_date"] = F.lit(day)
    if "_data_source" not in df.columns:
        columns["_data_source"] = F.lit(source)
    return df.withColumns(columns)
