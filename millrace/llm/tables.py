"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.session import session_conf


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


#: Shuffle files go when the statement that made them ends.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def saved(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to a shared folder and read back, which cuts its lineage."""
    with session_conf(df.sparkSession, TIDY):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(
    batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``most_bytes`` of text (one row at least)."""
    for batch in batches:
        sizes = batch.column(text).nbytes
        rows = max(1, int(batch.num_rows * most_bytes / max(sizes, 1)))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
