"""Plain parquet folders: append, overwrite, replace partitions, dry run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def append_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; writing twice changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def dry_run(df: DataFrame, *metrics: Column) -> dict:
    """Run a plan without writing, and return what it counted."""
    observation = Observation()
    observed = df.observe(observation, F.count(F.lit(1)).alias("rows"), *metrics)
    observed.write.format("noop").mode("overwrite").save()
    return observation.get
