"""The two fact aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.calendar import hour_key_of
from millrace.operators.filters import is_true

HOUR_KEYS = (
    "date_key", "sensor_id", "equipment_id", "factory_id", "measurement_type",
)
DAY_KEYS = ("data", "sensor_id", "equipment_id", "factory_id", "measurement_type")


def share(condition: Column) -> Column:
    """Part of the rows that meet a condition, 0.0 to 1.0; NULL does not meet it."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def hourly_metrics(events: DataFrame) -> DataFrame:
    """Statistics per sensor and hour. Hash aggregate, combined map-side."""
    return (
        events.filter(F.col("timestamp").isNotNull())
        .withColumn("date_key", hour_key_of(F.col("timestamp")))
        .groupBy(*HOUR_KEYS)
        .agg(
            F.avg("value").alias("avg_valor"),
            F.min("value").alias("min_valor"),
            F.max("value").alias("max_valor"),
            F.stddev("value").alias("stddev_valor"),
            F.count(F.lit(1)).alias("count_leituras"),
            F.count_if(is_true("is_anomaly")).alias("count_anomalias"),
            share(F.col("quality") == "good").alias("pct_qualidade_boa"),
        )
    )


def daily_anomalies(events: DataFrame) -> DataFrame:
    """Readings, anomalies and their rate per sensor and day."""
    return (
        events.filter(F.col("timestamp").isNotNull())
        .withColumn("data", F.to_date("timestamp"))
        .groupBy(*DAY_KEYS)
        .agg(
            F.count(F.lit(1)).alias("total_leituras"),
            F.count_if(is_true("is_anomaly")).alias("total_anomalias"),
            share(is_true("is_anomaly")).alias("taxa_anomalia"),
            F.max("value").alias("max_valor_dia"),
            F.min("value").alias("min_valor_dia"),
        )
    )


def with_type_ids(metrics: DataFrame, types: DataFrame) -> DataFrame:
    """Resolve ``measurement_type`` to ``tipo_medicao_id`` by name (left join).

    Joined after the aggregation: the type name is a group key, so every row
    of a group finds the same ids, and the join sees groups instead of raw
    events. No broadcast is forced: Spark broadcasts the types while their
    measured size allows it and sorts and merges beyond that.
    """
    ids = types.select(
        F.col("id").alias("tipo_medicao_id"), F.col("nome").alias("measurement_type")
    )
    return metrics.join(ids, "measurement_type", "left")
