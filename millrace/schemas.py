"""Declared schemas: nothing is inferred at the edge."""

from __future__ import annotations

from pyspark.sql import types as T

# What a topic delivers.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("firmware_version", T.StringType()),
        T.StructField("battery_level", T.IntegerType()),
        T.StructField("signal_strength", T.IntegerType()),
    ]
)

# Bronze event lines. Wire values stay text or number as sent; silver casts.
BRONZE_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("sensor_id", T.StringType()),
        T.StructField("equipment_id", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("unit", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("quality", T.StringType()),
        T.StructField("is_anomaly", T.BooleanType()),
        T.StructField("metadata", METADATA),
        T.StructField("_ingested_at", T.StringType()),
        T.StructField("_kafka_offset", T.LongType()),
        T.StructField("_kafka_partition", T.IntegerType()),
        T.StructField("_kafka_topic", T.StringType()),
        T.StructField("_kafka_key", T.StringType()),
        T.StructField("factory_id", T.StringType()),
        T.StructField("measurement_type", T.StringType()),
        T.StructField("dt", T.DateType()),
    ]
)

EQUIPMENT_DOCUMENT = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField(
            "factory",
            T.StructType(
                [
                    T.StructField("id", T.StringType()),
                    T.StructField("name", T.StringType()),
                    T.StructField(
                        "location",
                        T.StructType(
                            [
                                T.StructField("lat", T.DoubleType()),
                                T.StructField("lng", T.DoubleType()),
                            ]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField(
            "sensors",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("id", T.StringType()),
                        T.StructField("type", T.StringType()),
                        T.StructField(
                            "range",
                            T.StructType(
                                [
                                    T.StructField("min", T.DoubleType()),
                                    T.StructField("max", T.DoubleType()),
                                ]
                            ),
                        ),
                    ]
                )
            ),
        ),
        T.StructField("maintenance_schedule", T.StringType()),
        T.StructField("installed_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)
