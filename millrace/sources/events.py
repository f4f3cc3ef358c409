"""Event messages (topic or files) and bronze event lines."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import BRONZE_EVENT, MESSAGE
from millrace.sources.files import matching, read_text

# Fixed value: the topic events arrive on.
TOPIC = "iot-sensors-raw"
BATCH_COLUMN = "_batch"
#: Folder beside the lines that names the folders of every complete batch.
BATCHES = "_batches"
BATCH_FOLDERS = "factory_id string, measurement_type string, dt date, _batch int"


def topic_messages(
    spark: SparkSession,
    servers: str,
    topic: str = TOPIC,
    *,
    most: int | None = None,
    least: int | None = None,
    longest_wait: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A topic from its earliest offset. Needs the Kafka connector.

    A batch takes ``most`` messages, and starts with ``least`` or after
    ``longest_wait``. Other connector options, such as security, pass through.
    Progress lives in the query's checkpoint, not in a consumer group.
    """
    chosen = topic_options(servers, topic, most, least, longest_wait, options)
    return spark.readStream.format("kafka").options(**chosen).load().select(*MESSAGE.names)


def topic_options(
    servers: str,
    topic: str,
    most: int | None,
    least: int | None,
    longest_wait: str | None,
    options: Mapping[str, str] | None,
) -> dict[str, str]:
    given = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": most,
        "minOffsetsPerTrigger": least,
        "maxTriggerDelay": longest_wait,
    }
    return {**{k: str(v) for k, v in given.items() if v is not None}, **(options or {})}


def file_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """A folder of parquet files in the shape of a topic."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def bronze_events(
    spark: SparkSession, root: str, days: Iterable[dt.date] | None = None
) -> DataFrame:
    """Bronze event lines, all of them or those of some ``dt`` days.

    The days go into the path glob, so only their folders are listed: listing
    every folder ever written would cost more than reading one day. Factory,
    type and day come from the path and win over fields of the same name. A day
    that was compacted is read from its large files, and from the folders of
    batches that came after.
    """
    root = root.rstrip("/")
    compacted = compacted_days(spark, root, days)
    wanted = ["*"] if days is None else [day.isoformat() for day in days]
    globs = [f"{root}/factory_id=*/measurement_type=*/dt={day}" for day in wanted]
    found = [g for g in globs if matching(spark, g)]
    if not compacted:
        return _lines(spark, root, found)
    folders = [f"{path}/*" for path in found]
    loose = [f for glob in folders for f in matching(spark, glob) if not is_packed(f, compacted)]
    return _lines(spark, root, [_literal(f) for f in loose]).unionByName(
        _lines(spark, f"{root}/{COMPACTED}", packed_folders(root, compacted))
    )


def _lines(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], BRONZE_EVENT)
    lines = spark.read.schema(BRONZE_EVENT).option("basePath", base).json(paths)
    return lines.select(*BRONZE_EVENT.names)


def _literal(path: str) -> str:
    """A path that a reader of globs takes as it is."""
    return "".join(f"\\{c}" if c in "{}[]*?,\\" else c for c in path)


#: Folder beside the lines that holds the large files of compacted days.
COMPACTED, SNAPSHOT = "_compacted", "_snapshot"


@dataclass(frozen=True)
class Compacted:
    """Where a day's lines are, and the batches that are in there."""

    day: str
    version: int
    snapshot: str
    batches: frozenset[int]


def compacted_days(
    spark: SparkSession, root: str, days: Iterable[dt.date] | None = None
) -> dict[str, Compacted]:
    """The compacted ones of some days (or all), by the newest pointer of each."""
    pointers = f"{root.rstrip('/')}/{COMPACTED}/_days"
    names = ["*"] if days is None else [day.isoformat() for day in days]
    newest: dict[str, str] = {}
    for file in sorted(f for name in names for f in matching(spark, f"{pointers}/{name}/*.json")):
        newest[file.split("/")[-2]] = file
    found = {}
    for day, file in newest.items():
        raw = json.loads(read_text(spark, file))
        version = int(file.rsplit("/", 1)[1].removesuffix(".json"))
        found[day] = Compacted(day, version, raw["snapshot"], frozenset(raw["batches"]))
    return found


def is_packed(folder: str, compacted: Mapping[str, Compacted]) -> bool:
    """Whether a batch's folder is in the large files of its day."""
    day, batch = (name.split("=", 1)[-1] for name in folder.rstrip("/").split("/")[-2:])
    return day in compacted and batch.isdigit() and int(batch) in compacted[day].batches


def packed_folders(root: str, compacted: Mapping[str, Compacted]) -> list[str]:
    return [f"{root}/{COMPACTED}/{SNAPSHOT}={c.snapshot}" for c in compacted.values()]


def batch_folders(
    spark: SparkSession, root: str, until: dt.date | None = None, after: int = -1
) -> DataFrame:
    """Day and folders of the complete batches later than ``after``.

    A batch is listed once all its lines are there, so a reader never takes half
    of one.
    """
    path = f"{root.rstrip('/')}/{BATCHES}"
    if not matching(spark, f"{path}/{BATCH_COLUMN}=*"):
        return spark.createDataFrame([], BATCH_FOLDERS)
    found = spark.read.schema(BATCH_FOLDERS).parquet(path).filter(F.col(BATCH_COLUMN) > after)
    return found if until is None else found.filter(F.col("dt") <= F.lit(until))


# Characters that names of partition folders hold as % and two hex digits.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f" + "".join(map(chr, range(1, 32)))
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def folder_name(column: str, value: object) -> str:
    """The name of the folder of a partition's value."""
    text = "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in str(value))
    return f"{column}={text or NO_VALUE}"


def events_of_folders(
    spark: SparkSession, root: str, folders: Iterable[tuple[str, str, dt.date, int]]
) -> DataFrame:
    """Bronze event lines of some batches' folders; nothing else is listed."""
    root = root.rstrip("/")
    columns = ("factory_id", "measurement_type", "dt", BATCH_COLUMN)
    wanted = ["/".join(map(folder_name, columns, values)) for values in folders]
    compacted = compacted_days(spark, root)
    loose = [f"{root}/{w}" for w in wanted if not is_packed(w, compacted)]
    # What was packed meanwhile is read with the rest of its day.
    packed = {
        f"{root}/{COMPACTED}/{SNAPSHOT}={compacted[day].snapshot}/{folder}"
        for w in wanted
        if is_packed(w, compacted)
        for folder in [w.rsplit("/", 1)[0]]
        for day in [folder.rsplit("dt=", 1)[1]]
    }
    return _lines(spark, root, loose).unionByName(
        _lines(spark, f"{root}/{COMPACTED}", sorted(packed))
    )


def message_text() -> list[Column]:
    """Columns of a message with key and value decoded as UTF-8."""
    return [
        F.col("value").cast("string").alias("_text"),
        F.col("offset").alias("_kafka_offset"),
        F.col("partition").alias("_kafka_partition"),
        F.col("topic").alias("_kafka_topic"),
        F.col("key").cast("string").alias("_kafka_key"),
    ]
