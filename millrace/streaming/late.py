"""Window metrics that events behind the watermark still reach, as corrections.

A window closes once the watermark (the latest event time of all batches before,
less the lateness) passes its end, and is then written once. Events that come
for a closed window are not dropped: they are kept as rows (``late``) and
counted into ``corrections``, rows of the same measures to add to the window.
Windows and corrections together are what one run over all events gives,
in whatever order they arrive.

Every batch's outputs are in folders of its own and follow from its rows and from
what the batches before have written, so that a replay writes them again. The watermark
is written last, in a file per batch; readers take the batches that have one.

Sums are kept in place of means, so that parts can be added up.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.filters import is_true
from millrace.sources.events import BATCH_COLUMN
from millrace.sources.files import create_text, matching, read_text
from millrace.sources.plain import overwrite_partitions

KEYS = ("inicio", "fim", "factory_id", "measurement_type")
WINDOWS, CORRECTIONS, LATE = "windows", "corrections", "late"
_PARTIALS, _IDS, _CLOCK, _PERIOD = "_partials", "_ids", "_clock", "_period"

PARTS = (
    "inicio timestamp, fim timestamp, factory_id string, measurement_type string, leituras long,"
    " anomalias long, valores long, soma double, min_valor double, max_valor double"
)


#: Names of the folders that ids and open windows are kept in, by hour or by day.
HOURS, DAYS = "yyyy-MM-dd-HH", "yyyy-MM-dd"


def measures(events: DataFrame) -> DataFrame:
    """Parts of metrics that can be added up, by window, factory and type."""
    return events.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("leituras"),
        F.count_if(is_true("is_anomaly")).alias("anomalias"),
        F.count("value").alias("valores"),
        F.sum("value").alias("soma"),
        F.min("value").alias("min_valor"),
        F.max("value").alias("max_valor"),
    )


def added(parts: DataFrame) -> DataFrame:
    """Parts of the same windows as one row each."""
    sums = [F.sum(c).alias(c) for c in ("leituras", "anomalias", "valores", "soma")]
    return parts.groupBy(*KEYS).agg(
        *sums, F.min("min_valor").alias("min_valor"), F.max("max_valor").alias("max_valor")
    )


class _State:
    """What the batches before one have left."""

    def __init__(self, spark: SparkSession, root: str, periods: str = HOURS):
        self.spark, self.root, self.periods = spark, root.rstrip("/"), periods

    def period(self, time: Column) -> Column:
        """The folder of a time."""
        return F.date_format(time, self.periods)

    def clocks(self) -> dict[int, str]:
        files = matching(self.spark, f"{self.root}/{_CLOCK}/*.json")
        return {int(f.rsplit("/", 1)[1].removesuffix(".json")): f for f in files}

    def watermark(self, before: int) -> int | None:
        """In microseconds, after all batches with a smaller number."""
        clocks = {n: f for n, f in self.clocks().items() if n < before}
        return json.loads(read_text(self.spark, clocks[max(clocks)]))["watermark"] if clocks else None

    def close(self, batch: int, watermark: int | None) -> None:
        if batch not in self.clocks():
            path = f"{self.root}/{_CLOCK}/{batch:010d}.json"
            create_text(self.spark, path, json.dumps({"watermark": watermark}))

    def read(self, name: str, schema: str, before: int | None = None) -> DataFrame:
        """An output's rows of complete batches (those before one)."""
        last = max(self.clocks(), default=-1) if before is None else before - 1
        path, full = f"{self.root}/{name}", f"{schema}, {BATCH_COLUMN} int"
        if not matching(self.spark, f"{path}/*=*"):
            return self.spark.createDataFrame([], full)
        return self.spark.read.schema(full).parquet(path).filter(F.col(BATCH_COLUMN) <= last)

    def write(self, df: DataFrame, name: str, batch: int, *folders: str) -> None:
        numbered = df.withColumn(BATCH_COLUMN, F.lit(batch))
        if folders:
            numbered = numbered.hint("rebalance", *folders)
        overwrite_partitions(numbered, f"{self.root}/{name}", [*folders, BATCH_COLUMN])


def _moment(micros: int | None) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("long"))


def corrected_writer(
    root: str,
    width: str = "5 minutes",
    slide: str | None = None,
    lateness: str = "10 minutes",
    periods: str = HOURS,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: windows, corrections and late events of one batch.

    A batch looks for repeats in the ids of the ``periods`` (of hours or of days) its own
    events fall into. Take days where a batch brings events of many hours.
    """

    def write(batch: DataFrame, number: int) -> None:
        state = _State(batch.sparkSession, root, periods)
        before = state.watermark(number)
        events = _new_events(state, batch, number).persist()
        try:
            frame = F.window("timestamp", width, slide) if slide else F.window("timestamp", width)
            placed = events.withColumn("w", frame).withColumns(
                {"inicio": F.col("w.start"), "fim": F.col("w.end")}
            )
            # Without a watermark nothing is closed, and the comparison is NULL.
            closed = F.coalesce(F.col("fim") <= _moment(before), F.lit(False))
            on_time = measures(placed.filter(~closed)).withColumn(_PERIOD, state.period(F.col("fim")))
            state.write(on_time, _PARTIALS, number, _PERIOD)
            late = placed.filter(closed)
            state.write(measures(late), CORRECTIONS, number)
            state.write(late.drop("w", _PERIOD), LATE, number)
            newest = events.agg(
                F.unix_micros(F.max("timestamp") - F.expr(f"INTERVAL {lateness}"))
            ).first()[0]
            # Last, as Spark drops what is cached from a folder that is written.
            ids = events.filter("event_id IS NOT NULL").select("event_id", "timestamp", _PERIOD)
            state.write(ids, _IDS, number, _PERIOD)
        finally:
            events.unpersist()
        after = max((t for t in (before, newest) if t is not None), default=None)
        if after is not None and after != before:
            state.write(_closing(state, number, before, after), WINDOWS, number)
        state.close(number, after)

    return write


def _new_events(state: _State, batch: DataFrame, number: int) -> DataFrame:
    """The batch's events that no batch before has brought.

    A repeat has the id and the time of the first delivery, so it is looked for
    among the ids of its own period. Events without an id are all new.
    """
    batch = batch.filter(F.col("timestamp").isNotNull()).withColumn(_PERIOD, state.period(F.col("timestamp")))
    known = batch.filter("event_id IS NOT NULL").dropDuplicates(["event_id", "timestamp"])
    periods = [r[0] for r in known.select(_PERIOD).distinct().collect()]
    ids = state.read(_IDS, f"event_id string, timestamp timestamp, {_PERIOD} string", before=number)
    ids = ids.filter(F.col(_PERIOD).isin(*periods)).select("event_id", "timestamp")
    if periods:
        known = known.join(ids, ["event_id", "timestamp"], "left_anti")
    return known.unionByName(batch.filter("event_id IS NULL"))


def _closing(state: _State, number: int, before: int | None, after: int) -> DataFrame:
    """The windows whose end the watermark passes with this batch; only their periods are read."""
    parts = state.read(_PARTIALS, f"{PARTS}, {_PERIOD} string", before=number + 1)
    last = _moment(after)
    due = (F.col("fim") <= last) & (F.col(_PERIOD) <= state.period(last))
    if before is not None:
        due &= (F.col("fim") > _moment(before)) & (F.col(_PERIOD) >= state.period(_moment(before)))
    return added(parts.filter(due))


def start_corrected_metrics(
    events: DataFrame,
    root: str,
    checkpoint: str,
    *,
    width: str = "5 minutes",
    slide: str | None = None,
    lateness: str = "10 minutes",
    periods: str = HOURS,
    available_now: bool = False,
) -> StreamingQuery:
    """Start writing windows, late events and corrections below ``root``."""
    columns = ("event_id", "timestamp", "factory_id", "measurement_type", "value", "is_anomaly")
    writer = (
        events.select(*columns)
        .writeStream.queryName("window-corrections")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(corrected_writer(root, width, slide, lateness, periods))
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": "1 minute"}
    return writer.trigger(**trigger).start()


def closed_windows(spark: SparkSession, root: str) -> DataFrame:
    """Windows as they were when they closed, with the batch that closed them."""
    return _State(spark, root).read(WINDOWS, PARTS)


def corrections(spark: SparkSession, root: str) -> DataFrame:
    """What came for closed windows, with the batch it came in."""
    return _State(spark, root).read(CORRECTIONS, PARTS)


def late_events(spark: SparkSession, root: str) -> DataFrame:
    """Events that came for a closed window, once for each such window."""
    return _State(spark, root).read(
        LATE,
        "event_id string, timestamp timestamp, factory_id string, measurement_type string,"
        " value double, is_anomaly boolean, inicio timestamp, fim timestamp",
    )


def corrected_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Closed windows with all their corrections, in the columns of ``window_metrics``."""
    whole = added(closed_windows(spark, root).unionByName(corrections(spark, root)))
    return whole.select(
        *KEYS, "leituras", "anomalias",
        F.try_divide("soma", "valores").alias("avg_valor"), "min_valor", "max_valor",
    )
