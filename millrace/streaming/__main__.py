"""Ingest a topic into bronze: ``spark-submit`` or ``python -m millrace.streaming``."""

from __future__ import annotations

import argparse
import logging
import signal

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from millrace.functions.contract import Contract
from millrace.plans.lake import Lake
from millrace.session import build_session
from millrace.sources.events import TOPIC, topic_messages
from millrace.sources.files import read_text
from millrace.streaming.alerts import lake_limits, start_range_alerts, typed_events
from millrace.streaming.ingest import OBSERVED, classify, start_ingest

log = logging.getLogger(__name__)


class CounterLog(StreamingQueryListener):
    """Log the counters of each batch."""

    def onQueryStarted(self, event):
        log.info("started %s", event.name)

    def onQueryProgress(self, event):
        counted = event.progress.observedMetrics.get(OBSERVED)
        if counted:
            rate = event.progress.processedRowsPerSecond
            log.info("batch %d: %s, %.1f rows/s", event.progress.batchId, counted.asDict(), rate)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        log.info("ended: %s", event.exception or "no error")


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="millrace.streaming", description=__doc__)
    parser.add_argument("--bootstrap-servers", required=True)
    parser.add_argument("--topic", default=TOPIC)
    parser.add_argument("--root", required=True, help="folder that holds the layers")
    parser.add_argument("--environment", default="hmg")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--schema-file", help="JSON Schema of the contract")
    parser.add_argument("--flush-interval", default="30 seconds")
    parser.add_argument("--max-offsets", type=int, help="messages per batch at most")
    parser.add_argument("--min-offsets", type=int, help="messages a batch waits for")
    parser.add_argument("--max-delay", help="how long it waits for them, such as 30s")
    parser.add_argument(
        "--option", action="append", default=[], help="connector option, as name=value"
    )
    parser.add_argument(
        "--bool-is-number", action="store_true", help="accept true and false as value"
    )
    parser.add_argument(
        "--range-alerts", help="folder of the alerts on the ranges of sensors and types; none if left out"
    )
    parser.add_argument("--available-now", action="store_true")
    parser.add_argument("--dry-run", action="store_true")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    logging.basicConfig(level=logging.INFO)
    spark = build_session("millrace-ingest")
    spark.streams.addListener(CounterLog())
    schema = read_text(spark, args.schema_file) if args.schema_file else None
    contract = Contract.from_json_schema(schema, bool_is_number=args.bool_is_number)
    messages = topic_messages(
        spark,
        args.bootstrap_servers,
        args.topic,
        most=args.max_offsets,
        least=args.min_offsets,
        longest_wait=args.max_delay,
        options=dict(option.split("=", 1) for option in args.option),
    )
    lake = Lake(spark, args.root, args.environment)
    started = [
        start_ingest(
            messages,
            lake.events_path,
            args.checkpoint,
            contract=contract,
            interval=args.flush_interval,
            available_now=args.available_now,
            dry_run=args.dry_run,
        )
    ]
    if args.range_alerts and not args.dry_run:
        # A query of its own: alerts do not hold up the lines, nor fail with them.
        started.append(
            start_range_alerts(
                typed_events(classify(messages, contract)),
                args.range_alerts,
                f"{args.checkpoint.rstrip('/')}-range-alerts",
                lake_limits(lake),
                interval=args.flush_interval,
                available_now=args.available_now,
            )
        )
    stop_on_signal(*started)
    await_all(spark, started)


def await_all(spark: SparkSession, started: list[StreamingQuery]) -> None:
    """Wait for all queries; if one fails, the others end too."""
    try:
        while any(query.isActive for query in started):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
    finally:
        for query in started:
            query.stop()
    for query in started:
        query.awaitTermination()


def stop_on_signal(*started: StreamingQuery) -> None:
    """On SIGTERM, end the queries; an unfinished batch is done again at the next start."""
    signal.signal(signal.SIGTERM, lambda *_: [query.stop() for query in started])


if __name__ == "__main__":
    main()
