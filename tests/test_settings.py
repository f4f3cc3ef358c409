"""Scratch folders, topic options and the text of a pushed-down join."""

import datetime as dt
import signal

import pytest

from millrace.session import scratch_path
from millrace.sources.events import topic_options
from millrace.sources.relational import JdbcRelations, children_sql
from millrace.streaming import __main__ as stream


class Session:
    """A session that only has settings."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", ""):
        with pytest.raises(RuntimeError):
            scratch_path(Session(spark_master=master), "x")
    shared = Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")
    assert scratch_path(shared, "x").startswith("hdfs:///shared/millrace/x-")
    assert scratch_path(Session(spark_master="local[4]"), "x")


def test_topic_options():
    assert topic_options("h:1", "t", None, None, None, None) == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
    }
    full = topic_options("h:1", "t", 9, 5, "30s", {"kafka.security.protocol": "SSL"})
    assert (full["maxOffsetsPerTrigger"], full["minOffsetsPerTrigger"]) == ("9", "5")
    assert (full["maxTriggerDelay"], full["kafka.security.protocol"]) == ("30s", "SSL")


def test_stream_arguments():
    args = stream.parse(
        "--bootstrap-servers h --root r --checkpoint c --min-offsets 5 --max-delay 30s"
        " --option kafka.a=b=c --bool-is-number".split()
    )
    assert (args.min_offsets, args.max_delay, args.option) == (5, "30s", ["kafka.a=b=c"])
    assert args.bool_is_number


def test_sigterm_stops_the_query():
    class Query:
        stopped = False

        def stop(self):
            self.stopped = True

    before = signal.getsignal(signal.SIGTERM)
    try:
        stream.stop_on_signal(query := Query())
        signal.raise_signal(signal.SIGTERM)
    finally:
        signal.signal(signal.SIGTERM, before)
    assert query.stopped


def test_children_are_joined_in_the_database_with_standard_times():
    text = children_sql('"p"."c"', "f", '"p"."t"', "id", "at", dt.date(2031, 1, 1), dt.date(2031, 1, 2))
    assert "{ts '2031-01-01 00:00:00'}" in text and "{ts '2031-01-03 00:00:00'}" in text
    assert "TIMESTAMP(" not in text
    split = JdbcRelations(None, "jdbc:x", window_reads=4)._ranges("_window", dt.date(2031, 1, 1), dt.date(2031, 1, 2))
    assert (split.column, split.lower, split.upper, split.count) == (
        "_window", "2031-01-01 00:00:00", "2031-01-03 00:00:00", 4
    )
