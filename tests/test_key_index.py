"""Upserts that find their keys by an index, against those that search all history."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.plans.runner import find_table
from millrace.sources.files import delete_tree, matching
from millrace.sources.key_index import KeyIndex
from millrace.sources.tables import SnapshotTable

SCHEMA = "k string, v string, p string, _execution_date date"
PART = ["p", "_execution_date"]


def day(n):
    return dt.date(2031, 3, n)


def frame(spark, data):
    return spark.createDataFrame([(k, v, p, day(d)) for k, v, p, d in data], SCHEMA)


class Both:
    """The same loads into a table with an index and one without."""

    def __init__(self, spark, path, **index):
        self.spark = spark
        self.plain, self.indexed = (SnapshotTable(spark, f"{path}/{n}") for n in ("plain", "indexed"))
        self.index = KeyIndex(self.indexed, ["k"], **{"buckets": 4, **index})

    def load(self, data):
        df = frame(self.spark, data)
        touched = [
            table.merge(table.stage(df, PART), ["k"], index=index)
            for table, index in ((self.plain, None), (self.indexed, self.index))
        ]
        assert touched[0] == touched[1]
        found = [rows(t.read().select("k", "v", "p", "_execution_date"), "k", "v") for t in (self.plain, self.indexed)]
        assert found[0] == found[1]
        return touched[0]


def test_indexed_upserts_equal_searching_ones(spark, tmp_path):
    both = Both(spark, tmp_path, most_loads=2)
    assert both.load([(f"k{n}", "a", "x y", 1) for n in range(20)]) == []
    # other days: nothing to rewrite, then one key that moves, and back
    assert both.load([(f"m{n}", "b", "é:1", 2) for n in range(20)]) == []
    assert len(both.load([("k3", "c", "z", 3), (None, "c", "z", 3)])) == 1
    assert len(both.load([("k3", "d", "x y", 4), ("m1", "d", "z", 4)])) == 2
    # no more loads are kept apart than asked for
    assert len(both.index._loads()) <= 3
    assert both.load([("new", "e", "z", 5)]) == []


def test_only_partitions_that_hold_a_key_are_read(spark, tmp_path):
    """With the data of all other days gone, random keys are still upserted."""
    both = Both(spark, tmp_path, buckets=64)
    table, index = both.indexed, both.index
    for d in range(1, 6):
        df = frame(spark, [(f"{d}-{n * 7919 % 1000}", "a", "p", d) for n in range(50)])
        table.merge(table.stage(df, PART), ["k"], index=index)
    manifest = table.manifest()
    for part, snapshot in manifest.parts.items():
        if "_execution_date=2031-03-03" not in part:
            delete_tree(spark, table._folder(snapshot, part))
    batch = frame(spark, [("3-0", "b", "p", 6), ("fresh", "b", "p", 6)])
    touched = table.merge(table.stage(batch, PART), ["k"], index=index)
    assert touched == ["p=p/_execution_date=2031-03-03"]
    # of the index, it read the buckets of two keys
    read = index.table.read({"_bucket": [0, 1]})
    buckets = {f.split("_bucket=")[1].split("/")[0] for f in read.inputFiles()}
    assert buckets <= {"0", "1"} and len(matching(spark, f"{index.table.path}/_snapshot=*/_bucket=*")) > 2


def test_index_is_built_for_tables_that_had_none(spark, tmp_path):
    both = Both(spark, tmp_path)
    for table in (both.plain, both.indexed):
        table.merge(table.stage(frame(spark, [("a", "1", "x", 1), ("b", "1", "y", 1)]), PART), ["k"])
    assert both.load([("a", "2", "z", 2)]) == ["p=x/_execution_date=2031-03-01"]
    # written past the index: it is built anew
    for table in (both.plain, both.indexed):
        table.merge(table.stage(frame(spark, [("c", "3", "w", 3)]), PART), ["k"])
    assert both.load([("c", "4", "z", 4)]) == ["p=w/_execution_date=2031-03-03"]


def test_load_that_was_lost_after_the_index(spark, tmp_path, monkeypatch):
    """The index names a version that never came; the load is done again."""
    both = Both(spark, tmp_path)
    both.load([("a", "1", "x", 1)])
    with monkeypatch.context() as broken:
        broken.setattr(SnapshotTable, "_publish", _fail_on("/indexed", SnapshotTable._publish))
        with pytest.raises(OSError):
            staged = both.indexed.stage(frame(spark, [("a", "2", "y", 2)]), PART)
            both.indexed.merge(staged, ["k"], index=both.index)
    assert both.load([("a", "3", "z", 3)]) == ["p=x/_execution_date=2031-03-01"]
    assert both.load([("a", "4", "z", 4)]) == ["p=z/_execution_date=2031-03-03"]


def _fail_on(end, publish):
    def failing(self, *args):
        if self.path.endswith(end):
            raise OSError("lost")
        return publish(self, *args)

    return failing


def test_null_safe_and_several_keys(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path))
    index = KeyIndex(table, ["k", "v"], null_safe=["v"], buckets=4)
    for d, data in enumerate([[("a", None), ("a", "1"), (None, None)], [("a", None), (None, None)]], 1):
        df = frame(spark, [(k, v, f"p{d}", d) for k, v in data])
        table.merge(table.stage(df, PART), ["k", "v"], null_safe=["v"], index=index)
    found = rows(table.read().select("k", "v", "p").orderBy(F.col("k").desc(), "v", "p"))
    assert found == [("a", None, "p2"), ("a", "1", "p1"), (None, None, "p1"), (None, None, "p2")]
    empty = table.stage(frame(spark, []), PART)
    assert table.merge(empty, ["k", "v"], null_safe=["v"], index=index) == []


def test_entries_are_shuffled_only_to_be_written(spark, tmp_path, monkeypatch):
    both, plans, stage = Both(spark, tmp_path), [], SnapshotTable.stage

    def noting(table, df, *args, **kwargs):
        if table.path.endswith("_keys"):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(table, df, *args, **kwargs)

    monkeypatch.setattr(SnapshotTable, "stage", noting)
    # rows of a new table may repeat a key
    both.load([("a", "1", "x", 1), ("a", "2", "x", 1), ("a", "3", "y", 1), (None, "4", "y", 1)])
    assert both.load([("a", "5", "z", 2), ("b", "5", "z", 2)]) == [f"p={p}/_execution_date=2031-03-01" for p in "xy"]
    assert len(plans) == 2
    assert not any(step in plan for plan in plans for step in ("Exchange", "Aggregate"))


def test_batch_is_entered_while_partitions_are_rewritten(spark, tmp_path, monkeypatch):
    both = Both(spark, tmp_path)
    both.load([("a", "1", "x", 1), ("b", "1", "y", 1)])
    add, stage, rewriting, seen = both.index.add, both.indexed.stage, threading.Event(), []

    def waiting(staged, version):
        seen.append(rewriting.wait(60))
        add(staged, version)
        seen.append(both.indexed.manifest().version < version)

    def noting(df, *args, **kwargs):
        if threading.current_thread() is threading.main_thread() and "_in_source" in df._jdf.queryExecution().analyzed().toString():
            rewriting.set()
        return stage(df, *args, **kwargs)

    monkeypatch.setattr(both.index, "add", waiting)
    monkeypatch.setattr(both.indexed, "stage", noting)
    assert both.load([("a", "2", "z", 2)]) == ["p=x/_execution_date=2031-03-01"]
    assert seen == [True, True]


def test_batch_that_cannot_be_merged_leaves_the_table(spark, tmp_path):
    both = Both(spark, tmp_path)
    both.load([("a", "1", "x", 1), ("b", "1", "y", 1)])
    staged = both.indexed.stage(frame(spark, [("a", "2", "z", 2), ("a", "3", "z", 2)]), PART)
    with pytest.raises(Exception, match="several source rows"):
        both.indexed.merge(staged, ["k"], index=both.index)
    assert both.indexed.manifest().version == 1
    assert both.load([("a", "4", "w", 3)]) == ["p=x/_execution_date=2031-03-01"]


def test_tables_of_keys_that_may_come_in_any_partition_are_indexed():
    for path in ("silver/kafka/sensor_events", "silver/postgres/metadados_leitura"):
        assert find_table(path).indexed and not find_table(path).keys_stay
