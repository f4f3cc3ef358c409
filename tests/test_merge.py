"""Upsert: the case table, properties, and stored tables."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.merge import ROW_HASH, replace_date, row_hash, upsert
from millrace.session import session_conf
from millrace.sources.tables import SnapshotTable

SCHEMA = "k int, v string, _execution_date date"


def day(n):
    return None if n is None else dt.date(2026, 6, n)


def frame(spark, data):
    return spark.createDataFrame([(k, v, day(d)) for k, v, d in data], SCHEMA)


TARGET = [(1, "a", 20), (2, "a", 20), (3, "a", 21), (4, "a", 20), (7, "a", None)]
SOURCE = [(1, "b", 21), (2, "b", 20), (3, "b", 20), (5, "b", 20), (7, "b", 20)]
MERGED = [(1, "b", 21), (2, "b", 20), (3, "a", 21), (4, "a", 20), (5, "b", 20), (7, "a", None)]


def test_cases(spark):
    merged = upsert(frame(spark, TARGET), frame(spark, SOURCE), ["k"])
    assert rows(merged, "k") == [(k, v, day(d)) for k, v, d in MERGED]


def test_row_hash_keeps_equal_rows(spark):
    target = frame(spark, [(6, "a", 20), (1, "a", 20)]).withColumn(ROW_HASH, row_hash(["k", "v"]))
    source = frame(spark, [(6, "a", 21), (1, "b", 21)]).withColumn(ROW_HASH, row_hash(["k", "v"]))
    merged = upsert(target, source, ["k"], use_row_hash=True)
    assert rows(merged.select("k", "v", "_execution_date"), "k") == [
        (1, "b", day(21)),
        (6, "a", day(20)),
    ]


def test_row_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert df.select(row_hash(["x", "y"])).distinct().count() == 3


def test_repeated_source_keys_fail(spark):
    twice = frame(spark, [(8, "b", 20), (8, "c", 20)])
    with pytest.raises(PySparkException, match="several source rows"):
        upsert(frame(spark, TARGET), twice, ["k"]).collect()


def test_null_keys_never_match_unless_null_safe(spark):
    target, source = frame(spark, [(None, "a", 20)]), frame(spark, [(None, "b", 21)])
    assert upsert(target, source, ["k"]).count() == 2
    assert rows(upsert(target, source, ["k"], null_safe=["k"])) == [(None, "b", day(21))]


def test_null_keys_go_round_the_join(spark):
    """Many rows without a key would be one group of the join; they are not in it."""
    schema = "k string, v string, _execution_date date"
    target = spark.createDataFrame([(None, "t", day(1))] * 3 + [("a", "t", day(1))], schema)
    source = spark.createDataFrame([(None, "s", day(2))] * 2 + [("a", "s", day(2))], schema)
    merged = upsert(target, source, ["k"])
    assert sorted(r.v for r in merged.collect()) == ["s", "s", "s", "t", "t", "t"]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join FullOuter") :].split("Filter (isnull")[0]
    assert join.count("isnotnull(k") >= 2


def test_missing_columns_are_refused(spark):
    with pytest.raises(ValueError, match="lacks"):
        upsert(frame(spark, TARGET), frame(spark, SOURCE).drop("v"), ["k"])


def test_replace_date(spark):
    source = frame(spark, [(1, "b", 20), (9, "b", 20)])
    replaced = replace_date(frame(spark, TARGET), source, ["k"], day(20))
    assert rows(replaced, "k") == [
        (1, "b", day(20)),
        (3, "a", day(21)),
        (7, "a", None),
        (9, "b", day(20)),
    ]


def test_constant_key_stays_in_the_join(spark):
    target = frame(spark, TARGET).withColumn("d", F.col("_execution_date"))
    source = frame(spark, SOURCE).withColumn("d", F.lit(day(20)))
    plan = upsert(target, source, ["k", "d"])._jdf.queryExecution().executedPlan().toString()
    join = next(line for line in plan.splitlines() if "FullOuter" in line)
    assert "[k#" in join and ", d#" in join


row = st.tuples(st.sampled_from("abc"), st.integers(1, 28))
table = st.dictionaries(st.integers(0, 9), row, max_size=8)


def listed(content):
    return [(k, v, d) for k, (v, d) in content.items()]


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(target=table, source=table)
def test_properties(spark, target, source):
    t, s = frame(spark, listed(target)), frame(spark, listed(source))
    once = upsert(t, s, ["k"])
    result = {k: (v, d.day) for k, v, d in rows(once)}
    assert set(result) == set(target) | set(source)
    for k, kept in result.items():
        if k in target and k in source:
            newer = source[k][1] >= target[k][1]
            assert kept == (source[k] if newer else target[k])
        else:
            assert kept == target.get(k, source.get(k))
    again = upsert(spark.createDataFrame(once.collect(), SCHEMA), s, ["k"])
    assert rows(again, "k") == rows(once, "k")


# -- stored tables ------------------------------------------------------------


def stored(spark, path, df, partition_by=()):
    table = SnapshotTable(spark, str(path))
    table.replace(table.stage(df, partition_by))
    return table


def test_stored_upsert_equals_upsert(spark, tmp_path):
    for name, partition_by in (("whole", []), ("by_day", ["_execution_date"]), ("by_v", ["v"])):
        table = stored(spark, tmp_path / name, frame(spark, TARGET), partition_by)
        table.merge(table.stage(frame(spark, SOURCE), partition_by), ["k"])
        assert rows(table.read().select("k", "v", "_execution_date"), "k") == [
            (k, v, day(d)) for k, v, d in MERGED
        ]


def parts_schema(spark, data):
    return spark.createDataFrame(data, "k int, v string, p string, _execution_date date")


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    target = [(n, "a", p, day(1)) for n, p in enumerate(["x y", "é:1", "z", "z"])]
    table = stored(spark, tmp_path, parts_schema(spark, target), ["p"])
    before = table.manifest().parts
    # Key 1 moves from partition "é:1" to a new one; "x y" and "z" stay.
    moved = parts_schema(spark, [(1, "b", "new", day(2))])
    touched = table.merge(table.stage(moved, ["p"]), ["k"])
    after = table.manifest().parts
    assert [t for t in touched if "1" in t] == touched and len(touched) == 1
    kept = {p for p in before if before[p] == after.get(p)}
    assert len(kept) == 2
    assert rows(table.read().select("k", "p"), "k") == [(0, "x y"), (1, "new"), (2, "z"), (3, "z")]


def test_key_ranges_do_not_change_the_result(spark, tmp_path):
    target = [(n, "a", f"p{n % 3}", day(1)) for n in range(9)]
    table = stored(spark, tmp_path, parts_schema(spark, target), ["p"])
    source = parts_schema(spark, [(4, "b", "new", day(2)), (20, "b", "new", day(2))])
    table.merge(table.stage(source, ["p"]), ["k"], key_ranges={"k": (4, 20)})
    assert rows(table.read().filter("v = 'b'").select("k", "p"), "k") == [(4, "new"), (20, "new")]
    assert table.read().count() == 10


def test_stored_replace_date(spark, tmp_path):
    table = stored(spark, tmp_path, frame(spark, TARGET), ["_execution_date"])
    source = frame(spark, [(1, "b", 20), (9, "b", 20)])
    table.merge(table.stage(source, ["_execution_date"]), ["k"], replace_day=day(20))
    assert rows(table.read().select("k", "v"), "k") == [(1, "b"), (3, "a"), (7, "a"), (9, "b")]


def test_keys_that_stay_need_no_search(spark, tmp_path):
    table = stored(spark, tmp_path, frame(spark, TARGET), ["_execution_date"])
    source = frame(spark, [(5, "b", 25)])
    staged = table.stage(source, ["_execution_date"])
    assert table.merge(staged, ["k"], keys_stay=True) == []
    assert table.read().count() == len(TARGET) + 1


def test_readers_keep_their_snapshot(spark, tmp_path):
    table = stored(spark, tmp_path, frame(spark, TARGET))
    reader = table.read()
    table.merge(table.stage(frame(spark, SOURCE)), ["k"])
    assert reader.count() == len(TARGET) and table.read().count() == len(MERGED)


def test_read_by_partition_value(spark, tmp_path):
    table = stored(spark, tmp_path, frame(spark, TARGET), ["_execution_date"])
    one = table.read({"_execution_date": day(21)})
    assert rows(one.select("k")) == [(3,)]
    assert len(one.inputFiles()) == 1
    assert table.read({"_execution_date": day(2)}).count() == 0


def test_second_writer_of_a_version_fails(spark, tmp_path):
    table = stored(spark, tmp_path, frame(spark, TARGET))
    staged, previous = table.stage(frame(spark, SOURCE)), table.manifest()
    table.replace(staged)
    with pytest.raises(FileExistsError):
        table._publish(staged, {"": staged.snapshot}, previous)


def test_shape_changes_are_refused(spark, tmp_path):
    table = stored(spark, tmp_path, frame(spark, TARGET))
    with pytest.raises(ValueError, match="differ"):
        table.merge(table.stage(frame(spark, SOURCE).withColumn("x", F.lit(1))), ["k"])


def test_missing_table(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "none"))
    assert not table.exists()
    with pytest.raises(FileNotFoundError):
        table.read()


def test_vacuum_keeps_what_is_used(spark, tmp_path):
    table = stored(spark, tmp_path, frame(spark, TARGET))
    for _ in range(2):
        table.merge(table.stage(frame(spark, SOURCE)), ["k"])
    stale = table.vacuum(keep=1)
    assert len(stale) == 4
    assert rows(table.read(), "k") == [(k, v, day(d)) for k, v, d in MERGED]


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    """A partition with nearly all rows does not fall to one task."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m"}
    rows_ = spark.range(0, 200000, 1, 8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.when(F.col("id") % 50 == 0, "cold").otherwise("hot").alias("p"),
    )
    with session_conf(spark, settings):
        table = stored(spark, tmp_path, rows_, ["p"])
    files = {p: len(table.read({"p": p}).inputFiles()) for p in ("hot", "cold")}
    assert files["hot"] > 3 and files["cold"] == 1
    assert table.read().count() == 200000
