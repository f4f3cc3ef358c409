"""Extracts that bring the same again: what they do not change is not written."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators.merge import upsert
from millrace.plans.lake import Lake
from millrace.plans.runner import find_table, run
from millrace.sources.checksums import checksums, equal_parts
from millrace.sources.relational import FrameRelations

DAY = dt.date(2031, 3, 14)
READINGS = "silver/postgres/leituras"
EXTRACT = (
    "id string, sensor_id string, valor double, status_qualidade_id int, is_anomalia boolean,"
    " timestamp_leitura timestamp"
)


def reading(number, days=0, value=1.0):
    return (f"r{number}", "S", value, 1, False, dt.datetime(2031, 3, 2 + days, 6))


def load(spark, root, day, data):
    lake = Lake(spark, str(root), "hmg", FrameRelations(lambda _: spark.createDataFrame(data, EXTRACT)))
    run(lake, find_table("bronze/postgres/leituras"), day)
    before = lake.table(READINGS).manifest()
    result = run(lake, find_table(READINGS), day)
    after = lake.table(READINGS).manifest()
    changed = {p for p, s in after.parts.items() if not before or before.parts.get(p) != s}
    return lake, result, {p.rsplit("=", 1)[1] for p in changed}, before is not None and before.version == after.version


def test_only_partitions_with_a_change_are_rewritten(spark, tmp_path):
    data = [reading(n, n % 4) for n in range(12)]
    load(spark, tmp_path, DAY, data)
    # the same rows, in another order, a day later: no new version of the table
    lake, result, changed, same = load(spark, tmp_path, DAY + dt.timedelta(1), data[::-1])
    assert (result.rows, result.rewritten, changed, same) == (12, (), set(), True)
    # one value changes, one reading is new in a day of its own
    data = [reading(5, 1, 2.5), *(r for r in data if r[0] != "r5"), reading(20, 9)]
    lake, result, changed, _ = load(spark, tmp_path, DAY + dt.timedelta(2), data)
    assert changed == {"2031-03-03", "2031-03-11"}
    found = {r[0]: r[1:] for r in rows(lake.read(READINGS).select("id", "valor", "_execution_date"), "id")}
    assert found["r5"] == (2.5, DAY + dt.timedelta(2)) and found["r20"][1] == DAY + dt.timedelta(2)
    assert {found[f"r{n}"] for n in range(12) if n != 5} == {(1.0, DAY)}
    # a reading that the extract lacks stays, and the partition is merged
    lake, result, changed, _ = load(spark, tmp_path, DAY + dt.timedelta(3), [r for r in data if r[0] != "r1"])
    assert lake.read(READINGS).count() == 13 and "2031-03-02" not in changed


def test_content_decides_row_by_row(spark):
    schema = "k int, v string, note string, _execution_date date"
    target = spark.createDataFrame([(1, "a", None, DAY), (2, None, "x", DAY), (3, "c", "x", DAY)], schema)
    later = DAY + dt.timedelta(1)
    source = spark.createDataFrame([(1, "a", None, later), (2, None, "y", later), (3, None, "x", later), (4, "d", "", later)], schema)
    merged = upsert(target, source, ["k"], content=["v", "note"])
    assert rows(merged.select("k", "_execution_date"), "k") == [(1, DAY), (2, later), (3, later), (4, later)]
    assert rows(upsert(target, source, ["k"], content=["v"]).select("k", "_execution_date"), "k")[1] == (2, DAY)


SUMS = "k int, v string, w string, _part string"
ROWS = st.lists(
    st.tuples(st.integers(0, 2), st.sampled_from([None, "", "a"]), st.sampled_from([None, "", "a"]), st.sampled_from("pq")),
    max_size=8,
)


@settings(max_examples=12, deadline=None)
@given(ROWS, ROWS, st.randoms())
def test_equal_parts_hold_the_same_rows(spark, one, other, rng):
    columns = ["k", "v", "w"]

    def parts(data):
        return {p: sorted(map(repr, (r for r in data if r[3] == p))) for p in {r[3] for r in data}}

    shuffled = rng.sample(one, len(one))
    want = {p for p, held in parts(one).items() if parts(other).get(p) == held}
    a, b, c = (spark.createDataFrame(x, SUMS).coalesce(1) for x in (one, other, shuffled))
    assert equal_parts(a, b, columns) == want
    assert equal_parts(a, c, columns) == set(parts(one))


def test_repeated_rows_do_not_cancel_out(spark):
    twice = spark.createDataFrame([(1, "a", None, "p")] * 2 + [(1, None, "a", "q")], SUMS)
    none = spark.createDataFrame([(2, "a", None, "p")] * 2 + [(1, "a", None, "q")], SUMS)
    assert equal_parts(twice, none, ["k", "v", "w"]) == set()
    assert checksums(twice.filter(F.lit(False)), ["k"]).count() == 0
