"""What a larger input costs: work for each row, and what one task holds."""

import os
from urllib.parse import unquote

import pytest
from conftest import DAY, event, messages
from pyspark.sql import functions as F

from millrace.plans import reports
from millrace.sources.checksums import checksums, row_hash64
from millrace.sources.tables import SnapshotTable
from millrace.streaming.ingest import classify


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("by", [(), ("p",), ("p", "q")])
def test_folder_of_a_row_is_cut_out_of_its_file(spark, tmp_path, by):
    odd = [("a/b", 1), ("50%", 2), ("x=1", 3), ("é +", 4), (None, 5)]
    table = SnapshotTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame(odd, "p string, q int").withColumn("v", F.lit(1))
    staged = table.stage(rows, by)
    table.replace(staged)
    manifest = table.manifest()
    for found in (table.read_with_parts(manifest, manifest.parts), table.read_staged_with_parts(staged)):
        assert {unquote(r["_part"]) for r in found.collect()} == set(manifest.parts)
        assert "regexp" not in plan(found).lower()


def test_sums_of_hashes_are_exact_and_no_decimals(spark):
    rows = spark.range(1000).select((F.col("id") % 3).cast("string").alias("_part"), "id")
    sums = checksums(rows, ["id"])
    assert {kind for name, kind in sums.dtypes if name != "_part"} == {"bigint"}
    whole = {
        salt: {
            r["_part"]: int(r["s"])
            for r in rows.groupBy("_part")
            .agg(F.sum(row_hash64(["id"], salt).cast("decimal(38,0)")).alias("s"))
            .collect()
        }
        for salt in "ab"
    }
    for r in sums.collect():
        assert (r["first_high"] << 32) + r["first_low"] == whole["a"][r["_part"]]
        assert (r["second_high"] << 32) + r["second_low"] == whole["b"][r["_part"]]


def test_more_readings_are_joined_in_more_partitions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "with space")
    rows = [(f"r{n}", f"s{n % 7}", 1.0, 1, n % 2 == 0, DAY) for n in range(100)]
    kinds = "id string, sensor_id string, valor double, status_qualidade_id int, is_anomalia boolean, timestamp_leitura timestamp"
    spark.createDataFrame(rows, kinds).write.parquet(path)
    readings = spark.read.parquet(path)
    size = sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet"))
    sides = (
        spark.createDataFrame([(1, "good")], "id int, nome string"),
        spark.createDataFrame([("s1", "e1", 1)], "id string, equipamento_id string, tipo_medicao_id int"),
        spark.createDataFrame([("e1", "f1")], "id string, fabrica_id string"),
        spark.createDataFrame([(1, "temperature")], "id int, nome string"),
    )
    few = reports.readings_as_events(readings, *sides)
    assert "REPARTITION_BY_NUM" not in plan(few)
    monkeypatch.setattr(reports, "PIECE", size // 20)
    many = reports.readings_as_events(readings, *sides)
    assert "REPARTITION_BY_NUM" in plan(many)
    assert sorted(many.collect()) == sorted(few.collect())
def test_the_contract_is_a_function_of_its_own(spark):
    sent = messages(spark, [event(), "{bad"])
    judged = classify(sent)
    assert plan(judged).count("Generate") == 2
    assert judged.filter("_dlq_reason IS NULL").count() == 1
