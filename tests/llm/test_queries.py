"""The registered queries on the smallest data, against their SQL where they have it."""

import os

import pytest

from check_queries import connect, differences
from __spark_entry__ import queries
from millrace.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_all_operators_and_the_pipeline_are_registered():
    assert [sum(name.startswith(f"op{n}_") for name in queries()) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in queries()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    assert differences(queries()[name](spark, FOLDER), connect(FOLDER).execute(ORACLES[name])) is None


def test_every_document_has_a_row(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for name in ("op2_jaccard", "op7_lm", "op9_toxicity", "op10_language"):
        assert queries()[name](spark, FOLDER).count() == documents, name


def test_held_out_accuracy(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = queries()["op10_language"](spark, folder).where("held_out").join(docs, "doc_id")
    right, all_ = found.where("lang = lang_pred").count(), found.count()
    assert right >= 0.95 * all_
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries()["op9_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    hits = sum(r["predicted"] == r["toxic"] for r in rows)
    assert hits >= 0.9 * len(rows)


def test_native_operators_use_no_python_on_rows(spark):
    for name in ("op1_decontamination", "op5_chat", "op6_secrets"):
        plan = queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name
    assert QUERIES.keys() >= ORACLES.keys()
