"""Every registered query against its SQL on the smallest data."""

import ast
import os
from pathlib import Path

import pytest

from check_queries import connect, differences
from __spark_entry__ import entry, oracle_sql, queries
from millrace.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
REPO = Path(__file__).resolve().parents[1]

needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = queries()[name](spark, FOLDER)
    assert differences(df, duck.execute(oracle_sql()[name])) is None


@needs_data
def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())


def test_no_python_functions_run_on_rows():
    """The library is column expressions: no UDFs, RDDs or local checkpoints."""
    banned = {"udf", "pandas_udf", "rdd", "mapInPandas", "applyInPandas", "toPandas", "localCheckpoint"}
    for path in (REPO / "millrace").rglob("*.py"):
        if "llm" in path.relative_to(REPO).parts:
            continue
        names = {
            getattr(node, "attr", getattr(node, "id", None))
            for node in ast.walk(ast.parse(path.read_text()))
            if isinstance(node, (ast.Attribute, ast.Name))
        }
        assert not names & banned, path
