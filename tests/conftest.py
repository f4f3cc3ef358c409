import datetime as dt
import json
import os
import sys
import time
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["TZ"] = "UTC"
time.tzset()

from pyspark.sql import functions as F  # noqa: E402

from millrace.functions.contract import (  # noqa: E402
    MEASUREMENT_TYPES,
    QUALITIES,
    REQUIRED_FIELDS,
)
from millrace.schemas import MESSAGE  # noqa: E402
from millrace.session import build_session  # noqa: E402
from millrace.sources.events import TOPIC  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "millrace-tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.extraJavaOptions": "-Dderby.stream.error.file=/dev/null",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


DAY = dt.datetime(2031, 3, 14)


def event(drop=(), **changes):
    """An event that keeps the default contract, but for the changes asked for."""
    fields = {name: f"{name}-0" for name in REQUIRED_FIELDS if name.endswith("_id")}
    fields |= {
        "measurement_type": MEASUREMENT_TYPES[0],
        "quality": QUALITIES[0],
        "value": 3.25,
        "unit": "u",
        "timestamp": (DAY + dt.timedelta(hours=6)).isoformat(),
        "is_anomaly": False,
        "metadata": {},
    }
    return {k: v for k, v in (fields | changes).items() if k not in drop}


def messages(spark, payloads):
    """Messages of a topic; text payloads are sent as they are."""
    texts = [p if isinstance(p, str) else json.dumps(p, ensure_ascii=False) for p in payloads]
    rows = [(b"%d" % n, t.encode(), TOPIC, 0, n, DAY) for n, t in enumerate(texts)]
    return spark.createDataFrame(rows, MESSAGE)


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def values(df, column, *order):
    return [r[0] for r in df.orderBy(*(order or (column,))).select(F.col(column)).collect()]
