"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on for right results or for skew-safe plans.
# Sizes (executor memory, shuffle partitions, ...) belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # What a Python worker holds of its input at once, whatever the length of rows.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}
# Python workers give freed arrays back at once instead of keeping them for later tasks.
WORKER_ENVIRONMENT = {
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": str(1 << 20),
    "MALLOC_TRIM_THRESHOLD_": str(1 << 20),
}


def build_session(app: str, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Pin the settings on a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    for key, value in WORKER_ENVIRONMENT.items():
        spark.sparkContext.environment.setdefault(key, value)
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold within a block."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    Without that setting there is no folder all workers share, so this fails;
    a local session, whose workers are this machine, takes a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master!r}")
        root = tempfile.mkdtemp(prefix="millrace-")
    return f"{root.rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"
