"""Small path helpers on the Hadoop file system (metadata only, no data)."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob; empty if none does."""
    fs, path = _open(spark, pattern)
    return [s.getPath().toString() for s in (fs.globStatus(path) or [])]


def input_bytes(df: DataFrame) -> int:
    """Size of the files that a DataFrame reads; 0 if it reads none."""
    total = 0
    for file in df.inputFiles():
        fs, path = _open(df.sparkSession, unquote(file))
        total += fs.getFileStatus(path).getLen()
    return total


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file in one step; fails if the path is taken.

    The content is complete before the name appears: it is written beside the
    target and renamed.
    """
    fs, final = _open(spark, path)
    _, draft = _open(spark, f"{path}.draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if fs.exists(final) or not fs.rename(draft, final):
        raise FileExistsError(path)


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)
