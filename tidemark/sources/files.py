"""Small text files and folder sizes on whatever file system the cluster uses."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if the folder does not exist."""
    fs, path = _open(spark, folder)
    if not fs.exists(path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(path)]


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    fs, hadoop_path = _open(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that readers see whole or not at all; fail if it exists."""
    fs, target = _open(spark, path)
    temporary = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid4().hex}.tmp")
    stream = fs.create(temporary)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(temporary, target):
        fs.delete(temporary, False)
        raise FileExistsError(path)


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)
