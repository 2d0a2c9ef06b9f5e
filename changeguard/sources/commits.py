"""Commit files: the one step of a write that either happened or did not.

A commit is one small file, created only if it does not exist yet.  Data files
written before it are invisible until it is there, so a job that dies in
between leaves nothing behind that a reader would see, and of two writers that
started from the same state one is told it lost.  A file that is still empty is
a commit under way: readers pass over it, and the next writer is refused.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from changeguard.errors import UnresolvedWrite


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def write_once(spark: SparkSession, path: str, content: dict) -> bool:
    """Create the file with this content; False when it is already there."""
    target, fs = _path(spark, path)
    fs.mkdirs(target.getParent())
    try:
        out = fs.create(target, False)
    except Exception as error:
        if fs.exists(target):
            return False
        raise UnresolvedWrite(f"commit {path}: {error}") from error
    try:
        out.write(json.dumps(content, sort_keys=True).encode())
        out.close()
    except Exception as error:
        raise UnresolvedWrite(f"commit {path}: {error}") from error
    return True


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    target, fs = _path(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(target)) if fs.exists(target) else []


def remove(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, folder: str) -> list[str]:
    """File names of the commits in a folder, in order."""
    target, fs = _path(spark, folder)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def last(spark: SparkSession, folder: str) -> dict | None:
    """Content of the newest commit; older ones are not opened."""
    for name in reversed(names(spark, folder)):
        row = spark.read.text(f"{folder}/{name}", wholetext=True).head()
        if row is not None and row.value:
            return json.loads(row.value)
    return None


def read_all(spark: SparkSession, folder: str) -> list[dict]:
    """Contents of every commit in a folder, in name order."""
    if not exists(spark, folder):
        return []
    rows = spark.read.text(folder, wholetext=True).select("value", "_metadata.file_name").collect()
    return [json.loads(row.value) for row in sorted(rows, key=lambda r: r.file_name) if row.value]


def table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Commits as rows, for joins that need all of them."""
    if not exists(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(folder)
