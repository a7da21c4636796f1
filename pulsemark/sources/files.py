"""Small path helpers over Spark's own file system layer."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a glob, sorted by name; empty if there are none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = system.globStatus(path)
    return sorted(s.getPath().toString() for s in found) if found else []


def exists(spark: SparkSession, pattern: str) -> bool:
    return bool(matches(spark, pattern))


def complete(spark: SparkSession, pattern: str) -> list[str]:
    """Directories matching a glob whose write finished."""
    done = matches(spark, f"{pattern}/_SUCCESS")
    return [p.rsplit("/", 1)[0] for p in done]


def write_record(spark: SparkSession, record: dict, path: str, mode: str = "errorifexists") -> None:
    """One JSON record as a one-line text dataset."""
    line = spark.createDataFrame([(json.dumps(record),)], "value string")
    line.coalesce(1).write.mode(mode).text(path)


def read_record(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])

