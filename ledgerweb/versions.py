"""Numbered versions of a table below one folder."""

from __future__ import annotations

from pyspark.sql import SparkSession


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions v0, v1, ... below ``path`` that were written whole, in order."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    found = sorted(int(n[1:]) for n in names if n.startswith("v") and n[1:].isdigit())
    return [n for n in found if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{path}/v{n}/_SUCCESS"))]


def newest(spark: SparkSession, path: str, upto: int | None = None) -> int | None:
    return max((n for n in versions(spark, path) if upto is None or n <= upto), default=None)
