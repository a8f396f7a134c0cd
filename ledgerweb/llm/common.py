"""Helpers shared by the operators: batches, row identity and, from the session module, cut points."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import cut, delete_path, fresh_path, release, scratch, shared_dir

__all__ = ["crc_of_id", "cut", "delete_path", "fresh_path", "partitions", "release", "scratch", "shared_dir", "small_batches"]

#: Rows and bytes that go to a Python worker at once; whole texts can be long.
BATCH_ROWS, BATCH_BYTES = 1000, 16 * 1024 * 1024


def small_batches(spark: SparkSession) -> None:
    """Bound what is sent at once, for all that this session still runs: results are lazy, so it can't be undone here."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
