"""Streams of observations kept as latest-value tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import delete_path
from ..versions import newest, versions


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events by type and tumbling window; events later than the watermark are dropped."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type")
        .agg(F.count("*").alias("n"), F.sum("value").alias("total"))
        .select(F.col("w.start").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))
    )


def keep_latest(stream: DataFrame, path: str, key: list[str], order: list[str], columns: list[str], checkpoint: str) -> StreamingQuery:
    """Fold every micro-batch into versions of a table under ``path``; ``read_latest`` reads the last.

    The table keeps beside every value the order that it came with, so a value that comes late
    never takes the place of a newer one.  A batch writes a version named by its number, so a
    repeated batch rewrites its own version and is folded once; the one before it stays for
    readers, older ones go.
    """
    spark = stream.sparkSession
    kept = [*key, *columns, *(f"__at_{c}" for c in columns)]

    def fold(batch: DataFrame, number: int) -> None:
        at = F.struct(*order)
        rows = batch.select(*key, *columns, *(F.when(F.col(c).isNotNull(), at).alias(f"__at_{c}") for c in columns))
        before = newest(spark, path, number - 1)
        if before is not None:
            rows = rows.unionByName(spark.read.parquet(f"{path}/v{before}").select(*kept))
        last = [F.max_by(c, f"__at_{c}").alias(c) for c in columns] + [F.max(f"__at_{c}").alias(f"__at_{c}") for c in columns]
        rows.groupBy(*key).agg(*last).write.mode("overwrite").parquet(f"{path}/v{number}")
        for old in versions(spark, path)[:-2]:
            delete_path(spark, f"{path}/v{old}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_latest(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame | None:
    """The table's newest version, at most number ``upto``."""
    n = newest(spark, path, upto)
    if n is None:
        return None
    out = spark.read.parquet(f"{path}/v{n}")
    return out.select(*(c for c in out.columns if not c.startswith("__at_")))
