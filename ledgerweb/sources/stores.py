"""A key-value table in the shared folder: namespaces, ages, and sets of keys.

Every change writes a new version beside the last and removes versions before that, so a reader
that has begun ends with what it began with.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_path
from ..versions import newest, versions

SCHEMA = "namespace string, key string, value string, stored timestamp, days int"
#: The namespace of companies that are known to file no annual report, and how long it holds.
NO_FILING, NO_FILING_DAYS = "no_annual_report", 365


class Store:
    """Values by namespace and key; a value older than its days is not there."""

    def __init__(self, spark: SparkSession, path: str, now: datetime | None = None):
        self.spark, self.path = spark, path
        self.now: Column = F.lit(now) if now else F.current_timestamp()

    def table(self) -> DataFrame:
        n = newest(self.spark, self.path)
        rows = self.spark.createDataFrame([], SCHEMA) if n is None else self.spark.read.schema(SCHEMA).parquet(f"{self.path}/v{n}")
        return rows.where(F.col("days").isNull() | (F.date_add(F.col("stored").cast("date"), F.col("days")) >= self.now.cast("date")))

    def _write(self, rows: DataFrame) -> None:
        n = newest(self.spark, self.path)
        rows.write.mode("overwrite").parquet(f"{self.path}/v{0 if n is None else n + 1}")
        for old in versions(self.spark, self.path)[:-2]:
            delete_path(self.spark, f"{self.path}/v{old}")

    def put(self, namespace: str, rows: DataFrame, days: int | None = None) -> None:
        """Store ``rows(key, value)``; of rows with one key the smallest value, over what was there."""
        new = rows.groupBy("key").agg(F.min("value").alias("value")).select(F.lit(namespace).alias("namespace"), "key", "value", self.now.alias("stored"), F.lit(days).cast("int").alias("days"))
        old = self.table().join(new.select("namespace", "key"), ["namespace", "key"], "left_anti")
        self._write(old.unionByName(new))

    def get_many(self, namespace: str, keys: DataFrame) -> DataFrame:
        """key, value of those ``keys(key)`` that are there."""
        return self.table().where(F.col("namespace") == namespace).join(keys.select("key").distinct(), "key", "left_semi").select("key", "value")

    def get(self, namespace: str, key: str) -> str | None:
        found = self.table().where((F.col("namespace") == namespace) & (F.col("key") == key)).first()
        return found.value if found else None

    def keys(self, namespace: str, limit: int | None = None) -> DataFrame:
        out = self.table().where(F.col("namespace") == namespace).select("key").orderBy("key")
        return out.limit(limit) if limit else out

    def count(self, namespace: str | None = None) -> int:
        return (self.table() if namespace is None else self.table().where(F.col("namespace") == namespace)).count()

    def stats(self) -> DataFrame:
        """namespace, entries, chars."""
        return self.table().groupBy("namespace").agg(F.count("*").alias("entries"), F.sum(F.length("value")).alias("chars"))

    def delete(self, namespace: str, keys: DataFrame) -> None:
        gone = keys.select(F.lit(namespace).alias("namespace"), "key").distinct()
        self._write(self.table().join(gone, ["namespace", "key"], "left_anti"))

    def clear(self, namespace: str | None = None) -> int:
        """Remove a namespace, or all; how many entries went."""
        n = self.count(namespace)
        self._write(self.table().where(F.lit(False) if namespace is None else F.col("namespace") != namespace))
        return n

    def trim(self, most_chars: int) -> None:
        """Keep the newest entries whose values have at most ``most_chars`` characters together.

        Sizes are added up by day, then within the one day that crosses the limit.
        """
        size = F.length("value").cast("long")
        days = sorted(((r.day, r.n) for r in self.table().groupBy(F.to_date("stored").alias("day")).agg(F.sum(size).alias("n")).collect()), reverse=True)
        left, crossed = most_chars, None
        for day, n in days:
            if n > left:
                crossed = day
                break
            left -= n
        if crossed is None:
            return
        table = self.table().withColumn("day", F.to_date("stored"))
        run = F.sum(size).over(Window.partitionBy("day").orderBy(F.desc("stored"), "namespace", "key").rowsBetween(Window.unboundedPreceding, 0))
        edge = table.where(F.col("day") == F.lit(crossed)).withColumn("run", run).where(F.col("run") <= left).drop("run")
        self._write(table.where(F.col("day") > F.lit(crossed)).unionByName(edge).drop("day"))

    def mark_no_filing(self, ciks: DataFrame) -> None:
        self.put(NO_FILING, ciks.select(F.col("cik").cast("string").alias("key"), F.lit("").alias("value")), NO_FILING_DAYS)

    def no_filing(self) -> DataFrame:
        return self.keys(NO_FILING).withColumnRenamed("key", "cik")

