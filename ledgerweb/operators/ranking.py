"""Top-k, keep-first and keep-max."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], k: int, *order: Column) -> DataFrame:
    """Spark limits each group before the shuffle, too."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("__rank") <= k).drop("__rank")


def keep_first(df: DataFrame, key: list[str], *order: Column) -> DataFrame:
    return top_k_per_group(df, key, 1, *order)


def keep_max(df: DataFrame, key: list[str], value: str) -> DataFrame:
    return df.groupBy(*key).agg(F.max(value).alias(value))


def listed(column: Column | str, most: int | None = None) -> Column:
    """The sorted distinct values of a group as one text, the first ``most`` of them."""
    values = F.array_sort(F.collect_set(column))
    return F.array_join(F.slice(values, 1, most) if most else values, ",")


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """``df`` with its rows' places from 1 in a whole order, without one task for all rows.

    Rows are dealt by ranges, numbered within their range and moved on by the sizes of earlier
    ranges, one small row each.
    """
    spark = df.sparkSession
    rows = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("__range", F.spark_partition_id())
    rows = cut(rows, "ranges")
    sizes = rows.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    at = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return rows.withColumn("__at", at).join(sizes, "__range").withColumn(name, F.col("__before") + F.col("__at")).drop("__range", "__at", "__before")
