"""Where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Used only where the session names no ``spark.checkpoint.dir`` and runs in one process (tests, local runs).
LOCAL_CHECKPOINTS = "/tmp/checkpoints"
#: Removes a query's shuffle files as soon as it has ended.
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; an error where a cluster names none."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"file://{LOCAL_CHECKPOINTS}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; removed when the driver's Python ends normally."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


def _clean() -> None:
    for spark, path in list(_written):
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may have gone already
            return


def delete_path(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def _freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles inside is removed when it ends, not when the JVM next collects its garbage."""
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Lineage ends here: a lost executor costs the tasks that read from it, never the work
    that made the table, and the optimiser sees the true size of what follows.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    with _freed_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Remove tables that ``cut`` returned and that nothing will read again."""
    for table in tables:
        if path := getattr(table, "_cut_path", None):
            spark = table.sparkSession
            delete_path(spark, path)
            _written[:] = [x for x in _written if x[1] != path]


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """On leaving, all tables written inside go, but for those added to the list that it gives."""
    before, kept = {path for _, path in _written}, []
    yield kept
    stay = before | {getattr(t, "_cut_path", None) for t in kept}
    for spark, path in [x for x in _written if x[1] not in stay]:
        delete_path(spark, path)
    _written[:] = [x for x in _written if x[1] in stay]
