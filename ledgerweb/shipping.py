"""Brings the package to Python workers that can't import it from where they are."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: "weakref.WeakSet" = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Once for each context: the package as an archive that Spark hands to every executor."""
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for f in sorted(package.rglob("*.py")):
            archive.write(f, f.relative_to(package.parent))
    context.addPyFile(path)
    _shipped.add(context)


def shipping(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
