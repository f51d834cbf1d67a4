"""A Spark session with the settings that the engine expects."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def session(name: str = "folioflow", **conf: str) -> SparkSession:
    """UTC, adaptive plans, column pruning and pushdown as Spark has them by default."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return reachable(b.getOrCreate())


def reachable(spark: SparkSession) -> SparkSession:
    """Python workers import this package from where the driver does."""
    root = str(Path(__file__).resolve().parents[1])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    return spark
