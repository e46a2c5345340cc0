"""Procurement and construction-cost analytics on Spark: typed tables, extraction, grading, pricing, search."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it, if it isn't installed."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])
