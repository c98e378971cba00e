"""Lets Python workers import this library where the driver found it by sys.path alone."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def to_workers(spark: SparkSession) -> None:
    """Put the library's folder on the workers' path; where they have the library installed this changes nothing."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
