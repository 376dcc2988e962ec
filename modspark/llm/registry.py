"""Queries of this subpackage: name → query, name → checking SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it; no change where it is
    installed or on their path already."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        @wraps(run)
        def start(spark: SparkSession, sf_dir: str) -> DataFrame:
            reach_workers(spark)
            return run(spark, sf_dir)

        QUERIES[name] = start
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
