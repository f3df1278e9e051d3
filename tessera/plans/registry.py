"""Names of queries, the survey operators each one covers, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
COVERS: dict[str, str] = {}


def query(covers: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name."""

    def put(f):
        QUERIES[f.__name__] = f
        COVERS[f.__name__] = covers
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
