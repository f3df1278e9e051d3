"""The folder that driver and executors share: cutting lineage in loops, and files that queries write and read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where the session names none, a temporary folder serves a local master; a cluster must name one."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in this application's part of the shared folder."""
    return f"{shared_dir(spark)}/tessera-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, **options) -> DataFrame:
    """df written once to the shared folder and read back: lineage ends there, and so does what the planner carries from round to
    round of a loop (a checkpointed plan keeps its constraints, which multiply). ``options`` are those of the writer."""
    path = new_path(df.sparkSession, "cut")
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
