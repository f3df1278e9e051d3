"""Shared pieces of the training-data operators: staging in the shared folder, components of a link graph."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Stands for a null id inside Python code, where a nullable long would turn into a float.
NULL_ID = -(1 << 63)


def id_in(column: str):
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def id_out(column: str):
    return F.nullif(F.col(column), F.lit(NULL_ID)).alias(column)


#: Bytes of a Parquet row group, which each writing task holds in memory; texts are wide.
ROW_GROUP = 32 << 20


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Bounds what a task that handles texts holds: batches of at most so many rows go to Python workers, and a session that sets
    no size of Parquet row groups writes small ones. Both settings stay with the session, as results are computed later."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))
    if spark.conf.get("parquet.block.size", None) is None:
        spark.conf.set("parquet.block.size", str(ROW_GROUP))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one is made only for a local master that names none, as in tests."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf


def own_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/tessera-{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Delete what this application staged; results that are not yet written need it until then."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(own_dir(spark))
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once into the shared folder and read it back: lineage ends there and survives lost executors."""
    spark = df.sparkSession
    path = f"{own_dir(spark)}/{name}-{uuid.uuid4().hex}"
    # a writer holds a row group in memory, so they are small
    df.write.option("compression", "zstd").option("parquet.block.size", ROW_GROUP).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the staged table that df reads, once what was made of it is written too."""
    files = df.inputFiles()
    if files and f"/{own_dir(df.sparkSession).rpartition('/')[2]}/" in files[0]:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Frees the disk of shuffles whose results are staged: Spark deletes them once the driver finds that no plan refers to them. Python
    lets go of its plans in the background, so it looks twice."""
    for _ in range(2):
        gc.collect()
        time.sleep(0.7)
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


def _union_find(batches):
    """(node, component) of all edges (u, v) of one partition."""
    parts = [pdf[["u", "v"]].to_numpy(np.int64) for pdf in batches]
    if not parts:
        return
    both = np.concatenate(parts)
    names, ends = np.unique(both, return_inverse=True)
    ends = ends.reshape(both.shape)
    low = np.arange(len(names))
    while True:  # least labels of neighbours, then of labels, until nothing moves
        new = low.copy()
        np.minimum.at(new, ends[:, 0], low[ends[:, 1]])
        np.minimum.at(new, ends[:, 1], low[ends[:, 0]])
        np.minimum.at(new, low[ends[:, 0]], low[ends[:, 1]])
        np.minimum.at(new, low[ends[:, 1]], low[ends[:, 0]])
        new = new[new]
        if (new == low).all():
            break
        low = new
    yield pd.DataFrame({"node": names, "component": names[low]})


def components(edges: DataFrame, name: str, rounds: int = 40, small: int = 200_000) -> DataFrame:
    """Connected components of edges(a long, b long): rows (node, component) with the smallest node reachable.

    Up to ``small`` edges (counted first; 16 bytes each) one task labels them. Beyond, alternates large-star and small-star steps, each an aggregation and a join of rows no more than the edges;
    no neighbour list is collected. Each round is staged, so a lost executor costs one round at most.
    """
    e = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-edges")

    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    last = digest(e)
    if last[0] <= small:
        return staged(e.coalesce(1).mapInPandas(_union_find, "node long, component long"), f"{name}-labels")
    for k in range(rounds):
        if not last[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = staged(small.where("u <> v").distinct(), f"{name}-round{k}")
        now = digest(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components: no fixed point after {rounds} rounds")
    # every edge now leads to its component's smallest node, which has none of its own
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def pick(rows: DataFrame, keys: DataFrame, on: list[str], how: str, small: int = 1_000_000) -> DataFrame:
    """Semi or anti join with a staged key list: by broadcast up to ``small`` keys, by a shuffle beyond."""
    keys = keys.distinct()
    return rows.join(F.broadcast(keys) if keys.count() <= small else keys, on, how)
