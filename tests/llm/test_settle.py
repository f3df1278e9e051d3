"""Shuffles whose results are staged take no more disk."""

from pathlib import Path

from tessera.llm import common


def test_shuffles_of_staged_tables_go(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {p for d in dirs for p in Path(d).rglob("shuffle_*.data")}
    before = files()
    common.staged(spark.range(100_000).repartition(4, "id"), "settle")
    made = files() - before
    common.settle(spark)
    assert made and not made & files()
