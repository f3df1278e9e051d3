"""Operators beside the inventory: cubes, as-of and range joins, correlation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, columns: list[str]) -> DataFrame:
    """Each left row with the last right row of its key at or before its time.

    Both sides meet in one union sorted by key and time, and the last right values are carried on: one shuffle and no
    pairs, whatever the number of right rows before a left one.
    """
    held = F.struct(F.col(time).alias("_time"), *columns)
    both = left.withColumn("_left", F.lit(True)).withColumn("_r", F.lit(None).cast(right.select(held.alias("h")).schema["h"].dataType))
    other = right.select(key, time, F.lit(False).alias("_left"), held.alias("_r"))
    rows = both.unionByName(other, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.col(time), F.col("_left")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_last", F.last("_r", ignorenulls=True).over(w)).where("_left")
    return rows.select(*left.columns, F.col("_last._time").alias(f"{time}_right"), *[F.col(f"_last.{c}").alias(c) for c in columns])


def in_range(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: float) -> DataFrame:
    """Points with the ranges that hold them: an equi-join on buckets of ``width``, then the exact test. A range goes to all
    buckets it meets, so choose a width near the usual range."""
    p = points.withColumn("_b", F.floor(F.col(point) / width))
    r = ranges.withColumn("_b", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    return p.join(r, "_b").where((F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high))).drop("_b")


def correlations(bars: DataFrame, symbol: str, time: str, value: str, base) -> DataFrame:
    """Correlation of every symbol's values with those of a base symbol at equal times."""
    b = bars.where(F.col(symbol) == base).select(time, F.col(value).alias("_b"))
    return bars.join(b, time).groupBy(symbol).agg(F.count("*").alias("n"), F.round(F.corr(value, "_b"), 6).alias("correlation"))
