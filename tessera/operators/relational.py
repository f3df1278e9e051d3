"""Relational operators that reports and work lists are made of."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import exact_avg, share


def share_of_total(df: DataFrame, key: str, digits: int = 1) -> DataFrame:
    """Count of each key and its percent of all rows. Only the groups, not the rows, meet in one window."""
    return df.groupBy(key).agg(F.count("*").alias("n")).withColumn("percentage", share(F.col("n"), F.sum("n").over(Window.partitionBy()), digits))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_k_each(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each key. Spark keeps k rows a key before the shuffle (a group limit below the window)."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(rank) <= k)


def latest_each(df: DataFrame, keys: list[str], order: list[str], ties: list[str] | None = None) -> DataFrame:
    """The newest row of each key by one aggregation (max_by of a struct), so hot keys combine before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    by = F.struct(*order, *(ties or []))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def first_each(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by an order."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*").select(*df.columns)


def missing(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the done ones (an anti-join work list)."""
    return df.join(done.select(*keys), keys, "left_anti")


def present(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(done.select(*keys), keys, "left_semi")


def enrich(df: DataFrame, dim: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join a dimension; Spark broadcasts it while its size in bytes stays under the threshold."""
    return df.join(dim, on, how)


def where_all(df: DataFrame, filters: dict[str, Column | None]) -> DataFrame:
    """Optional filters: those that are given all hold."""
    given = [c for c in filters.values() if c is not None]
    return df.where(reduce(lambda a, b: a & b, given)) if given else df


def counts_if(df: DataFrame, conditions: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Number of rows that meet each named condition."""
    aggs = [F.count(F.when(c, 1)).alias(n) for n, c in conditions.items()]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def labelled_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row (name, n) for each frame."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def batches(df: DataFrame, order: list[Column], size: int, keys: list[str] | None = None) -> DataFrame:
    """Numbers batches of ``size`` rows in order, from 0, within keys (without keys the order is global and one task numbers it)."""
    w = Window.partitionBy(*(keys or [])).orderBy(*order)
    return df.withColumn("batch_no", F.floor((F.row_number().over(w) - 1) / F.lit(size)).cast("int"))


def period_bounds(period: Column) -> tuple[Column, Column]:
    """First and last day of a quarter written as Q1-2024."""
    q, y = F.substring(period, 2, 1).cast("int"), F.substring(period, 4, 4).cast("int")
    first = F.make_date(y, q * 3 - 2, F.lit(1))
    return first, F.last_day(F.add_months(first, 2))


def period_of(day: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(day), F.lit("-"), F.year(day))


def previous_period(day: Column) -> Column:
    return period_of(F.add_months(day, -3))


def month_timeline(df: DataFrame, day: str, months: int) -> DataFrame:
    """Rows a month, the latest months only."""
    return top_k(df.groupBy(F.trunc(F.col(day).cast("date"), "month").alias("month")).agg(F.count("*").alias("n")), [F.desc("month")], months)


def profile(df: DataFrame, key: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Rows, distinct keys, non-null values and their mean."""
    aggs = [F.count("*").alias("rows"), F.countDistinct(key).alias("distinct_keys"), F.count(value).alias("with_value"), exact_avg(value).alias("mean_value")]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column the percent of rows that have a non-empty value."""
    filled = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")
    return df.agg(*[F.round(F.avg(F.when(filled(c), 100.0).otherwise(0.0)), 1).alias(f"{c}_percent") for c in columns])


def first_of(frames: list[DataFrame], keys: list[str], columns: list[str]) -> DataFrame:
    """Source preference: for each key of the first frame, every column from the first frame that has it."""
    out = frames[0].select(*keys, *[F.col(c).alias(f"{c}_0") for c in columns])
    for k, f in enumerate(frames[1:], 1):
        out = out.join(f.select(*keys, *[F.col(c).alias(f"{c}_{k}") for c in columns]), keys, "left")
    return out.select(*keys, *[F.coalesce(*[F.col(f"{c}_{k}") for k in range(len(frames))]).alias(c) for c in columns])


def either_key(df: DataFrame, other: DataFrame, key: str, others: list[str]) -> DataFrame:
    """Join where key equals any of the other side's columns: a union of equi-joins, each pair once."""
    parts = [df.join(other.withColumn("_k", F.lower(o)), F.lower(df[key]) == F.col("_k")).drop("_k") for o in others]
    return reduce(DataFrame.unionByName, parts).distinct()


def contained(a: Column, b: Column) -> Column:
    """Either text holds the other."""
    return F.contains(a, b) | F.contains(b, a)


def _standing(texts: DataFrame, parts: DataFrame, q: int) -> DataFrame:
    """(text, part) of texts(text) and parts(part) where the part stands in the text: a part's rarest run of q characters is looked up
    among the runs of the texts, and what is found is compared; parts of fewer characters are looked up whole."""
    runs = lambda c, n: F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(0))), lambda i: F.substr(F.col(c), i, n))
    own = lambda c, n: F.when(F.length(c) >= n, F.array_distinct(runs(c, n))).otherwise(F.array().cast("array<string>"))
    found = []
    at = texts.select("text", F.explode(own("text", F.lit(q))).alias("run"))
    times = at.groupBy("run").agg(F.count("*").alias("n"))
    long = parts.where(F.length("part") >= q).select("part", F.explode(own("part", F.lit(q))).alias("run")).join(times, "run", "left")
    anchors = long.groupBy("part").agg(F.min_by("run", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "run")).alias("run"))
    found.append(at.join(anchors, "run").where(F.contains("text", "part")).select("text", "part"))
    for n in range(1, q):
        short = texts.select("text", F.explode(own("text", F.lit(n))).alias("part"))
        found.append(short.join(parts.where(F.length("part") == n), "part").select("text", "part"))
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out


def contained_pairs(a: DataFrame, b: DataFrame, name_a: str, name_b: str, q: int = 4) -> DataFrame:
    """Rows of a and b of which one's name holds the other's, by equality of runs of ``q`` characters: no name meets all others.

    Names are compared as they are; null and empty ones match nothing. Repeated rows match each. Columns must not clash.
    """
    x = a.where(F.length(name_a) > 0).select(F.col(name_a).alias("x")).distinct()
    y = b.where(F.length(name_b) > 0).select(F.col(name_b).alias("y")).distinct()
    there = _standing(x.select(F.col("x").alias("text")), y.select(F.col("y").alias("part")), q).select(F.col("text").alias("_x"), F.col("part").alias("_y"))
    back = _standing(y.select(F.col("y").alias("text")), x.select(F.col("x").alias("part")), q).select(F.col("part").alias("_x"), F.col("text").alias("_y"))
    pairs = there.unionByName(back).distinct()
    return a.join(pairs, F.col(name_a) == F.col("_x")).join(b, F.col(name_b) == F.col("_y")).drop("_x", "_y")


def multi_label_counts(df: DataFrame, labels: dict[str, Column], value: str) -> DataFrame:
    """Rows counted under every label they meet: rows, mean of value."""
    own = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in labels.items()]))
    return df.select(F.explode(own).alias("label"), value).groupBy("label").agg(F.count("*").alias("n"), exact_avg(value).alias("mean_value"))
