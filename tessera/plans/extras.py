"""Beyond the inventory: grouping sets, as-of and range joins, correlation, windows (the batch form of the streams)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import extras as X
from tessera.streaming import events as V

from .market import BARS, bars_of
from .registry import query, table


@query("extension", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rollup_counts(spark, d):
    return table(spark, d, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("extension", "SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS quantity FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def cube_quantities(spark, d):
    return table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("extension", "SELECT e.event_id, p.ts AS ts_right, p.price FROM (SELECT * FROM events WHERE event_type = 'purchase') e ASOF LEFT JOIN (SELECT user_id, ts, value AS price FROM events WHERE event_type = 'view') p ON p.user_id = e.user_id AND p.ts <= e.ts")
def as_of_join(spark, d):
    e = table(spark, d, "events")
    left, right = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), e.where("event_type = 'view'").select("user_id", "ts", F.col("value").alias("price"))
    return X.as_of(left, right, "user_id", "ts", ["price"]).select("event_id", "ts_right", "price")


@query("extension", "SELECT p.p_partkey, r.r_regionkey FROM part p JOIN region r ON p.p_retailprice BETWEEN 900 + r.r_regionkey * 30 AND 960 + r.r_regionkey * 30")
def range_join(spark, d):
    r = table(spark, d, "region").select("r_regionkey", (900.0 + F.col("r_regionkey") * 30).alias("low"), (960.0 + F.col("r_regionkey") * 30).alias("high"))
    return X.in_range(table(spark, d, "part"), r, "p_retailprice", "low", "high", 50.0).select("p_partkey", "r_regionkey")


@query("extension", f"WITH {BARS} SELECT a.symbol, count(*) AS n, round(corr(a.close, b.close), 6) AS correlation FROM bars a JOIN bars b ON b.symbol = 1 AND b.day = a.day GROUP BY 1")
def peer_correlation(spark, d):
    return X.correlations(bars_of(spark, d), "symbol", "day", "close", 1)


@query("extension STM-01", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS \"end\", event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1, 2, 3")
def hourly_windows(spark, d):
    return V.tumbling(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 hour", ["event_type"])


@query("extension", """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", user_id, count(*) AS n FROM s GROUP BY user_id, k""")
def user_sessions(spark, d):
    return V.sessions(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "6 hours", ["user_id"])


@query("STM-02", f"WITH {BARS} SELECT symbol, CAST(date_trunc('month', day) AS DATE) AS month, count(*) AS n, max(high - low) AS widest FROM bars GROUP BY 1, 2")
def spread_monitor(spark, d):
    b = bars_of(spark, d)
    return b.groupBy("symbol", F.trunc("day", "month").alias("month")).agg(F.count("*").alias("n"), F.max(F.col("high") - F.col("low")).alias("widest"))


