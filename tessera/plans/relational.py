"""Relational core: reports, work lists, filters, joins, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import exact_avg, exact_sum
from tessera.operators import relational as R

from .registry import query, table


@query("WIN-01 AGG-02 SRC-09", "SELECT o_orderstatus, count(*) AS n, CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS DOUBLE) AS percentage FROM orders GROUP BY 1")
def status_share(spark, d):
    return R.share_of_total(table(spark, d, "orders"), "o_orderstatus")


@query("AGG-02", "SELECT p_type, count(*) AS n, CAST(sum(CAST(p_retailprice AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS mean_price, max(p_retailprice) AS max_price FROM part GROUP BY 1")
def category_usage(spark, d):
    return table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n"), exact_avg("p_retailprice").alias("mean_price"), F.max("p_retailprice").alias("max_price"))


@query("SRT-01 SRT-02", "SELECT p_name, p_brand, count(*) AS use_count FROM part GROUP BY 1, 2 ORDER BY use_count DESC, p_brand, p_name LIMIT 20")
def top_keywords(spark, d):
    used = table(spark, d, "part").groupBy("p_name", "p_brand").agg(F.count("*").alias("use_count"))
    return R.top_k(used, [F.desc("use_count"), F.asc("p_brand"), F.asc("p_name")], 20)


@query("AGG-01 ARR-01", """SELECT count(*) AS rows, count(DISTINCT o_custkey) AS distinct_keys, count(o_totalprice) AS with_value,
 CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / count(o_totalprice) AS mean_value FROM orders""")
def extraction_stats(spark, d):
    return R.profile(table(spark, d, "orders"), "o_custkey", "o_totalprice")


@query("AGG-04 AGG-03", """SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) FILTER (WHERE o_orderstatus = 'O') AS open, count(*) FILTER (WHERE o_orderstatus = 'P') AS pending,
 count(CASE WHEN o_totalprice > 300000 THEN 1 END) AS large, count(*) AS total FROM orders""")
def status_filter_counts(spark, d):
    s = F.col("o_orderstatus")
    return R.counts_if(table(spark, d, "orders"), {"done": s == "F", "open": s == "O", "pending": s == "P", "large": F.col("o_totalprice") > 300000, "total": F.lit(True)})


@query("AGG-03", """SELECT o_orderpriority, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS granted, count(CASE WHEN o_orderstatus <> 'F' THEN 1 END) AS waiting FROM orders GROUP BY 1""")
def conditional_counts(spark, d):
    return R.counts_if(table(spark, d, "orders"), {"granted": F.col("o_orderstatus") == "F", "waiting": F.col("o_orderstatus") != "F"}, ["o_orderpriority"])


@query("AGG-10", "SELECT l_returnflag, CAST(CAST(CAST(sum(CAST(l_discount AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS DECIMAL(4,3)) AS DOUBLE) AS avg_confidence FROM lineitem GROUP BY 1")
def numeric43_avg(spark, d):
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(exact_avg("l_discount").cast("decimal(4,3)").cast("double").alias("avg_confidence"))


@query("SET-01", "SELECT 'orders' AS name, count(*) AS n FROM orders UNION ALL SELECT 'customers', count(*) FROM customer UNION ALL SELECT 'parts', count(*) FROM part")
def union_table_counts(spark, d):
    return R.labelled_counts({"orders": table(spark, d, "orders"), "customers": table(spark, d, "customer"), "parts": table(spark, d, "part")})


@query("JON-03 SRT-05", """SELECT d.doc_id, d.source, d.n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL AND d.text <> '' ORDER BY d.n_chars DESC, d.doc_id LIMIT 100""")
def unprocessed_worklist(spark, d):
    todo = R.missing(table(spark, d, "documents").where("text <> ''"), table(spark, d, "labels"), ["doc_id"])
    return R.top_k(todo.select("doc_id", "source", "n_chars"), [F.desc("n_chars"), F.asc("doc_id")], 100)


@query("JON-04", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def not_in_missing(spark, d):
    done = table(spark, d, "orders").where("o_custkey IS NOT NULL").select(F.col("o_custkey").alias("c_custkey"))
    return R.missing(table(spark, d, "customer"), done, ["c_custkey"]).select("c_custkey", "c_name")


@query("JON-05", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')")
def exists_probe(spark, d):
    done = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return R.present(table(spark, d, "customer"), done, ["c_custkey"]).select("c_custkey")


@query("JON-02 FIL-08", "SELECT d.doc_id, d.lang, l.quality, CASE WHEN l.toxic = 1 THEN 'flagged' WHEN l.toxic = 0 THEN 'clean' ELSE 'unknown' END AS state FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def left_join_enrich(spark, d):
    rows = R.enrich(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])
    state = F.when(F.col("toxic") == 1, "flagged").when(F.col("toxic") == 0, "clean").otherwise("unknown")
    return rows.select("doc_id", "lang", "quality", state.alias("state"))


@query("JON-01 STR-23", """SELECT o.o_orderkey, upper(c.c_mktsegment) AS segment, left(n.n_name, 5) AS nation, o.o_totalprice FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def three_way_export(spark, d):
    rows = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("o_orderkey", F.upper("c_mktsegment").alias("segment"), F.left("n_name", F.lit(5)).alias("nation"), "o_totalprice")


@query("JON-14 SNK-05", """SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def latest_per_key(spark, d):
    return R.latest_each(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("JON-14 WIN-22", """SELECT o_orderkey, o_custkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous FROM orders""")
def previous_per_key(spark, d):
    from pyspark.sql import Window

    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, d, "orders").select("o_orderkey", "o_custkey", F.lag("o_orderkey").over(w).alias("previous"))


@query("JON-16", """SELECT c_custkey, (SELECT count(*) FROM orders o WHERE o.o_custkey = c.c_custkey) AS n_orders, (SELECT max(o_totalprice) FROM orders o WHERE o.o_custkey = c.c_custkey) AS max_price FROM customer c""")
def scalar_subquery_bucket(spark, d):
    own = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.max("o_totalprice").alias("max_price"))
    return R.enrich(table(spark, d, "customer").select("c_custkey"), own, ["c_custkey"]).select("c_custkey", F.coalesce("n", F.lit(0)).alias("n_orders"), "max_price")


@query("AGG-06", """SELECT CASE WHEN l_partkey % 2 = 0 THEN l_suppkey ELSE l_partkey END AS partner, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, partner LIMIT 10""")
def case_partner_top(spark, d):
    partner = F.when(F.col("l_partkey") % 2 == 0, F.col("l_suppkey")).otherwise(F.col("l_partkey"))
    return R.top_k(table(spark, d, "lineitem").groupBy(partner.alias("partner")).agg(F.count("*").alias("n")), [F.desc("n"), F.asc("partner")], 10)


@query("AGG-07 DAT-02", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 12")
def month_timeline(spark, d):
    return R.month_timeline(table(spark, d, "orders"), "o_orderdate", 12)


@query("AGG-08 ARR-01 FIL-06", """SELECT p_brand, string_agg(w, ',' ORDER BY w) AS words, count(*) AS n FROM (SELECT DISTINCT p_brand, unnest(string_split(p_name, ' ')) AS w FROM part) GROUP BY 1""")
def unnest_portfolio(spark, d):
    words = table(spark, d, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("w")).distinct()
    return words.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("w")), ",").alias("words"), F.count("*").alias("n"))


@query("AGG-05", """SELECT l_suppkey, count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS deals, CAST(sum(CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS DECIMAL(18,4))) AS DOUBLE) AS total,
 CAST(sum(CAST(CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS DECIMAL(18,4))) AS DOUBLE) / count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS mean FROM lineitem GROUP BY 1""")
def deal_stats(spark, d):
    value = F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice"))
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.countDistinct(F.when(F.col("l_returnflag") == "R", F.col("l_orderkey"))).alias("deals"), exact_sum(value).alias("total"), exact_avg(value).alias("mean"))


@query("AGG-11", """SELECT l_suppkey, round(CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END), 0) + 1e-9, 3) AS ratio FROM lineitem GROUP BY 1""")
def put_call_ratio(spark, d):
    side = lambda s: F.sum(F.when(F.col("l_linestatus") == s, F.col("l_quantity")).otherwise(0.0))
    return table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.try_divide(side("F"), side("O")) + 1e-9, 3).alias("ratio"))


@query("FIL-03 DAT-02", """SELECT o_orderkey, 'Q' || quarter(o_orderdate) || '-' || year(o_orderdate) AS period, 'Q' || quarter(o_orderdate - INTERVAL 3 MONTH) || '-' || year(o_orderdate - INTERVAL 3 MONTH) AS previous
 FROM orders WHERE o_orderdate BETWEEN DATE '1997-04-01' AND DATE '1997-06-30'""")
def period_between(spark, d):
    first, last = R.period_bounds(F.lit("Q2-1997"))
    day = F.col("o_orderdate").cast("date")
    return table(spark, d, "orders").where(day.between(first, last)).select("o_orderkey", R.period_of(day).alias("period"), R.previous_period(day).alias("previous"))


@query("SRT-03", """SELECT c.c_custkey, o.last FROM customer c LEFT JOIN (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey ORDER BY o.last ASC NULLS FIRST, c.c_custkey LIMIT 50""")
def nulls_first_queue(spark, d):
    last = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").cast("date").alias("last"))
    return R.top_k(R.enrich(table(spark, d, "customer").select("c_custkey"), last, ["c_custkey"]), [F.asc_nulls_first("last"), F.asc("c_custkey")], 50)


@query("SET-08 JON-08", """SELECT name, p_partkey FROM (SELECT lower(p_name) AS name, p_partkey, row_number() OVER (PARTITION BY lower(p_name) ORDER BY p_partkey) AS r FROM part) WHERE r = 1""")
def dedup_ci(spark, d):
    return R.first_each(table(spark, d, "part").select(F.lower("p_name").alias("name"), "p_partkey"), ["name"], ["p_partkey"])


@query("SET-05", """SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' EXCEPT SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'""")
def set_diff(spark, d):
    o = table(spark, d, "orders")
    cut = F.lit("2000-01-01").cast("timestamp")
    return o.where(F.col("o_orderdate") >= cut).select("o_custkey").subtract(o.where(F.col("o_orderdate") < cut).select("o_custkey"))


@query("SET-03 SET-04", "SELECT l_suppkey AS id FROM lineitem UNION SELECT l_partkey FROM lineitem")
def union_distinct_ids(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(F.col("l_suppkey").alias("id")).union(li.select("l_partkey")).distinct()


@query("SET-02", """SELECT kind, count(*) AS n FROM (SELECT 'out ' || l_returnflag AS kind FROM lineitem UNION ALL SELECT 'in ' || l_linestatus FROM lineitem) GROUP BY 1""")
def both_direction_types(spark, d):
    li = table(spark, d, "lineitem")
    both = li.select(F.concat(F.lit("out "), "l_returnflag").alias("kind")).union(li.select(F.concat(F.lit("in "), "l_linestatus")))
    return both.groupBy("kind").agg(F.count("*").alias("n"))


@query("SET-07 SET-06", """SELECT p_brand, string_agg(t, ',' ORDER BY t) AS types FROM (SELECT p_brand, t, row_number() OVER (PARTITION BY p_brand ORDER BY t) AS r FROM (SELECT DISTINCT p_brand, p_type AS t FROM part)) WHERE r <= 3 GROUP BY 1""")
def capped_array_union(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.array_join(F.slice(F.array_distinct(F.array_sort(F.collect_set("p_type"))), 1, 3), ",").alias("types"))


@query("FIL-01 FIL-02 FIL-04 FIL-05 FIL-07 OUT-01", """SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1999-06-01' AND o_orderstatus IN ('F', 'P') AND o_orderpriority LIKE '%URGENT%' AND o_orderstatus NOT IN ('X') AND o_totalprice IS NOT NULL""")
def filtered_rows(spark, d):
    filters = {
        "since": F.col("o_orderdate") >= F.lit("1999-06-01").cast("timestamp"), "status": F.col("o_orderstatus").isin("F", "P"), "priority": F.col("o_orderpriority").contains("URGENT"),
        "not_status": ~F.col("o_orderstatus").isin("X"), "price": F.col("o_totalprice").isNotNull(), "customer": None,
    }
    return R.where_all(table(spark, d, "orders"), filters).select("o_orderkey")


@query("SRC-01 SRC-02 SRC-03", "SELECT l_orderkey, l_shipdate, l_extendedprice FROM lineitem WHERE l_suppkey = 7 AND l_shipdate >= TIMESTAMP '1998-01-01' ORDER BY l_shipdate")
def symbol_scan(spark, d):
    return table(spark, d, "lineitem").where((F.col("l_suppkey") == 7) & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp"))).select("l_orderkey", "l_shipdate", "l_extendedprice")


@query("FIL-09 FIL-15 FIL-16", """SELECT o_orderkey, CAST(o_orderdate AS DATE) + 90 AS due, datediff('day', DATE '2001-06-01', CAST(o_orderdate AS DATE) + 90) AS days_left FROM orders
 WHERE CAST(o_orderdate AS DATE) + 90 >= DATE '2001-06-01' AND o_orderdate + INTERVAL 7776000 SECOND < TIMESTAMP '2001-09-01'""")
def pending_deadlines(spark, d):
    due = F.date_add(F.col("o_orderdate").cast("date"), 90)
    as_of = F.lit("2001-06-01").cast("date")
    expired = F.col("o_orderdate") + F.make_interval(secs=F.lit(7776000)) < F.lit("2001-09-01").cast("timestamp")
    return table(spark, d, "orders").where((due >= as_of) & expired).select("o_orderkey", due.alias("due"), F.datediff(due, as_of).cast("long").alias("days_left"))


@query("AGG-09", """SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_date, CAST(max(o_orderdate) AS DATE) AS last_date, count(DISTINCT o_orderstatus) AS kinds FROM orders GROUP BY 1""")
def date_range_by_key(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").cast("date").alias("first_date"), F.max("o_orderdate").cast("date").alias("last_date"), F.countDistinct("o_orderstatus").alias("kinds"))


@query("AGG-12 WIN-28", """SELECT p_type, p_brand, n FROM (SELECT *, row_number() OVER (PARTITION BY p_type ORDER BY n DESC, p_brand) AS r FROM (SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2)) WHERE r <= 3""")
def most_common_each(spark, d):
    counts = table(spark, d, "part").groupBy("p_type", "p_brand").agg(F.count("*").alias("n"))
    return R.top_k_each(counts, ["p_type"], [F.desc("n"), F.asc("p_brand")], 3).drop("rank")


@query("JON-06 DAT-02", """SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS pairs FROM orders o JOIN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS sd FROM lineitem WHERE l_suppkey = 3) l ON CAST(o.o_orderdate AS DATE) = l.sd GROUP BY 1""")
def date_join(spark, d):
    ships = table(spark, d, "lineitem").where("l_suppkey = 3").select(F.to_date("l_shipdate").alias("day")).distinct()
    return table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).join(ships, "day").groupBy("day").agg(F.count("*").alias("pairs"))


@query("JON-11 MLV-12", """SELECT DISTINCT n.n_name, p.p_partkey FROM nation n JOIN part p ON 'brand#' || n.n_nationkey = lower(p.p_brand) OR 'brand#' || n.n_nationkey = lower(p.p_type)""")
def either_column_join(spark, d):
    n = table(spark, d, "nation").select("n_name", F.concat(F.lit("Brand#"), "n_nationkey").alias("ref"))
    return R.either_key(n, table(spark, d, "part").select("p_partkey", "p_brand", "p_type"), "ref", ["p_brand", "p_type"]).select("n_name", "p_partkey").distinct()


@query("JON-12", "SELECT r_name, s.v AS keyword FROM region CROSS JOIN (VALUES ('alpha'), ('beta'), ('gamma')) s(v)")
def keyword_groups(spark, d):
    return table(spark, d, "region").select("r_name", F.explode(F.array(F.lit("alpha"), F.lit("beta"), F.lit("gamma"))).alias("keyword"))


@query("JON-15", "SELECT DISTINCT l.l_suppkey, s.s_name FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey")
def partner_names(spark, d):
    ids = table(spark, d, "lineitem").select("l_suppkey").distinct()
    return R.enrich(ids, table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name"), ["l_suppkey"])


@query("JON-17", """SELECT d.doc_id, coalesce(CASE WHEN l.quality = 1 THEN 'labelled' END, CASE WHEN b.item_id IS NOT NULL THEN 'benchmark' END, d.source) AS origin FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN benchmark b ON b.item_id = d.doc_id""")
def source_preference(spark, d):
    a = table(spark, d, "documents").select("doc_id")
    frames = [
        R.enrich(a, table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "labelled").alias("origin")), ["doc_id"]),
        table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"), F.lit("benchmark").alias("origin")), table(spark, d, "documents").select("doc_id", F.col("source").alias("origin")),
    ]
    return R.first_of(frames, ["doc_id"], ["origin"])


@query("AGG-23 AGG-32", """SELECT round(avg(CASE WHEN trim(c_name) <> '' THEN 100.0 ELSE 0.0 END), 1) AS c_name_percent, round(avg(CASE WHEN trim(CAST(c_acctbal AS VARCHAR)) <> '' THEN 100.0 ELSE 0.0 END), 1) AS c_acctbal_percent FROM customer""")
def column_coverage(spark, d):
    return R.coverage(table(spark, d, "customer"), ["c_name", "c_acctbal"])
