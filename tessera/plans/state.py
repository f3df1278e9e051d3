"""Upserts, parameters and ingest bound to orders, events and literal tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import valid_email
from tessera.operators import breaker as B
from tessera.operators import state as U

from .registry import query, table


@query("UPS-01 SNK-02", """WITH a AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate AS changed FROM orders WHERE o_orderkey % 3 > 0), b AS (SELECT o_orderkey, o_custkey + 1 AS o_custkey, o_totalprice * 2 AS o_totalprice, o_orderdate + INTERVAL 1 DAY AS changed FROM orders WHERE o_orderkey % 2 = 0)
 SELECT o_orderkey, o_custkey, o_totalprice, changed FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY changed DESC, o_custkey DESC) AS r FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) WHERE r = 1""")
def upsert_latest(spark, d):
    o = table(spark, d, "orders")
    a = o.where("o_orderkey % 3 > 0").select("o_orderkey", "o_custkey", "o_totalprice", F.col("o_orderdate").alias("changed"))
    b = o.where("o_orderkey % 2 = 0").select("o_orderkey", (F.col("o_custkey") + 1).alias("o_custkey"), (F.col("o_totalprice") * 2).alias("o_totalprice"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("changed"))
    return U.upsert(a, b, ["o_orderkey"], ["changed", "o_custkey"])


@query("SNK-03 SNK-01", "SELECT c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, 'new' FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 <> 0")
def insert_absent(spark, d):
    c = table(spark, d, "customer")
    return U.insert_absent(c.where("c_custkey % 2 = 0").select("c_custkey", "c_name"), c.where("c_custkey % 3 = 0").select("c_custkey", F.lit("new").alias("c_name")), ["c_custkey"])


@query("SNK-04 SNK-09", "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'F' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE NOT (o_totalprice < 50000)")
def update_and_delete(spark, d):
    rows = U.delete_where(table(spark, d, "orders"), F.col("o_totalprice") < 50000)
    return U.update_where(rows, F.col("o_orderkey") % 10 == 0, {"o_orderstatus": F.lit("F")}).select("o_orderkey", "o_orderstatus")


@query("SNK-05", "SELECT event_id, user_id, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1 THEN -1.0::DOUBLE ELSE value END AS value FROM events")
def update_latest(spark, d):
    return U.update_latest(table(spark, d, "events"), ["user_id"], "ts", {"value": F.lit(-1.0)}).select("event_id", "user_id", "value")


@query("UPS-02", "SELECT user_id, event_type, count(*) AS failure_count, min(ts) AS created_at, max(ts) AS updated_at FROM events WHERE event_type = 'error' GROUP BY 1, 2")
def counter_upsert(spark, d):
    return U.counters(table(spark, d, "events").where("event_type = 'error'"), ["user_id", "event_type"], "ts")


@query("UPS-08", "WITH s AS (SELECT user_id, max(ts) AS last FROM events WHERE event_type = 'purchase' GROUP BY 1) SELECT e.event_id, CASE WHEN last > ts THEN 'resolved' ELSE 'active' END AS state FROM events e LEFT JOIN s ON s.user_id = e.user_id WHERE event_type = 'error'")
def alert_resolution(spark, d):
    e = table(spark, d, "events")
    return U.resolve_on_success(e.where("event_type = 'error'"), e.where("event_type = 'purchase'"), "user_id", "ts").select("event_id", "state")


@query("UPS-04", "SELECT l_suppkey, l_returnflag, count(*) AS event_count, min(l_shipdate) AS first_seen, max(l_shipdate) AS last_seen FROM lineitem GROUP BY 1, 2")
def bucket_agg(spark, d):
    return U.buckets(table(spark, d, "lineitem"), ["l_suppkey", "l_returnflag"], "l_shipdate")


@query("UPS-05", "SELECT user_id, event_type AS state FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def status_latest(spark, d):
    from tessera.operators.relational import latest_each

    return latest_each(table(spark, d, "events").select("user_id", F.col("event_type").alias("state"), "ts", "event_id"), ["user_id"], ["ts", "event_id"]).select("user_id", "state")


#: Every part as a parameter: a dotted key, its default, and for large ones a stored value.
PARAMS = """p AS (SELECT CASE WHEN p_size <= 15 THEN 'risk.' WHEN p_size <= 35 THEN 'chunk.' ELSE 'other.' END || 'p' || p_partkey AS param_key, CAST(p_size AS VARCHAR) AS value, CASE WHEN p_retailprice > 950 THEN CAST(p_size * 2 AS VARCHAR) END AS v FROM part)"""


def parameters(spark, d):
    """(defaults, stored values) of the parameters that the parts make."""
    k = F.concat(F.when(F.col("p_size") <= 15, "risk.").when(F.col("p_size") <= 35, "chunk.").otherwise("other."), F.lit("p"), "p_partkey").alias("param_key")
    p = table(spark, d, "part")
    return p.select(k, F.col("p_size").cast("string").alias("value")), p.where("p_retailprice > 950").select(k, (F.col("p_size") * 2).cast("string").alias("value"))


@query("UPS-07 JSN-06", f"WITH {PARAMS} SELECT param_key, coalesce(v, value) AS value, CASE WHEN v IS NULL THEN 'default' ELSE 'stored' END AS source, param_key LIKE 'risk.%' AS in_risk, substring(param_key, 6) AS rest FROM p")
def param_overlay(spark, d):
    inside, rest = U.in_namespace(F.col("param_key"), "risk")
    return U.overlay(*parameters(spark, d), "param_key", "value").select("param_key", "value", "source", inside.alias("in_risk"), rest.alias("rest"))


KINDS = "CASE p_size % 5 WHEN 0 THEN 'integer' WHEN 1 THEN 'float' WHEN 2 THEN 'boolean' ELSE 'string' END AS kind, CASE WHEN p_size > 45 THEN NULL WHEN p_size % 5 < 2 AND p_size > 40 THEN p_name WHEN p_size % 5 = 0 THEN CAST(p_partkey % 100 AS VARCHAR) WHEN p_size % 5 = 1 THEN CAST(p_retailprice AS VARCHAR) WHEN p_size % 5 = 2 THEN CASE WHEN p_size > 20 THEN 'Yes' ELSE 'off' END ELSE p_brand END AS v, CASE WHEN p_size % 5 < 2 THEN 10.0 END AS lo, CASE WHEN p_size % 5 < 2 THEN 920.0 END AS hi"


@query("JSN-04 JSN-05", f"""WITH p AS (SELECT p_partkey AS k, {KINDS} FROM part) SELECT k, CASE WHEN kind = 'integer' THEN TRY_CAST(v AS BIGINT) END AS as_long, CASE WHEN kind IN ('float', 'integer') THEN TRY_CAST(v AS DOUBLE) END AS as_double, CASE WHEN kind = 'boolean' THEN lower(v) IN ('true', '1', 'yes') END AS as_bool, CASE WHEN kind = 'string' THEN v END AS as_text,
 CASE WHEN v IS NULL THEN 'missing' WHEN (kind IN ('integer', 'float') AND TRY_CAST(v AS DOUBLE) IS NULL) OR (kind = 'integer' AND TRY_CAST(v AS BIGINT) IS NULL) THEN 'type' WHEN TRY_CAST(v AS DOUBLE) < lo THEN 'below minimum' WHEN TRY_CAST(v AS DOUBLE) > hi THEN 'above maximum' WHEN kind = 'string' AND v NOT IN ('Brand#2', 'Brand#4') THEN 'not allowed' ELSE 'ok' END AS verdict FROM p""")
def typed_params(spark, d):
    """Parameters of four types from the parts; some miss, some do not parse, some are out of bounds or not allowed."""
    p = table(spark, d, "part").selectExpr("p_partkey AS k", *[x.replace("VARCHAR", "STRING") for x in KINDS.split(", CASE ")[:1]], *["CASE " + x.replace("VARCHAR", "STRING") for x in KINDS.split(", CASE ")[1:]])
    kind, v = F.col("kind"), F.col("v")
    allowed = F.when(kind == "string", F.array(F.lit("Brand#2"), F.lit("Brand#4")))
    t = U.typed(kind, v)
    return p.select("k", *[t[n].alias(n) for n in ("as_long", "as_double", "as_bool", "as_text")], U.validated(kind, v, F.col("lo").cast("double"), F.col("hi").cast("double"), allowed).alias("verdict"))


@query("UPS-09", f"WITH {PARAMS} SELECT param_key, 'control' AS arm, value FROM p UNION ALL SELECT param_key, 'treatment', coalesce(v, value) FROM p")
def experiment_arms(spark, d):
    return U.feedback(*parameters(spark, d), "param_key", "value")


@query("UPS-09", "SELECT p_type, p_partkey, 'v1.' || row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS version, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) = count(*) OVER (PARTITION BY p_type) AS is_active FROM part")
def parameter_versions(spark, d):
    return U.versions(table(spark, d, "part").select("p_type", "p_partkey"), ["p_type"], "p_partkey")


@query("UPS-06", "SELECT count(*) AS n, bit_xor(CAST('0x' || substring(md5('uno.' || p_partkey || '=' || p_name), 1, 15) AS BIGINT)) AS content_hash FROM part")
def parameter_snapshot(spark, d):
    return U.snapshot(table(spark, d, "part").select(F.concat(F.lit("uno."), "p_partkey").alias("k"), F.col("p_name").alias("v")), "k", "v")


@query("SRC-05", "WITH t AS (SELECT p_partkey, 'supplier#' || lpad(CAST(p_partkey AS STRING), CAST(5 + 2 * (p_partkey % 3) AS INTEGER), '0') AS t FROM part) SELECT DISTINCT s.s_suppkey, t.p_partkey FROM supplier s JOIN t ON contains(lower(s.s_name), t) OR contains(t, lower(s.s_name))")
def tsv_sample_match(spark, d):
    """All names against all target names."""
    from tessera.operators.relational import contained_pairs

    k = F.col("p_partkey")
    width = (k % 3 * 2 + 5).cast("int")
    digits = F.concat(F.substr(F.lit("000000000"), F.lit(1), F.greatest(width - F.length(k.cast("string")), F.lit(0))), F.left(k.cast("string"), width))
    targets = table(spark, d, "part").select("p_partkey", F.concat(F.lit("supplier#"), digits).alias("t"))
    names = table(spark, d, "supplier").select("s_suppkey", F.lower("s_name").alias("s"))
    return contained_pairs(names, targets, "s", "t", 12).select("s_suppkey", "p_partkey").distinct()


@query("SRC-14", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'failed' WHEN o_custkey % 3 > 0 THEN 'success' ELSE 'no_data' END AS status, datediff('second', o_orderdate, o_orderdate + INTERVAL 90 SECOND) AS duration_seconds FROM orders")
def extraction_log(spark, d):
    cols = U.log_row(F.col("o_orderdate"), F.col("o_orderdate") + F.expr("INTERVAL 90 SECOND"), F.col("o_custkey") % 3, F.col("o_orderstatus") == "P")
    return table(spark, d, "orders").select("o_orderkey", *cols)


@query("AGG-02", "SELECT time_bucket(INTERVAL 300 SECOND, ts) AS start, count(*) AS failures, count(*) >= 3 AS tripped FROM events WHERE event_type = 'error' GROUP BY 1")
def failure_windows(spark, d):
    return U.failure_windows(table(spark, d, "events"), "ts", F.col("event_type") == "error")


def _breaker_sql(key: str) -> str:
    """Restarts by recursion over each key's failures: the next one is the first more than 300 s after the last."""
    return f"""WITH RECURSIVE f AS (SELECT {key} AS key, event_id AS id, ts AS time FROM events WHERE event_type = 'error'),
 r AS (SELECT key, min(time) AS began FROM f GROUP BY 1 UNION ALL SELECT r.key, (SELECT min(time) FROM f WHERE f.key = r.key AND f.time > r.began + INTERVAL 300 SECOND) AS began FROM r WHERE r.began IS NOT NULL),
 x AS (SELECT f.*, r.began AS count_began FROM f ASOF JOIN (SELECT * FROM r WHERE began IS NOT NULL) r ON r.key = f.key AND f.time >= r.began)
 SELECT *, failures >= 3 AS tripped FROM (SELECT key, id, time, row_number() OVER (PARTITION BY key, count_began ORDER BY time, id) AS failures, count_began FROM x)"""


@query("STM-04", _breaker_sql("0"))
def breaker_trips(spark, d):
    """One breaker for all failures, as a batch run has."""
    return B.breaker(table(spark, d, "events"), F.col("event_type") == "error", F.lit(0), "ts", "event_id")


@query("STM-04", _breaker_sql("user_id % 10"))
def breaker_by_group(spark, d):
    return B.breaker(table(spark, d, "events"), F.col("event_type") == "error", F.col("user_id") % 10, "ts", "event_id")


@query("STM-05", """WITH n AS (SELECT max(ts) AS now FROM events), g AS (SELECT user_id, count(*) FILTER (event_type = 'error' AND ts > now - INTERVAL 1 HOUR) AS errors_hour, count(*) FILTER (event_type = 'error' AND ts > now - INTERVAL 1 DAY) AS errors_day, count(*) FILTER (ts > now - INTERVAL 1 DAY) AS events_day FROM events, n GROUP BY 1)
 SELECT *, least(errors_day * 2, 100) AS rate, errors_hour > 5 AS needs_attention FROM g""")
def recent_errors(spark, d):
    """As of the newest event."""
    e = table(spark, d, "events")
    now = e.agg(F.max("ts").cast("timestamp").alias("now"))  # one row
    return B.recent_errors(e.join(F.broadcast(now)), F.col("event_type") == "error", "user_id", "ts", F.col("now"))


@query("STM-05", "SELECT user_id, event_id, ts AS time, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 3599999999 MICROSECOND PRECEDING AND CURRENT ROW) AS errors_hour, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 86399999999 MICROSECOND PRECEDING AND CURRENT ROW) AS errors_day FROM events WHERE event_type = 'error'")
def trailing_errors(spark, d):
    return B.trailing_errors(table(spark, d, "events"), F.col("event_type") == "error", "user_id", "ts", "event_id")


@query("AGG-32 MLV-11", """WITH a AS (SELECT l_returnflag AS name, sum(l_quantity) AS v FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1), b AS (SELECT l_returnflag AS name, sum(l_quantity) AS v FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag <> 'N' GROUP BY 1), c AS (SELECT coalesce(a.name, b.name) AS name, a.v AS before, b.v AS after, (b.v - a.v) * 100.0::DOUBLE / a.v AS change_pct FROM a FULL JOIN b ON b.name = a.name)
 SELECT *, CASE WHEN change_pct > 5 THEN 'better' WHEN change_pct < -5 THEN 'worse' ELSE 'same' END AS verdict FROM c""")
def compare_runs(spark, d):
    li = table(spark, d, "lineitem")
    run = lambda c: li.where(c).groupBy(F.col("l_returnflag").alias("name")).agg(F.sum("l_quantity").alias("v"))
    return U.compare_runs(run("l_linestatus = 'O'"), run("l_linestatus = 'F' AND l_returnflag <> 'N'"), "name", "v")


@query("STR-25 STR-27", "WITH e AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN ' A@B.com ' WHEN 1 THEN 'no mail' WHEN 2 THEN 'x@y' ELSE c_name || '@mail.org' END AS e, CASE c_custkey % 3 WHEN 0 THEN 'y' WHEN 1 THEN 'FALSE' ELSE 'maybe' END AS f FROM customer) SELECT c_custkey, regexp_full_match(lower(trim(e)), '[^\\s@]+@[^\\s@]+\\.[^\\s@]+') AS valid, CASE WHEN lower(f) IN ('yes', 'y', 'true', '1') THEN 'Yes' WHEN lower(f) IN ('no', 'n', 'false', '0', '') THEN 'No' END AS replied FROM e")
def yes_no_repair(spark, d):
    k = F.col("c_custkey")
    e = F.when(k % 4 == 0, " A@B.com ").when(k % 4 == 1, "no mail").when(k % 4 == 2, "x@y").otherwise(F.concat("c_name", F.lit("@mail.org")))
    f = F.when(k % 3 == 0, "y").when(k % 3 == 1, "FALSE").otherwise("maybe")
    return table(spark, d, "customer").select("c_custkey", valid_email(F.lower(F.trim(e))).alias("valid"), U.yes_no(f).alias("replied"))
