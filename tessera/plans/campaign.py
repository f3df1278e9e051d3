"""Campaigns bound to customers (contacts, segments as sequences) and orders (steps sent)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import fill_template
from tessera.operators import campaign as C
from tessera.operators.relational import batches, coverage

from .registry import query, table

AS_OF = "1998-06-01"
STEPS = [(s, day, a) for s, n in (("BUILDING", 3), ("MACHINERY", 5), ("FURNITURE", 2), ("HOUSEHOLD", 4), ("AUTOMOBILE", 1)) for day, a in [(k * 200 + 1, ("email", "connect", "message")[k % 3]) for k in range(n)] + [(401 + k, "email") for k in range(100)]]
SV = ", ".join(f"('{s}', {day}, '{a}')" for s, day, a in STEPS)
VIEW = f"""contacts AS (SELECT c_custkey AS contact, c_mktsegment AS sequence, CASE WHEN c_custkey % 11 > 0 THEN DATE '1997-01-01' + CAST(c_custkey % 500 AS INT) END AS start, c_custkey % 7 > 0 AS active, c_custkey % 5 = 0 AS replied FROM customer), steps(sequence, day, action) AS (VALUES {SV}),
 sent AS (SELECT DISTINCT o_custkey AS contact, (o_orderkey % 3 * 200 + 1)::INT AS day, CASE o_orderkey % 3 WHEN 0 THEN 'email' WHEN 1 THEN 'connect' ELSE 'message' END AS action FROM orders)"""


def frames(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    k, o = F.col("c_custkey"), F.col("o_orderkey")
    contacts = table(spark, d, "customer").select(k.alias("contact"), F.col("c_mktsegment").alias("sequence"), F.when(k % 11 > 0, F.date_add(F.lit("1997-01-01").cast("date"), (k % 500).cast("int"))).alias("start"), (k % 7 > 0).alias("active"), (k % 5 == 0).alias("replied"))
    steps = spark.createDataFrame(STEPS, "sequence string, day int, action string")
    sent = table(spark, d, "orders").select(F.col("o_custkey").alias("contact"), (o % 3 * 200 + 1).cast("int").alias("day"), F.when(o % 3 == 0, "email").when(o % 3 == 1, "connect").otherwise("message").alias("action")).distinct()
    return contacts, steps, sent


@query("JON-13 OUT-05 OUT-11 FIL-10 DAT-01", f"""WITH {VIEW}, n AS (SELECT *, (DATE '{AS_OF}' - start + 1)::INT AS day FROM contacts WHERE active AND start <= DATE '{AS_OF}') SELECT n.contact, n.sequence, n.day, s.action FROM n JOIN steps s ON s.sequence = n.sequence AND s.day = n.day WHERE NOT EXISTS (SELECT 1 FROM sent t WHERE t.contact = n.contact AND t.day = n.day AND t.action = s.action)""")
def due_actions(spark, d):
    return C.due(*frames(spark, d), F.lit(AS_OF).cast("date"))


STATUS = f"""WITH {VIEW}, t AS (SELECT sequence, count(*) AS steps FROM steps GROUP BY 1), x AS (SELECT contact, count(*) AS done FROM sent GROUP BY 1), st AS (SELECT c.contact, c.sequence, CASE WHEN DATE '{AS_OF}' >= start THEN (DATE '{AS_OF}' - start + 1)::INT END AS day, CASE WHEN start IS NULL THEN 'not started' WHEN replied THEN 'replied' WHEN NOT active THEN 'paused' WHEN coalesce(done, 0) >= steps THEN 'completed' ELSE 'active' END AS state, coalesce(done, 0) AS done, round(coalesce(done, 0) * 100.0::DOUBLE / steps) AS progress FROM contacts c LEFT JOIN t ON t.sequence = c.sequence LEFT JOIN x ON x.contact = c.contact)"""


@query("OUT-04 DAT-01", STATUS + " SELECT * FROM st")
def campaign_status(spark, d):
    return C.status(*frames(spark, d), F.lit(AS_OF).cast("date"))


@query("AGG-20", STATUS + " SELECT sequence, state, count(*) AS n, max(progress) AS best FROM st GROUP BY 1, 2")
def campaign_summary(spark, d):
    return C.status(*frames(spark, d), F.lit(AS_OF).cast("date")).groupBy("sequence", "state").agg(F.count("*").alias("n"), F.max("progress").alias("best"))


@query("AGG-21", "SELECT CAST(x AS DATE) AS date, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate END AS x FROM orders UNION ALL SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 2 DAY END FROM orders) WHERE x IS NOT NULL GROUP BY 1")
def daily_sends(spark, d):
    k = F.col("o_orderkey")
    wide = table(spark, d, "orders").select(k, F.when(k % 2 == 0, F.col("o_orderdate")).alias("Day 1 Email Sent"), F.when(k % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL 2 DAY")).alias("Day 3 Email Sent"))
    return C.sends_by_day(wide, "o_orderkey", ["Day 1 Email Sent", "Day 3 Email Sent"])


@query("AGG-22", f"WITH {VIEW}, g AS (SELECT sequence, count(*) AS n, count(CASE WHEN replied THEN 1 END) AS replies FROM contacts WHERE start IS NOT NULL GROUP BY 1), r AS (SELECT *, round(replies * 100.0::DOUBLE / n + 1e-9, 1) AS rate FROM g) SELECT *, CASE WHEN rate > 15 THEN 'good' WHEN rate < 5 AND n > 10 THEN 'needs improvement' ELSE 'normal' END AS verdict FROM r")
def response_rate(spark, d):
    return C.response_rates(frames(spark, d)[0])


@query("AGG-23", "SELECT round(avg(CASE WHEN trim(c_name) <> '' THEN 100.0 ELSE 0.0 END), 1) AS c_name_percent, round(avg(CASE WHEN c_custkey % 3 > 0 THEN 100.0 ELSE 0.0 END), 1) AS title_percent FROM customer")
def data_quality(spark, d):
    return coverage(table(spark, d, "customer").select("c_name", F.when(F.col("c_custkey") % 3 > 0, "CEO").alias("title")), ["c_name", "title"])


@query("SRT-04 SRT-06", """WITH p AS (SELECT c_custkey, c_mktsegment, least(greatest(50 + CASE WHEN c_custkey % 15 <= 3 THEN 20 ELSE 0 END + CASE WHEN c_custkey % 4 = 0 THEN 15 ELSE 0 END + 10 - CASE WHEN c_custkey % 15 > 10 THEN 10 ELSE 0 END + CASE WHEN c_custkey % 24 BETWEEN 8 AND 11 THEN 15 ELSE 0 END, 0), 100)::INT AS priority FROM customer)
 SELECT *, ((row_number() OVER (PARTITION BY c_mktsegment ORDER BY priority DESC, c_custkey) - 1) // 20)::INT AS batch_no FROM p""")
def task_priority_batches(spark, d):
    k = F.col("c_custkey")
    p = C.priority(k % 15, F.when(k % 4 == 0, "CEO").otherwise("x"), F.lit("a"), F.lit("b"), k % 24)
    return batches(table(spark, d, "customer").select("c_custkey", "c_mktsegment", p.cast("int").alias("priority")), [F.desc("priority"), F.asc("c_custkey")], 20, ["c_mktsegment"])


@query("OUT-02 STR-25", """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'a@b.co' ELSE 'bad' END AS e, CASE c_custkey % 3 WHEN 0 THEN 'https://www.linkedin.com/in/joe-1' WHEN 1 THEN 'www.linkedin.com/in/x/' END AS u, CASE WHEN c_custkey % 5 > 0 THEN 'seq' ELSE ' ' END AS s FROM customer) SELECT c_custkey, array_to_string(list_filter([CASE WHEN e = 'bad' THEN 'email' END, CASE WHEN coalesce(NOT regexp_matches(u, '^https?://(www\\.)?linkedin\\.com/in/[\\w\\-]+/?$'), true) THEN 'url' END, CASE WHEN trim(s) = '' THEN 'sequence' END], lambda x: x IS NOT NULL), ',') AS issues,
 CASE c_custkey % 3 WHEN 0 THEN u WHEN 1 THEN 'https://www.linkedin.com/in/x' END AS clean FROM c""")
def validate_contacts(spark, d):
    k = F.col("c_custkey")
    e, u, s = F.when(k % 2 == 0, "a@b.co").otherwise("bad"), F.when(k % 3 == 0, "https://www.linkedin.com/in/joe-1").when(k % 3 == 1, "www.linkedin.com/in/x/"), F.when(k % 5 > 0, "seq").otherwise(" ")
    return table(spark, d, "customer").select("c_custkey", F.array_join(C.issues(e, u, s), ",").alias("issues"), C.clean_profile_url(u).alias("clean"))


@query("STR-24", "SELECT c_custkey, 'Hi ' || c_name || ', your ' || c_mktsegment || ' (' || c_name || ')' AS text FROM customer")
def personalise(spark, d):
    t = F.lit("Hi {First Name}, your {SEGMENT} ({first name})")
    return table(spark, d, "customer").select("c_custkey", fill_template(t, {"first name": F.col("c_name"), "segment": F.col("c_mktsegment")}).alias("text"))


@query("STR-26 JON-12", "SELECT p_partkey, array_to_string(list_filter(list_transform(string_split(p_name || ', ,' || p_type, ','), lambda x: trim(x)), lambda x: length(x) > 0), ' OR ') AS terms FROM part")
def keyword_search(spark, d):
    return table(spark, d, "part").select("p_partkey", C.any_of(F.concat("p_name", F.lit(", ,"), "p_type")).alias("terms"))


@query("OUT-03 OUT-12", f"WITH {VIEW} SELECT DISTINCT sequence, 'Day ' || day || ' ' || CASE action WHEN 'email' THEN 'Email' WHEN 'connect' THEN 'LinkedIn Connect' ELSE 'LinkedIn DM' END || ' Sent' AS \"column\" FROM steps")
def tracking_columns(spark, d):
    return C.tracking_columns(frames(spark, d)[1])


@query("OUT-12", f"WITH {VIEW} SELECT sequence, max(day) AS last_day, 0::BIGINT AS empty, max(day) <= 60 AS valid FROM steps GROUP BY 1")
def sequence_validation(spark, d):
    return C.valid_sequences(frames(spark, d)[1], "action")


@query("OUT-06", f"SELECT c_custkey AS contact, (DATE '{AS_OF}' - (DATE '1998-05-01' + CAST(c_custkey % 60 AS INT)))::INT AS waiting_days FROM customer WHERE c_custkey % 3 > 0 AND c_custkey % 4 > 0 AND DATE '{AS_OF}' - (DATE '1998-05-01' + CAST(c_custkey % 60 AS INT)) >= 1")
def pending_connections(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(k.alias("contact"), F.date_add(F.lit("1998-05-01").cast("date"), (k % 60).cast("int")).alias("requested"), (k % 3 == 0).alias("accepted"), F.when(k % 4 == 0, True).alias("failed"))
    return C.pending_connections(c, F.lit(AS_OF).cast("date")).select("contact", "waiting_days")


@query("MTH-19 AGG-28", "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0 ELSE 1.5 END * p_size AS seconds, least(CASE WHEN p_partkey % 20 / 100.0::DOUBLE > 0.1 THEN floor(p_size * 0.7::DOUBLE) WHEN p_partkey % 20 / 100.0::DOUBLE < 0.02 THEN floor(p_size * 1.2::DOUBLE) ELSE p_size END, 40)::BIGINT AS next_size FROM part")
def batch_sizes(spark, d):
    k = F.col("p_partkey")
    kind = F.when(k % 3 == 0, "email").when(k % 3 == 1, "connect").otherwise("message")
    return table(spark, d, "part").select("p_partkey", C.processing_seconds(kind, F.col("p_size")).alias("seconds"), C.next_batch_size(F.col("p_size"), k % 20 / 100.0, F.lit(40)).cast("long").alias("next_size"))


@query("OUT-07 STR-32", f"WITH {VIEW}, g AS (SELECT sequence, count(CASE WHEN replied THEN 1 END) * 100.0::DOUBLE / count(*) AS rate FROM contacts WHERE start IS NOT NULL GROUP BY 1) SELECT sequence, 'rewrite' AS advice FROM g WHERE (sequence = 'BUILDING' AND rate < 50) OR (sequence = 'MACHINERY' AND rate < 1)")
def campaign_advice(spark, d):
    g = frames(spark, d)[0].where("start IS NOT NULL").groupBy("sequence").agg((F.count(F.when(F.col("replied"), 1)) * 100.0 / F.count("*")).alias("rate"))
    return C.advice(g, "sequence", "rate", [("BUILDING", 50.0, "rewrite"), ("MACHINERY", 1.0, "rewrite")])
