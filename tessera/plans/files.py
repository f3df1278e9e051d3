"""Files that are written to the shared folder and read back: what a reader gets, against the tables they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import state as U
from tessera.sources import archives as A
from tessera.sources import files as S
from tessera.sources.staging import new_path

from .registry import query, table

ORG = "CASE WHEN p_partkey % 7 = 0 THEN '' ELSE p_name || ' ' || p_brand END"


@query("SRC-04 SNK-06", f"SELECT 'US' || p_partkey AS patent_id, 'a' || p_size AS assignee_id, {ORG} AS name, CAST(p_partkey % 4 AS VARCHAR) AS type FROM part WHERE p_partkey % 7 <> 0 AND p_partkey % 11 <> 0")
def tsv_organisations(spark, d):
    """Quoted values, people without an organisation, and rows that end early."""
    cells = [F.concat(F.lit("US"), "p_partkey"), F.lit("0"), F.concat(F.lit("a"), "p_size"), F.lit(""), F.lit(""), F.expr(ORG), (F.col("p_partkey") % 4).cast("string")]
    whole = F.array_join(F.array(*[F.concat(F.lit('"'), c, F.lit('"')) for c in cells]), "\t")
    rows = table(spark, d, "part").select(F.when(F.col("p_partkey") % 11 == 0, F.concat(F.lit("US"), "p_partkey", F.lit("\t1"))).otherwise(whole).alias("value"))
    head = spark.createDataFrame([("\t".join(f'"{c}"' for c in ("patent_id", "assignee_sequence", "assignee_id", "first", "last", "disambig_assignee_organization", "assignee_type")),)], "value string")
    path = new_path(spark, "organisations")
    # one file, as its header must come first
    head.withColumn("k", F.lit(0)).unionByName(rows.withColumn("k", F.lit(1))).repartition(1).sortWithinPartitions("k").select("value").write.text(path)
    return S.read_organisations(spark, path)


@query("SRC-06", """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'U' || (c_custkey - c_custkey % 2) || '@Mail.org' END AS email, c_name, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'Seq' || c_custkey % 5 END AS s FROM customer),
 n AS (SELECT *, row_number() OVER (PARTITION BY lower(email) ORDER BY c_custkey) AS r FROM c WHERE email IS NOT NULL AND lower(email) NOT IN (SELECT 'u' || c_custkey || '@mail.org' FROM customer WHERE c_custkey % 10 = 0))
 SELECT email, trim(c_name) AS first_name, '' AS last_name, 'a, "b"' || chr(10) || 'c' AS company, '' AS title, '' AS linkedin_url, coalesce(s, 'Default') AS sequence FROM n WHERE r = 1""")
def csv_import(spark, d):
    """Headers in other words and cases, doubled quotes, line breaks, missing and known and repeated e-mails."""
    k = F.col("c_custkey")
    email = F.when(k % 9 != 0, F.concat(F.lit("U"), k - k % 2, F.lit("@Mail.org")))
    rows = table(spark, d, "customer").select(email.alias(" EMail "), F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("FirstName"), F.lit('a, "b"\nc').alias("company"), F.when(k % 3 != 0, F.concat(F.lit("Seq"), k % 5)).alias("Sequence"), k.alias("row"))
    path = new_path(spark, "contacts")
    U.write_csv(rows, path)
    existing = table(spark, d, "customer").where("c_custkey % 10 = 0").select(F.concat(F.lit("u"), "c_custkey", F.lit("@mail.org")).alias("email"))
    return S.import_contacts(S.contacts_of(S.read_csv(spark, path)).withColumn("row", F.col("row").cast("long")), existing, "row")


@query("SNK-07", """SELECT c_custkey, c_name || ' "' || c_mktsegment || '",' || chr(10) || 'x' AS name, CASE WHEN c_custkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS paused FROM customer""")
def csv_export(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", F.concat("c_name", F.lit(' "'), "c_mktsegment", F.lit('",\nx')).alias("name"), F.when(F.col("c_custkey") % 2 == 0, "Yes").otherwise("No").alias("paused"))
    path = new_path(spark, "export")
    U.write_csv(rows, path)
    return S.read_csv(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("long"))


SHEET = "CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN 'Paused' ELSE 'Active' END"


@query("SRC-07", f"""WITH r AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 = 0 THEN '' ELSE 'F' || o_custkey END AS f, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE o_custkey || '@x.org' END AS e, {SHEET} AS s, CASE o_orderkey % 3 WHEN 0 THEN 'Email' WHEN 1 THEN 'LinkedIn and email' ELSE NULL END AS c FROM orders)
 SELECT f AS first_name, coalesce(e, '') AS email, 'Main' AS sequence, CASE WHEN s = '' THEN 'Active' ELSE s END AS status, 'Medium' AS priority, lower(s) = 'paused' AS paused, contains(lower(coalesce(c, '')), 'email') AS replied_to_email, contains(lower(coalesce(c, '')), 'linkedin') AS replied_to_linkedin, f <> '' AND e IS NOT NULL AS is_valid, coalesce(nullif(f, ''), e, 'Unknown Contact') AS display_name FROM r""")
def sheet_contacts(spark, d):
    o, k = F.col("o_custkey"), F.col("o_orderkey")
    rows = table(spark, d, "orders").select(F.when(o % 5 == 0, "").otherwise(F.concat(F.lit("F"), o)).alias("first_name"), F.when(o % 7 != 0, F.concat(o, F.lit("@x.org"))).alias("email"), F.lit("Main").alias("sequence"), F.expr(SHEET).alias("status"), F.lit(None).cast("string").alias("priority"), F.when(k % 3 == 0, "Email").when(k % 3 == 1, "LinkedIn and email").alias("reply_channel"))
    path = new_path(spark, "sheet")
    U.write_table(rows, path, "overwrite")
    return S.typed_contacts(spark.read.parquet(path))


CASES = "SELECT o_custkey AS id, count(*) AS dup, sum(o_totalprice) AS total, CAST(o_custkey % 20 AS DOUBLE) / 10.0 AS speed, CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE CAST(o_custkey % 25 AS DOUBLE) END AS reduction FROM orders GROUP BY o_custkey"


@query("SRC-08", f"WITH c AS ({CASES}) SELECT id, 'high duplicates' AS issue FROM c WHERE dup > 5 UNION ALL SELECT id, 'slower' FROM c WHERE speed < 1 UNION ALL SELECT id, 'low reduction' FROM c WHERE coalesce(reduction, 0) < 10")
def json_results(spark, d):
    """Result files of many test cases with nested and absent fields, as JSON, and the issues that an analysis reads from them."""
    cases = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.count("*").alias("dup"))
    case = F.struct("id", F.struct(F.col("dup").alias("current_duplicate_count")).alias("normalization_analysis"), F.struct((F.col("id") % 20 / 10.0).alias("speed_improvement"), F.when(F.col("id") % 6 != 0, (F.col("id") % 25).cast("double")).alias("reduction_percentage")).alias("performance"))
    path = new_path(spark, "results")
    cases.groupBy(F.floor(F.col("id") / 100).alias("file")).agg(F.collect_list(case).alias("test_cases")).select(F.struct(F.lit("run").alias("test_name")).alias("test_metadata"), "test_cases").write.json(path)
    schema = "test_cases array<struct<id: long, normalization_analysis: struct<current_duplicate_count: long>, performance: struct<speed_improvement: double, reduction_percentage: double>>>"
    return S.result_issues(spark.read.schema(schema).json(path))


@query("SNK-08", "WITH g AS (SELECT o_orderstatus AS s, count(*) AS n, max(o_custkey) AS m FROM orders GROUP BY 1) SELECT '# Orders by status' AS value UNION ALL SELECT '## ' || s FROM g UNION ALL SELECT '- **Orders**: ' || n FROM g UNION ALL SELECT '- **Last customer**: ' || m FROM g")
def markdown_file(spark, d):
    g = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.max("o_custkey").alias("m"))
    lines = S.markdown_report(g, "Orders by status", "o_orderstatus", {"Orders": F.col("n").cast("string"), "Last customer": F.col("m").cast("string")})
    path = new_path(spark, "report")
    lines.orderBy("section", "line").select("text").write.text(path)
    return spark.read.text(path)


@query("SNK-06", "SELECT n_nationkey, n_name FROM nation WHERE n_nationkey % 2 = 1")
def truncate_and_load(spark, d):
    """What is loaded last is all there is."""
    n, path = table(spark, d, "nation").select("n_nationkey", "n_name"), new_path(spark, "load")
    for k in (0, 1):
        U.write_table(n.where(F.col("n_nationkey") % 2 == k), path, "overwrite")
    return spark.read.schema(n.schema).parquet(path)


@query("JON-10", """WITH c AS (SELECT c_custkey, 'u' || c_custkey % 800 || '@m' || c_custkey % 3 || '.org' AS e FROM customer), m AS (SELECT event_id, 'User ' || user_id || ' <xu' || user_id || '@m' || event_id % 4 || '.org>' AS s FROM events) SELECT event_id, min(c_custkey) AS c_custkey FROM m JOIN c ON contains(s, e) GROUP BY 1""")
def reply_match(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("u"), F.col("c_custkey") % 800, F.lit("@m"), F.col("c_custkey") % 3, F.lit(".org")).alias("e"))
    m = table(spark, d, "events").select("event_id", F.concat(F.lit("User "), "user_id", F.lit(" <xu"), "user_id", F.lit("@m"), F.col("event_id") % 4, F.lit(".org>")).alias("s"))
    return S.first_contained(m, c, "s", "e", "c_custkey").select("event_id", "c_custkey")


OLD = {"First Name": "c_name", "Email": "c_custkey || '@x.org'", "Linkedin Url": "CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'linkedin.com/in/' || c_custkey ELSE ' http://l.org/' || c_custkey END", "Paused?": "CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN '' END", "Replied to Email?": "CASE WHEN c_custkey % 2 = 0 THEN 'Yes' END", "Replied to LinkedIn?": "CASE WHEN c_custkey % 5 = 0 THEN 'Yes' ELSE 'No' END", "Message Sequence Sheet": "c_mktsegment"}
TARGETS = ["First Name", "Email", "LinkedIn URL", "Status", "Reply Channel", "Sequence", "Priority", "Source", "Notes"]


@query("OUT-08", """SELECT c_name AS "First Name", c_custkey || '@x.org' AS "Email", CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'https://www.linkedin.com/in/' || c_custkey ELSE 'http://l.org/' || c_custkey END AS "LinkedIn URL", CASE WHEN c_custkey % 3 = 0 THEN 'Paused' ELSE 'Active' END AS "Status",
 CASE WHEN c_custkey % 10 = 0 THEN 'Both' WHEN c_custkey % 2 = 0 THEN 'Email' WHEN c_custkey % 5 = 0 THEN 'LinkedIn' ELSE '' END AS "Reply Channel", c_mktsegment AS "Sequence", 'Medium' AS "Priority", 'Migration' AS "Source", '' AS "Notes" FROM customer""")
def column_migration(spark, d):
    return S.migrate_contacts(table(spark, d, "customer").select(*[F.expr(v).alias(k) for k, v in OLD.items()]), TARGETS)


def keys(spark, d) -> DataFrame:
    return table(spark, d, "part").select(F.concat(F.lit("uno."), "p_brand", F.lit(".k"), F.col("p_size")).alias("cache_key")).distinct()


@query("UPS-10", "SELECT DISTINCT 'uno.' || p_brand || '.k' || p_size AS cache_key FROM part WHERE NOT (('uno.' || p_brand || '.k' || p_size) GLOB 'uno.Brand#1?.k[1-3]*') AND ('uno.' || p_brand || '.k' || p_size) <> 'uno.Brand#2.k4' AND NOT starts_with('uno.' || p_brand || '.k' || p_size, 'uno.Brand#7.')")
def cache_invalidate(spark, d):
    left = S.invalidate(keys(spark, d), "cache_key", exact="uno.Brand#2.k4")
    return S.invalidate(S.invalidate(left, "cache_key", namespace="uno.Brand#7"), "cache_key", pattern="uno.Brand#1?.k[1-3]*")


@query("SRC-04", "SELECT 'part-' || c_nationkey || '.tsv' AS member, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS line, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer QUALIFY c_mktsegment <> 'BUILDING'")
def tsv_zipped(spark, d):
    """Customers as zipped files, one a nation, read again; rows without an organisation (here: of one segment) are dropped."""
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment")).alias("org"), "c_name")
    packed = A.zipped(c.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey"), "c_nationkey", ["c_name", "org", "c_custkey"])
    return A.read_zipped(packed, ["c_custkey", "c_name"], required="org")


@query("SNK-10", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def load_resumed(spark, d):
    """Orders as four files, loaded by a stream that is broken off after its second batch and started again."""
    o, path = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), [new_path(spark, n) for n in ("files", "loaded", "progress")]
    o.repartition(4, "o_orderkey").write.parquet(path[0])
    stream = spark.readStream.schema(o.schema).option("maxFilesPerTrigger", 1).parquet(path[0])

    def broken(k: int) -> None:
        if k == 1:
            raise InterruptedError("the load is broken off here")

    try:
        A.load_resumably(stream, path[1], path[2], broken)
    except Exception as e:  # the stream's own error holds the message
        if "broken off here" not in str(e):
            raise
    A.load_resumably(stream, path[1], path[2])
    return spark.read.schema(o.schema).parquet(path[1]).select(*o.columns)


@query("SNK-11", "SELECT o_orderkey, o_orderstatus, count(*) AS n_lines, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def bucketed_tables(spark, d):
    """Orders and their lines as tables bucketed by the order: the join and the sums of an order plan no shuffle."""
    rows = A.joined_tables(spark, table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), table(spark, d, "lineitem").select("l_orderkey", "l_quantity"), "o_orderkey", "l_orderkey")
    return rows.groupBy("o_orderkey", "o_orderstatus").agg(F.count("*").alias("n_lines"), F.sum("l_quantity").alias("quantity"))
