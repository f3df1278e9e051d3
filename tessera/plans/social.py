"""Posts, authors and threads, bound to events and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import clean_post
from tessera.operators import social as S

from .registry import query, table

AS_OF = "2024-02-01 00:00:00"
POSTS = """WITH posts AS (SELECT event_id AS tweet_id, user_id, ts AS created_at, k, CASE WHEN event_id % 997 = 0 THEN 1000000 ELSE event_id % 500 END AS like_count, k * 3 AS retweet_count, event_id % 37 AS reply_count, k % 11 AS quote_count,
 CASE WHEN k % 7 = 0 THEN CAST(k * 100 AS BIGINT) END AS impressions, 1000 + user_id * 700 AS followers, k % 3 = 0 AS has_media, k % 5 = 0 AS has_url, k % 2 = 0 AS has_hashtag,
 CASE event_type WHEN 'click' THEN 'reply' WHEN 'view' THEN 'quote' ELSE 'tweet' END AS tweet_type FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events)),
 t AS (SELECT *, like_count + retweet_count + reply_count + quote_count AS total FROM posts),
 rates AS (SELECT user_id, CAST(sum(like_count + retweet_count + reply_count) AS DOUBLE) / count(*) / (max(followers) * 0.1::DOUBLE) * 100.0 AS engagement_rate FROM posts GROUP BY 1),
 users AS (SELECT p.user_id, max(followers) AS followers_count, 100 + p.user_id % 50 * 40 AS following_count, count(*) AS tweets_count, p.user_id % 4 = 0 AS verified, CASE WHEN p.user_id % 3 > 0 THEN 'bio' ELSE '' END AS bio,
 CASE WHEN p.user_id % 2 = 0 THEN 'here' END AS location, CASE WHEN p.user_id % 5 = 0 THEN 'site' END AS website, min(created_at) AS created_at, min(r.engagement_rate) AS engagement_rate FROM posts p JOIN rates r ON r.user_id = p.user_id GROUP BY p.user_id)
"""
INFLUENCE = """, scored AS (SELECT *, round(least(log10(greatest(followers_count::DOUBLE, 1.0)) / 6.0::DOUBLE * 100.0::DOUBLE, 100.0) * 0.30::DOUBLE + least(engagement_rate * 10.0::DOUBLE, 100.0) * 0.25::DOUBLE
 + ((CASE WHEN verified THEN 50.0::DOUBLE ELSE 0 END) + (CASE WHEN length(bio) > 0 THEN 25 ELSE 0 END) + (CASE WHEN length(location) > 0 THEN 15 ELSE 0 END) + (CASE WHEN length(website) > 0 THEN 10 ELSE 0 END)) * 0.20::DOUBLE
 + least(tweets_count::DOUBLE / greatest(floor((epoch(TIMESTAMP '2024-02-01') - epoch(created_at)) / 86400.0::DOUBLE), 1) * 20.0::DOUBLE, 100.0) * 0.15::DOUBLE + least(followers_count::DOUBLE / greatest(following_count, 1)::DOUBLE * 10.0::DOUBLE, 100.0) * 0.10::DOUBLE, 2) AS influence_score FROM users)
"""


def posts(spark, d) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    e = table(spark, d, "events").withColumn("k", k)
    i = F.col("event_id")
    return e.select(
        i.alias("tweet_id"), "user_id", F.col("ts").alias("created_at"), "k", F.when(i % 997 == 0, F.lit(1000000).cast("long")).otherwise(i % 500).alias("like_count"), (F.col("k") * 3).alias("retweet_count"), (i % 37).alias("reply_count"),
        (F.col("k") % 11).alias("quote_count"), F.when(F.col("k") % 7 == 0, F.col("k") * 100).alias("impressions"), (1000 + F.col("user_id") * 700).alias("followers"), (F.col("k") % 3 == 0).alias("has_media"), (F.col("k") % 5 == 0).alias("has_url"),
        (F.col("k") % 2 == 0).alias("has_hashtag"), F.when(F.col("event_type") == "click", "reply").when(F.col("event_type") == "view", "quote").otherwise("tweet").alias("tweet_type"),
    )


def users(spark, d) -> DataFrame:
    p, u = posts(spark, d), F.col("user_id")
    g = p.groupBy("user_id").agg(F.max("followers").alias("followers_count"), F.count("*").alias("tweets_count"), F.min("created_at").alias("created_at")).join(S.author_rates(p), "user_id")
    return g.withColumns({"following_count": 100 + u % 50 * 40, "verified": u % 4 == 0, "bio": F.when(u % 3 > 0, "bio").otherwise(""), "location": F.when(u % 2 == 0, "here"), "website": F.when(u % 5 == 0, "site")})


def scored(spark, d) -> DataFrame:
    return S.influence(users(spark, d), F.lit(AS_OF).cast("timestamp"))


@query("MTH-07", POSTS + """SELECT tweet_id, CASE WHEN coalesce(nullif(impressions, 0)::DOUBLE, followers * 0.1::DOUBLE) > 0 THEN least((like_count + retweet_count * 2 + reply_count * 3 + quote_count * 4)::DOUBLE / coalesce(nullif(impressions, 0)::DOUBLE, followers * 0.1::DOUBLE) * 100.0::DOUBLE, 100.0) ELSE 0.0 END AS rate FROM posts""")
def engagement_rate(spark, d):
    return S.engagement_rate(posts(spark, d)).select("tweet_id", "rate")


@query("AGG-13", POSTS + "SELECT CAST(sum(total) AS DOUBLE) / count(*) AS mean_engagement, median(total) AS median_engagement, round(stddev_pop(total), 2) AS std_engagement, quantile_cont(total, 0.95) AS percentile_95 FROM t")
def baseline_stats(spark, d):
    return S.baseline(posts(spark, d))


@query("MTH-08", POSTS + """, m AS (SELECT CAST(sum(total) AS DOUBLE) / count(*) AS mean FROM t) SELECT tweet_id, total AS total_engagement, total / greatest(mean, 1.0) AS viral_multiplier,
 round(least((like_count + retweet_count) / greatest((epoch(TIMESTAMP '2024-02-01') - epoch(created_at)) / 3600.0::DOUBLE, 1.0) / 100.0::DOUBLE, 1.0) * 30.0::DOUBLE + least(total / greatest(mean * 10.0::DOUBLE, 1.0), 1.0) * 40.0::DOUBLE + least((reply_count + quote_count) / 50.0::DOUBLE, 1.0) * 30.0::DOUBLE, 2) AS viral_score
 FROM t, m WHERE total >= 100 AND total > mean * 100.0""")
def viral(spark, d):
    return S.viral(posts(spark, d), F.lit(AS_OF).cast("timestamp"))


@query("AGG-14", POSTS + "SELECT hour(created_at)::INT AS hour, CAST(sum(total) AS DOUBLE) / count(*) AS average_engagement, count(*) AS tweet_count FROM t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def timing_hour(spark, d):
    return S.timing(posts(spark, d), {"hour": F.hour("created_at")}, 5)


@query("AGG-14", POSTS + "SELECT (isodow(created_at) - 1)::INT AS day, CAST(sum(total) AS DOUBLE) / count(*) AS average_engagement, count(*) AS tweet_count FROM t GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3")
def timing_day(spark, d):
    return S.timing(posts(spark, d), {"day": F.weekday("created_at")}, 3)


@query("AGG-14", POSTS + "SELECT (isodow(created_at) - 1)::INT AS day, hour(created_at)::INT AS hour, CAST(sum(total) AS DOUBLE) / count(*) AS average_engagement, count(*) AS tweet_count FROM t GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY 3 DESC, 1, 2 LIMIT 10")
def timing_slot(spark, d):
    return S.timing(posts(spark, d), {"day": F.weekday("created_at"), "hour": F.hour("created_at")}, 10, 2)


TYPES = """, c AS (SELECT CASE WHEN has_media THEN 'with_media' WHEN has_url THEN 'with_links' ELSE 'text_only' END AS content_type, total FROM t UNION ALL SELECT 'with_hashtags', total FROM t WHERE has_hashtag
 UNION ALL SELECT CASE tweet_type WHEN 'reply' THEN 'replies' ELSE 'quotes' END, total FROM t WHERE tweet_type IN ('reply', 'quote')),
 g AS (SELECT content_type, count(*) AS tweet_count, CAST(sum(total) AS DOUBLE) / count(*) AS average_engagement, median(total) AS median_engagement, max(total) AS max_engagement, sum(total)::BIGINT AS total_engagement FROM c GROUP BY 1)
"""


@query("AGG-15", POSTS + TYPES + "SELECT * FROM g")
def content_types(spark, d):
    return S.content_types(posts(spark, d))


@query("AGG-16", POSTS + TYPES + "SELECT content_type AS best FROM g ORDER BY average_engagement DESC, content_type LIMIT 1")
def best_content_type(spark, d):
    return S.best_of(S.content_types(posts(spark, d)), "content_type", "average_engagement")


@query("STR-32 OUT-07", POSTS + TYPES + """, a AS (SELECT max(CASE WHEN content_type = 'with_media' THEN average_engagement END) AS media, max(CASE WHEN content_type = 'text_only' THEN average_engagement END) AS text, max(CASE WHEN content_type = 'with_hashtags' THEN average_engagement END) AS tags,
 avg(average_engagement) AS overall, max(CASE WHEN content_type = 'replies' THEN tweet_count END) AS replies, max(CASE WHEN content_type = 'quotes' THEN tweet_count END) AS quotes FROM g)
 SELECT 'media' AS advice FROM a WHERE media > text * 1.5 UNION ALL SELECT 'text' FROM a WHERE text > media * 1.5 UNION ALL SELECT 'hashtags' FROM a WHERE tags > overall * 1.2 UNION ALL SELECT 'replies' FROM a WHERE replies > 5 UNION ALL SELECT 'quotes' FROM a WHERE quotes > 3""")
def content_advice(spark, d):
    return S.content_advice(S.content_types(posts(spark, d)))


@query("AGG-17", POSTS + """, g AS (SELECT count(CASE WHEN verified THEN 1 END) AS verified, count(CASE WHEN tweets_count > 10 THEN 1 END) AS active, count(CASE WHEN (following_count > 0 AND followers_count::DOUBLE / following_count < 0.1) OR (tweets_count = 0 AND followers_count < 10) THEN 1 END) AS suspicious, count(*) AS total FROM users)
 SELECT *, round(verified::DOUBLE / total * 30.0::DOUBLE + active::DOUBLE / total * 50.0::DOUBLE + (1.0::DOUBLE - suspicious::DOUBLE / total) * 20.0::DOUBLE, 2) AS quality_score FROM g""")
def audience_quality(spark, d):
    return S.audience_quality(users(spark, d))


@query("MTH-10", POSTS + "SELECT * FROM rates")
def author_rates(spark, d):
    return S.author_rates(posts(spark, d))


@query("MTH-09", POSTS + INFLUENCE + "SELECT user_id, influence_score FROM scored")
def influence_score(spark, d):
    return scored(spark, d).select("user_id", "influence_score")


SAMPLE_FIELDS = {"alpha": ["tion", "ment", "heit"], "beta": ["with", "para", "les "], "gamma": ["zu", "que", "ing"]}
TURNS = "turns AS (SELECT conv_id AS user_id, text, CASE WHEN turn = 0 THEN 2 ELSE 1 END AS weight FROM conversations)"
HITS = " UNION ALL ".join("SELECT user_id, '%s' AS field, (%s) * weight AS hits FROM turns" % (n, " + ".join(f"contains(lower(text), '{w}')::INT" for w in ws)) for n, ws in SAMPLE_FIELDS.items())
EXPERT = f"{TURNS}, h AS ({HITS}), f AS (SELECT user_id, field, sum(hits) AS hits FROM h GROUP BY 1, 2), fields AS (SELECT user_id, field, CAST(hits * 100.0 AS DOUBLE) / sum(hits) OVER (PARTITION BY user_id) AS share FROM f QUALIFY hits > 0)"


def fields(spark, d) -> DataFrame:
    turns = table(spark, d, "conversations").select(F.col("conv_id").alias("user_id"), "text", F.when(F.col("turn") == 0, 2).otherwise(1).alias("weight"))
    return S.expertise(turns, ["user_id"], "text", "weight", SAMPLE_FIELDS)


@query("STR-07", f"WITH {EXPERT} SELECT user_id, field, share FROM fields")
def expertise(spark, d):
    return fields(spark, d)


LEADERS = f", {EXPERT}, main AS (SELECT user_id, field FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY share DESC, field) AS r FROM fields) WHERE r = 1), found AS (SELECT s.*, coalesce(m.field, 'general') AS primary_field FROM scored s LEFT JOIN main m ON m.user_id = s.user_id WHERE followers_count >= 5000 AND influence_score >= 40.0)"


@query("MTH-11 WIN-28", POSTS + INFLUENCE + LEADERS + "SELECT user_id, influence_score, followers_count, primary_field FROM found ORDER BY influence_score DESC, user_id LIMIT 25")
def kols(spark, d):
    found = S.leaders(scored(spark, d), fields(spark, d), least_score=40.0)
    return found.select("user_id", "influence_score", "followers_count", "primary_field").orderBy(F.desc("influence_score"), "user_id").limit(25)


@query("AGG-18", POSTS + INFLUENCE + LEADERS + """SELECT count(*) AS total, count(CASE WHEN verified THEN 1 END) AS verified, round(count(CASE WHEN verified THEN 1 END) * 100.0::DOUBLE / count(*), 2) AS verification_rate,
 CAST(sum(CAST(influence_score AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS average_influence, median(influence_score) AS median_influence, sum(followers_count)::BIGINT AS total_reach FROM found""")
def kol_report(spark, d):
    return S.leader_report(S.leaders(scored(spark, d), fields(spark, d), least_score=40.0))


@query("WIN-26", POSTS + """, e AS (SELECT user_id, followers_count, followers_count - (user_id % 7) * 300 AS earlier FROM users) SELECT user_id, round((followers_count - earlier) * 100.0::DOUBLE / earlier + 1e-9, 2) AS growth_rate, followers_count - earlier AS followers_gained
 FROM e WHERE (followers_count - earlier) * 100.0::DOUBLE / earlier > 5.0 AND followers_count > 1000 ORDER BY 2 DESC, 1 LIMIT 20""")
def rising(spark, d):
    u = users(spark, d).withColumn("earlier_followers", F.col("followers_count") - (F.col("user_id") % 7) * 300)
    return S.rising(u, least_growth=5.0)


UP, DOWN = ["the ", "tion", "und "], ["ing ", "que", "sch"]
hits = lambda ws: "(" + " + ".join(f"contains(lower(text), '{w}')::INT" for w in ws) + ")"
SCORES = f"s AS (SELECT conv_id, turn, coalesce(CAST({hits(UP)} - {hits(DOWN)} AS DOUBLE) / nullif({hits(UP)} + {hits(DOWN)}, 0), 0.0) AS score FROM conversations), l AS (SELECT *, CASE WHEN score > 0 THEN 'positive' WHEN score < 0 THEN 'negative' ELSE 'neutral' END AS sentiment FROM s)"


def turn_scores(spark, d) -> DataFrame:
    c = table(spark, d, "conversations").select("conv_id", "turn", S.lexicon_score("text", UP, DOWN).alias("score"))
    return c.withColumn("sentiment", S.sentiment_label("score"))


@query("STR-07", f"SELECT doc_id, CASE WHEN {hits(UP)} > {hits(DOWN)} THEN 'bullish' WHEN {hits(DOWN)} > {hits(UP)} THEN 'bearish' END AS mood FROM documents")
def financial_sentiment(spark, d):
    return table(spark, d, "documents").select("doc_id", S.mood("text", UP, DOWN).alias("mood"))


@query("AGG-19", f"""WITH {SCORES}, g AS (SELECT count(*) AS total, count(CASE WHEN sentiment = 'positive' THEN 1 END) AS positive, count(CASE WHEN sentiment = 'neutral' THEN 1 END) AS neutral, count(CASE WHEN sentiment = 'negative' THEN 1 END) AS negative,
 round(avg(score), 6) AS average_score, round(stddev_pop(score), 6) AS score_std, min(score) AS score_min, max(score) AS score_max FROM l)
 SELECT *, round(positive * 100.0::DOUBLE / total + 1e-9, 2) AS positive_percent, round(neutral * 100.0::DOUBLE / total + 1e-9, 2) AS neutral_percent, round(negative * 100.0::DOUBLE / total + 1e-9, 2) AS negative_percent,
 CASE greatest(positive, neutral, negative) WHEN positive THEN 'positive' WHEN neutral THEN 'neutral' ELSE 'negative' END AS dominant FROM g""")
def sentiment_summary(spark, d):
    return S.sentiment_summary(turn_scores(spark, d))


@query("MLV-10 WIN-24 AGG-30", f"""WITH {SCORES}, i AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS DOUBLE) AS i FROM l), g AS (SELECT conv_id, count(*) AS n, avg(score) AS mean, stddev_pop(score) AS std, regr_slope(score, i) AS slope FROM i GROUP BY 1),
 m AS (SELECT conv_id, sentiment, c FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY c DESC, sentiment DESC) AS r FROM (SELECT conv_id, sentiment, count(*) AS c FROM l GROUP BY 1, 2)) WHERE r = 1)
 SELECT g.conv_id, n, round(mean, 6) AS thread_score, round(std, 6) AS thread_std, CASE WHEN n < 2 THEN 'stable' WHEN slope > 0.1 THEN 'improving' WHEN slope < -0.1 THEN 'declining' ELSE 'stable' END AS trend, sentiment AS dominant, CASE WHEN n < 2 THEN 1.0::DOUBLE ELSE c::DOUBLE / n END AS consistency FROM g JOIN m ON m.conv_id = g.conv_id""")
def thread_trend(spark, d):
    return S.threads(turn_scores(spark, d), "conv_id", "turn")


@query("MTH-12", f"""WITH {SCORES}, g AS (SELECT conv_id, CAST(sum(CASE sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END) AS DOUBLE) / count(*) AS mean, count(*) AS n FROM l GROUP BY 1) SELECT *, CASE WHEN mean > 0.3 THEN 'positive' WHEN mean < -0.3 THEN 'negative' ELSE 'neutral' END AS stance FROM g""")
def kol_stance(spark, d):
    return S.stance(turn_scores(spark, d), "conv_id")


@query("AGG-16", f"WITH {SCORES} SELECT conv_id, turn, CASE WHEN sentiment = 'positive' THEN abs(score) ELSE -abs(score) END AS signed_score FROM l")
def signed_scores(spark, d):
    return turn_scores(spark, d).withColumn("score", F.abs("score")).select("conv_id", "turn", S.signed_score("sentiment", "score").alias("signed_score"))


@query("STR-12", r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url || ' @you  $ABC #tag', '@\w+', '@user', 'g'), 'http\S+|www.\S+', 'http', 'g'), '\$([A-Z]+)', 'TICKER_\1', 'g'), '#(\w+)', '# \1', 'g'), '\s+', ' ', 'g')) AS clean FROM pages""")
def tweet_preprocess(spark, d):
    return table(spark, d, "pages").select("page_id", clean_post(F.concat("url", F.lit(" @you  $ABC #tag"))).alias("clean"))
