"""Engagement, reach and sentiment of posts and their authors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import exact_avg, ratio
from tessera.functions.text import keyword_hits

#: What one reaction of each kind is worth.
WEIGHTS = {"like_count": 1, "retweet_count": 2, "reply_count": 3, "quote_count": 4}
#: Words that mark a post as hopeful or gloomy.
BULLISH = ["bullish", "buy", "long", "upgrade", "outperform", "beat", "exceeded", "growth", "profit", "revenue", "breakthrough"]
BEARISH = ["bearish", "sell", "short", "downgrade", "underperform", "miss", "declined", "loss", "risk", "concern", "failed"]
#: Words of the fields an author may be expert in.
FIELDS = {
    "biotech": ["biotech", "pharma", "drug", "fda", "clinical", "trial", "therapy", "treatment", "oncology", "genomics", "vaccine", "antibody", "molecule", "compound", "biologic"],
    "finance": ["invest", "stock", "market", "trading", "ipo", "valuation", "earnings", "revenue", "portfolio", "equity", "capital", "merger", "acquisition", "analyst", "bullish", "bearish"],
    "healthcare": ["health", "medical", "patient", "doctor", "hospital", "diagnosis", "disease", "medicine", "healthcare", "clinical"],
    "technology": ["ai", "ml", "tech", "software", "data", "digital", "innovation", "startup", "platform", "algorithm"],
}


def count_of(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def total_engagement() -> Column:
    return sum((count_of(c) for c in list(WEIGHTS)[1:]), count_of("like_count"))


def engagement_rate(posts: DataFrame) -> DataFrame:
    """Weighted reactions per impression in percent, at most 100; impressions default to a tenth of the followers."""
    weighted = sum((count_of(c) * w for c, w in list(WEIGHTS.items())[1:]), count_of("like_count"))
    seen = F.coalesce(F.when(F.col("impressions") != 0, F.col("impressions").cast("double")), F.coalesce(F.col("followers"), F.lit(1000)).cast("double") * 0.1)
    return posts.withColumn("rate", F.when(seen > 0, F.least(weighted / seen * 100.0, F.lit(100.0))).otherwise(0.0))


def baseline(posts: DataFrame) -> DataFrame:
    """Mean, median, population deviation and 95th percentile of total engagement: one row."""
    t = posts.select(total_engagement().alias("t"))
    return t.agg(exact_avg("t").alias("mean_engagement"), F.median("t").alias("median_engagement"), F.round(F.stddev_pop("t"), 2).alias("std_engagement"), F.percentile("t", 0.95).alias("percentile_95"))


def viral(posts: DataFrame, as_of: Column, least: int = 100, times: float = 100.0) -> DataFrame:
    """Posts far above the mean, with a score of speed (30), relative size (40) and depth (30)."""
    rows = posts.withColumn("total", total_engagement())
    mean = rows.agg(exact_avg("total").alias("mean"))  # one row
    hours = F.greatest((as_of.cast("double") - F.col("created_at").cast("timestamp").cast("double")) / 3600.0, F.lit(1.0))
    speed = F.least((count_of("like_count") + count_of("retweet_count")) / hours / 100.0, F.lit(1.0)) * 30.0
    size = F.least(F.col("total") / F.greatest(F.col("mean") * 10.0, F.lit(1.0)), F.lit(1.0)) * 40.0
    depth = F.least((count_of("reply_count") + count_of("quote_count")) / 50.0, F.lit(1.0)) * 30.0
    out = rows.join(F.broadcast(mean)).where((F.col("total") >= least) & (F.col("total") > F.col("mean") * times))
    return out.select("tweet_id", F.col("total").alias("total_engagement"), (F.col("total") / F.greatest("mean", F.lit(1.0))).alias("viral_multiplier"), F.round(speed + size + depth, 2).alias("viral_score"))


def timing(posts: DataFrame, keys: dict[str, Column], k: int, least: int = 1) -> DataFrame:
    """Mean engagement by parts of the posting time, best first; groups of fewer than ``least`` posts are left out."""
    names = list(keys)
    g = posts.where("created_at IS NOT NULL").groupBy(*[c.alias(n) for n, c in keys.items()]).agg(exact_avg(total_engagement()).alias("average_engagement"), F.count("*").alias("tweet_count"))
    return g.where(F.col("tweet_count") >= least).orderBy(F.desc("average_engagement"), *names).limit(k)


def content_types(posts: DataFrame) -> DataFrame:
    """Engagement by kind of content; media, links or text alone, and besides hashtags, replies or quotes."""
    kind = F.when(F.col("has_media"), "with_media").when(F.col("has_url"), "with_links").otherwise("text_only")
    kinds = F.array_compact(F.array(kind, F.when(F.col("has_hashtag"), "with_hashtags"), F.when(F.col("tweet_type") == "reply", "replies").when(F.col("tweet_type") == "quote", "quotes")))
    rows = posts.select(F.explode(kinds).alias("content_type"), total_engagement().alias("t"))
    return rows.groupBy("content_type").agg(F.count("*").alias("tweet_count"), exact_avg("t").alias("average_engagement"), F.median("t").alias("median_engagement"), F.max("t").alias("max_engagement"), F.sum("t").alias("total_engagement"))


def best_of(groups: DataFrame, name: str, value: str) -> DataFrame:
    """The group with the greatest value, ties to the first name: one row."""
    return groups.agg(F.min_by(name, F.struct((-F.col(value)).alias("v"), F.col(name).alias("n"))).alias("best"))


def content_advice(types: DataFrame) -> DataFrame:
    """One row per recommendation that the content types give rise to."""
    at = lambda n, c: F.max(F.when(F.col("content_type") == n, F.col(c)))
    one = types.agg(
        at("with_media", "average_engagement").alias("media"), at("text_only", "average_engagement").alias("text"), at("with_hashtags", "average_engagement").alias("tags"), F.avg("average_engagement").alias("overall"),
        at("replies", "tweet_count").alias("replies"), at("quotes", "tweet_count").alias("quotes"),
    )
    said = F.array_compact(F.array(
        F.when(F.col("media") > F.col("text") * 1.5, "media").when(F.col("text") > F.col("media") * 1.5, "text"),
        F.when(F.col("tags") > F.col("overall") * 1.2, "hashtags"), F.when(F.col("replies") > 5, "replies"), F.when(F.col("quotes") > 3, "quotes"),
    ))
    return one.select(F.explode(said).alias("advice"))


def audience_quality(users: DataFrame) -> DataFrame:
    """Shares of verified, active and suspicious followers and a score of 30, 50 and 20 points: one row, 0 without users."""
    odd = (F.col("following_count") > 0) & (F.col("followers_count") / F.nullif("following_count", F.lit(0)) < 0.1)
    odd = odd | ((F.col("tweets_count") == 0) & (F.col("followers_count") < 10))
    n = lambda c: F.count(F.when(c, 1))
    g = users.agg(n(F.col("verified")).alias("verified"), n(F.col("tweets_count") > 10).alias("active"), n(odd).alias("suspicious"), F.count("*").alias("total"))
    part = lambda c: ratio(c, "total")
    score = F.when(F.col("total") > 0, part("verified") * 30.0 + part("active") * 50.0 + (1.0 - part("suspicious")) * 20.0).otherwise(0.0)
    return g.withColumn("quality_score", F.round(score, 2))


def author_rates(posts: DataFrame) -> DataFrame:
    """Mean engagement per author in percent of a tenth of the followers; quotes do not count here."""
    own = count_of("like_count") + count_of("retweet_count") + count_of("reply_count")
    return posts.groupBy("user_id").agg(exact_avg(own).alias("mean"), F.max("followers").alias("f")).select("user_id", F.coalesce(F.try_divide(F.col("mean"), F.coalesce("f", F.lit(1000)) * 0.1) * 100.0, F.lit(0.0)).alias("engagement_rate"))


def influence(users: DataFrame, as_of: Column) -> DataFrame:
    """Score 0 to 100: reach 30, engagement 25, authority 20, activity 15, network 10. users has engagement_rate."""
    f = F.coalesce("followers_count", F.lit(0)).cast("double")
    reach = F.least(F.log10(F.greatest(f, F.lit(1.0))) / 6.0 * 100.0, F.lit(100.0))
    engaged = F.least(F.coalesce("engagement_rate", F.lit(0.0)) * 10.0, F.lit(100.0))
    filled = lambda c: F.coalesce(F.length(F.col(c)) > 0, F.lit(False))
    pts = lambda c, p: F.when(c, p).otherwise(0.0)
    authority = pts(F.coalesce("verified", F.lit(False)), 50.0) + pts(filled("bio"), 25.0) + pts(filled("location"), 15.0) + pts(filled("website"), 10.0)
    days = F.greatest(F.coalesce(F.floor((as_of.cast("double") - F.col("created_at").cast("timestamp").cast("double")) / 86400.0), F.lit(1)), F.lit(1)).cast("double")
    active = F.least(F.coalesce("tweets_count", F.lit(0)) / days * 20.0, F.lit(100.0))
    network = F.least(f / F.greatest(F.coalesce("following_count", F.lit(1)), F.lit(1)).cast("double") * 10.0, F.lit(100.0))
    score = reach * 0.30 + engaged * 0.25 + authority * 0.20 + active * 0.15 + network * 0.10
    return users.withColumn("influence_score", F.round(score, 2))


def expertise(texts: DataFrame, keys: list[str], text: str, weight: str, fields: dict[str, list[str]] | None = None) -> DataFrame:
    """(keys, field, share in percent) from words found in each text, rows weighing ``weight`` (a profile 2, a post 1)."""
    fields = fields or FIELDS
    found = F.array(*[F.struct(F.lit(n).alias("field"), (keyword_hits(text, w) * F.col(weight)).alias("hits")) for n, w in fields.items()])
    g = texts.select(*keys, F.explode(found).alias("x")).groupBy(*keys, F.col("x.field").alias("field")).agg(F.sum("x.hits").alias("hits"))
    total = F.sum("hits").over(Window.partitionBy(*keys))
    return g.withColumn("share", F.try_divide(F.col("hits") * 100.0, total)).where("hits > 0").select(*keys, "field", "share")


def leaders(scored: DataFrame, fields: DataFrame, least_followers: int = 5000, least_score: float = 80.0, field: str | None = None) -> DataFrame:
    """Authors with reach and score enough, their main field (general if none), optionally experts of one field (20 percent)."""
    main = fields.groupBy("user_id").agg(F.min_by("field", F.struct((-F.col("share")).alias("s"), "field")).alias("primary_field"), F.max(F.when(F.col("field") == (field or ""), F.col("share"))).alias("own"))
    out = scored.where((F.col("followers_count") >= least_followers) & (F.col("influence_score") >= least_score)).join(main, "user_id", "left")
    out = out.where(F.coalesce("own", F.lit(0.0)) >= 20) if field else out
    return out.withColumn("primary_field", F.coalesce("primary_field", F.lit("general"))).drop("own")


def leader_report(found: DataFrame) -> DataFrame:
    return found.agg(
        F.count("*").alias("total"), F.count(F.when(F.col("verified"), 1)).alias("verified"), F.round(F.try_divide(F.count(F.when(F.col("verified"), 1)) * 100.0, F.count("*")), 2).alias("verification_rate"),
        exact_avg("influence_score").alias("average_influence"), F.median("influence_score").alias("median_influence"), F.sum("followers_count").alias("total_reach"),
    )


def rising(users: DataFrame, least_growth: float = 20.0, least_followers: int = 1000, k: int = 20) -> DataFrame:
    """Authors whose followers grew most since the earlier snapshot."""
    now, then = F.col("followers_count"), F.coalesce("earlier_followers", "followers_count")
    growth = F.coalesce(F.try_divide((now - then) * 100.0, then), F.lit(0.0))
    rows = users.withColumn("growth", growth).where((F.col("growth") > least_growth) & (now > least_followers))
    return rows.select("user_id", F.round(F.col("growth") + 1e-9, 2).alias("growth_rate"), (now - then).alias("followers_gained")).orderBy(F.desc("growth_rate"), "user_id").limit(k)


def mood(text, up: list[str] | None = None, down: list[str] | None = None) -> Column:
    """bullish, bearish or null by which list has more words in the text."""
    a, b = keyword_hits(text, up or BULLISH), keyword_hits(text, down or BEARISH)
    return F.when(a > b, "bullish").when(b > a, "bearish")


def lexicon_score(text, up: list[str], down: list[str]) -> Column:
    """-1 to 1: the default scorer, where a model would be plugged in as a pandas UDF of the same form."""
    a, b = keyword_hits(text, up), keyword_hits(text, down)
    return F.coalesce(F.try_divide((a - b).cast("double"), (a + b).cast("double")), F.lit(0.0))


def sentiment_label(score) -> Column:
    c = F.col(score) if isinstance(score, str) else score
    return F.when(c > 0, "positive").when(c < 0, "negative").otherwise("neutral")


def sentiment_summary(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts, percents, mean, spread and dominant label of (score, sentiment) rows."""
    n = lambda s: F.count(F.when(F.col("sentiment") == s, 1))
    aggs = [F.count("*").alias("total"), *[n(s).alias(s) for s in ("positive", "neutral", "negative")], *[F.round(F.try_divide(n(s) * 100.0, F.count("*")) + 1e-9, 2).alias(f"{s}_percent") for s in ("positive", "neutral", "negative")],
            F.round(F.avg("score"), 6).alias("average_score"), F.round(F.stddev_pop("score"), 6).alias("score_std"), F.min("score").alias("score_min"), F.max("score").alias("score_max")]
    g = rows.groupBy(*keys).agg(*aggs) if keys else rows.agg(*aggs)
    top = F.greatest("positive", "neutral", "negative")
    return g.withColumn("dominant", F.when(F.col("positive") == top, "positive").when(F.col("neutral") == top, "neutral").otherwise("negative"))


def threads(rows: DataFrame, key: str, place: str) -> DataFrame:
    """Per thread of (score, sentiment) rows: mean, deviation, trend of the slope, dominant label and how consistent it is.

    A slope of just 0.1 falls on either side by its last digit, so it is taken as SQL takes it: rows in order, one moment over the other."""
    w = Window.partitionBy(key).orderBy(place)
    numbered = rows.withColumn("i", (F.row_number().over(w) - 1).cast("double"))
    g = numbered.groupBy(key).agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), F.try_divide(F.covar_pop("i", "score"), F.var_pop("i")).alias("slope"))
    most = rows.groupBy(key, "sentiment").agg(F.count("*").alias("c")).groupBy(key).agg(F.max_by("sentiment", F.struct("c", "sentiment")).alias("dominant"), F.max("c").alias("c"))
    trend = F.when(F.col("n") < 2, "stable").when(F.col("slope") > 0.1, "improving").when(F.col("slope") < -0.1, "declining").otherwise("stable")
    return g.join(most, key).select(key, "n", F.round("mean", 6).alias("thread_score"), F.round("std", 6).alias("thread_std"), trend.alias("trend"), "dominant", F.when(F.col("n") < 2, 1.0).otherwise(F.col("c") / F.col("n")).alias("consistency"))


def stance(rows: DataFrame, key: str) -> DataFrame:
    """Mean of +1, 0, -1 labels towards a subject: positive above 0.3, negative below -0.3."""
    v = F.when(F.col("sentiment") == "positive", 1).when(F.col("sentiment") == "negative", -1).otherwise(0)
    g = rows.groupBy(key).agg(exact_avg(v).alias("mean"), F.count("*").alias("n"))
    return g.withColumn("stance", F.when(F.col("mean") > 0.3, "positive").when(F.col("mean") < -0.3, "negative").otherwise("neutral"))


def signed_score(label, score) -> Column:
    """The score as it is for positive labels, negated for all others, neutral ones too."""
    return F.when(F.col(label) == "positive", F.col(score)).otherwise(-F.col(score))


