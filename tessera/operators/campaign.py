"""Contacts in sequences: due actions, progress, responses, batches, texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.numeric import clamp


def on_day(start: Column, as_of: Column) -> Column:
    """Day of a sequence, the first being 1; null before it starts."""
    n = F.datediff(as_of, start)
    return F.when(n >= 0, n + 1)


def due(contacts: DataFrame, steps: DataFrame, sent: DataFrame, as_of: Column) -> DataFrame:
    """Steps of today that active contacts have not had: (contact, sequence, day, action)."""
    now = contacts.where(F.col("active")).withColumn("day", on_day(F.col("start"), as_of)).where("day IS NOT NULL")
    return now.join(steps, ["sequence", "day"]).join(sent.select("contact", "day", "action"), ["contact", "day", "action"], "left_anti").select("contact", "sequence", "day", "action")


def status(contacts: DataFrame, steps: DataFrame, sent: DataFrame, as_of: Column) -> DataFrame:
    """Per contact: state, day, completed and upcoming steps, progress in whole percent."""
    total = steps.groupBy("sequence").agg(F.count("*").alias("steps"))
    done = sent.groupBy("contact").agg(F.count("*").alias("done"))
    rows = contacts.withColumn("day", on_day(F.col("start"), as_of)).join(total, "sequence", "left").join(done, "contact", "left")
    state = F.when(F.col("start").isNull(), "not started").when(F.col("replied"), "replied").when(~F.col("active"), "paused").when(F.coalesce("done", F.lit(0)) >= F.col("steps"), "completed").otherwise("active")
    return rows.select("contact", "sequence", "day", state.alias("state"), F.coalesce("done", F.lit(0)).alias("done"), F.round(F.try_divide(F.coalesce("done", F.lit(0)) * 100.0, F.col("steps"))).alias("progress"))


def sends_by_day(wide: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(date, n) from one date column per step: unpivoted, then counted."""
    long = wide.unpivot([key], columns, "step", "sent").where("sent IS NOT NULL")
    return long.groupBy(F.to_date("sent").alias("date")).agg(F.count("*").alias("n"))


def response_rates(contacts: DataFrame, good: float = 15.0, bad: float = 5.0, least: int = 10) -> DataFrame:
    """Share of started contacts that replied, by sequence, with a verdict."""
    g = contacts.where("start IS NOT NULL").groupBy("sequence").agg(F.count("*").alias("n"), F.count(F.when(F.col("replied"), 1)).alias("replies"))
    rate = F.round(F.col("replies") * 100.0 / F.col("n") + 1e-9, 1)
    return g.withColumn("rate", rate).withColumn("verdict", F.when(F.col("rate") > good, "good").when((F.col("rate") < bad) & (F.col("n") > least), "needs improvement").otherwise("normal"))


def priority(day: Column, title: Column, first: Column, company: Column, hour: Column) -> Column:
    """50 and points for early days, chief executives, complete contacts and mornings; less late; within 0 and 100."""
    pts = lambda c, p: F.when(c, p).otherwise(0)
    p = 50 + pts(day <= 3, 20) + pts(F.contains(F.lower(title), F.lit("ceo")), 15) + pts((F.length(first) > 0) & (F.length(company) > 0), 10) - pts(day > 10, 10) + pts(hour.between(8, 11), 15)
    return clamp(p, 0, 100)


def action_of(kind: Column, subject: Column, content: Column) -> Column:
    """email, connect or message by the first word that says so; with subject and content an email."""
    t = F.lower(F.coalesce(kind, F.lit("")))
    return F.when(t.rlike("email|e-mail"), "email").when(t.rlike("connect|invite"), "connect").when(t.rlike("message|dm"), "message").when((F.length(subject) > 0) & (F.length(content) > 0), "email")


def issues(email: Column, url: Column, sequence: Column) -> Column:
    """What is wrong with a contact."""
    from tessera.functions.text import labels, valid_email

    return labels({"email": ~valid_email(email), "url": F.coalesce(~url.rlike(r"^https?://(www\.)?linkedin\.com/in/[\w\-]+/?$"), F.lit(True)), "sequence": F.coalesce(F.length(F.trim(sequence)) == 0, F.lit(True))})


def clean_profile_url(url: Column) -> Column:
    """One profile prefix, https, no slash at the end."""
    u = F.trim(url)
    last = F.element_at(F.split(u, "/in/"), -1)
    u = F.when(F.size(F.split(u, "linkedin.com/in/")) > 2, F.concat(F.lit("https://www.linkedin.com/in/"), last)).otherwise(u)
    u = F.regexp_replace(u, "/+$", "")
    return F.when(u.startswith("www.linkedin.com"), F.concat(F.lit("https://"), u)).when(u.startswith("linkedin.com"), F.concat(F.lit("https://www."), u)).otherwise(u)


def any_of(keywords: Column, most: int = 7) -> Column:
    """a OR b of a comma-separated list, the first ``most``."""
    parts = F.filter(F.transform(F.split(keywords, ","), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    return F.regexp_replace(F.array_join(F.slice(parts, 1, most), " OR "), r"\s+", " ")


def search_url(keywords: Column) -> Column:
    return F.concat(F.lit("https://www.linkedin.com/search/results/people/?keywords="), F.url_encode(any_of(keywords)))


def processing_seconds(kind: Column, size: Column) -> Column:
    return F.when(kind == "email", 0.5).when(kind == "connect", 1.0).when(kind == "message", 1.5).otherwise(1.0) * size


def next_batch_size(size: Column, error_rate: Column, most: Column) -> Column:
    """Seven tenths after many errors, six fifths after few, at most ``most``."""
    return F.least(F.when(error_rate > 0.1, F.floor(size * 0.7)).when(error_rate < 0.02, F.floor(size * 1.2)).otherwise(size), most)


def pending_connections(contacts: DataFrame, as_of: Column, least_days: int = 1) -> DataFrame:
    """Requests of a day or more ago, neither accepted nor failed."""
    waiting = F.datediff(as_of, F.col("requested"))
    return contacts.where(F.col("requested").isNotNull() & ~F.coalesce("accepted", F.lit(False)) & ~F.coalesce("failed", F.lit(False)) & (waiting >= least_days)).withColumn("waiting_days", waiting)


def tracking_columns(steps: DataFrame) -> DataFrame:
    """Column a contact table needs for each step, by sequence."""
    name = F.when(F.col("action") == "email", "Email").when(F.col("action") == "connect", "LinkedIn Connect").otherwise("LinkedIn DM")
    return steps.select("sequence", F.concat_ws(" ", F.lit("Day"), F.col("day").cast("string"), name, F.lit("Sent")).alias("column")).distinct()


def valid_sequences(steps: DataFrame, content: str, last_day: int = 60) -> DataFrame:
    """Whether each sequence has content in every step and ends within ``last_day`` days."""
    return steps.groupBy("sequence").agg(F.max("day").alias("last_day"), F.count(F.when(F.length(F.coalesce(content, F.lit(""))) == 0, 1)).alias("empty")).withColumn("valid", (F.col("empty") == 0) & (F.col("last_day") <= last_day))


def advice(metrics: DataFrame, name: str, value: str, rules: list[tuple[str, float, str]]) -> DataFrame:
    """Recommendations of the metrics that fall below their threshold."""
    said = F.array_compact(F.array(*[F.when((F.col(name) == n) & (F.col(value) < t), F.lit(text)) for n, t, text in rules]))
    return metrics.select(name, F.explode(said).alias("advice"))
