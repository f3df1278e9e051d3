"""Readers and writers of delimited text, JSON results and reports, and what contact imports and migrations do with their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Headers of contact files and the columns they mean.
CONTACT_HEADERS = {
    "email": "email", "first_name": "first_name", "firstname": "first_name", "last_name": "last_name", "lastname": "last_name", "company": "company",
    "title": "title", "linkedin_url": "linkedin_url", "linkedin": "linkedin_url", "sequence": "sequence",
}
CONTACT_COLUMNS = ["email", "first_name", "last_name", "company", "title", "linkedin_url", "sequence"]
#: Columns of old contact lists and their new names, and what new columns hold by default.
MIGRATED = {
    "First Name": "First Name", "Last Name": "Last Name", "Title": "Title", "Company": "Company", "Email": "Email", "Linkedin Url": "LinkedIn URL", "LinkedIn URL": "LinkedIn URL",
    "Message Sequence Sheet": "Sequence", "Campaign Start Date": "Campaign Start Date", "Paused?": "Status", "Replied to Email?": "Reply Channel", "Replied to LinkedIn?": "Reply Channel",
    "Reply Date": "Reply Date", "Notes": "Notes",
}
MIGRATED_DEFAULTS = {"Status": "Active", "Priority": "Medium", "Source": "Migration", "Last Contact Date": "", "Response Type": "", "Next Action": ""}


def read_organisations(spark: SparkSession, path: str) -> DataFrame:
    """(patent_id, assignee_id, name, type) of tab-separated text with a header: columns by name, quotes taken off, rows without an
    organisation and rows that are too short skipped, names cut at 500 characters. Zipped files cannot be split: unzip them first."""
    raw = spark.read.option("sep", "\t").option("header", True).option("quote", '"').option("mode", "PERMISSIVE").csv(path)
    name = F.col("disambig_assignee_organization")
    return raw.where(F.coalesce(name, F.lit("")) != "").select("patent_id", "assignee_id", F.substring(name, 1, 500).alias("name"), F.col("assignee_type").alias("type"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Quoted CSV with a header, all columns text; quotes are doubled, values may hold line breaks."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)


def contacts_of(rows: DataFrame) -> DataFrame:
    """Contact columns whatever their header's case and alias, trimmed; of several aliases the last filled one; null where none is."""
    plain = lambda c: F.nullif(F.trim(F.col(f"`{c}`").cast("string")), F.lit(""))
    out = []
    for name in CONTACT_COLUMNS:
        own = [c for c in rows.columns if CONTACT_HEADERS.get(c.strip().lower()) == name]
        out.append((F.coalesce(*[plain(c) for c in reversed(own)]) if own else F.lit(None).cast("string")).alias(name))
    rest = [c for c in rows.columns if c.strip().lower() not in CONTACT_HEADERS]
    return rows.select(*out, *[F.col(f"`{c}`") for c in rest])


def import_contacts(rows: DataFrame, existing: DataFrame, order: str) -> DataFrame:
    """Rows that an import adds: those with an e-mail that is neither known nor in an earlier row (case aside). Missing texts are empty,
    a missing sequence is Default."""
    key = F.lower("email")
    fresh = rows.where("email IS NOT NULL").withColumn("_key", key).join(existing.select(key.alias("_key")).distinct(), "_key", "left_anti")
    first = F.row_number().over(Window.partitionBy("_key").orderBy(order))
    kept = fresh.withColumn("_n", first).where("_n = 1")
    text = {c: F.coalesce(c, F.lit("Default" if c == "sequence" else "")) for c in CONTACT_COLUMNS}
    return kept.select(*[v.alias(c) for c, v in text.items()])


def typed_contacts(rows: DataFrame) -> DataFrame:
    """Contacts with the defaults of absent values and the flags computed from them."""
    text = lambda c, d="": F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(d))
    channel = F.lower(text("reply_channel"))
    return rows.select(
        text("first_name").alias("first_name"), text("email").alias("email"), text("sequence").alias("sequence"), text("status", "Active").alias("status"), text("priority", "Medium").alias("priority"),
        (F.lower(text("status")) == "paused").alias("paused"), F.contains(channel, F.lit("email")).alias("replied_to_email"), F.contains(channel, F.lit("linkedin")).alias("replied_to_linkedin"),
        ((text("email") != "") & (text("first_name") != "") & (text("sequence") != "")).alias("is_valid"), F.coalesce(F.nullif(text("first_name"), F.lit("")), F.nullif(text("email"), F.lit("")), F.lit("Unknown Contact")).alias("display_name"),
    )


def migrate_contacts(rows: DataFrame, targets: list[str]) -> DataFrame:
    """Contact rows under their new columns: renamed, statuses and links and reply channels converted, defaults set, the rest empty."""
    have = set(rows.columns)
    col = lambda c: F.col(f"`{c}`").cast("string") if c in have else F.lit(None).cast("string")
    mail, link = (F.coalesce(col(f"Replied to {x}?") == "Yes", F.lit(False)) for x in ("Email", "LinkedIn"))
    url = F.trim(F.coalesce(col("LinkedIn URL"), col("Linkedin Url"), F.lit("")))
    made = {
        "Status": F.when(F.lower(col("Paused?")).isin("yes", "true", "paused"), "Paused").otherwise("Active"),
        "LinkedIn URL": F.when((url != "") & ~url.startswith("http"), F.concat(F.lit("https://www."), url)).otherwise(url),
        "Reply Channel": F.when(mail & link, "Both").when(mail, "Email").when(link, "LinkedIn").otherwise(""),
    }
    out = []
    for t in targets:
        value = made.get(t) if any(MIGRATED.get(c) == t for c in have) else None
        if value is None:
            value = F.coalesce(*[col(c) for c, new in MIGRATED.items() if new == t and c in have], F.lit(""))
        out.append(F.coalesce(F.nullif(value, F.lit("")), F.lit(MIGRATED_DEFAULTS.get(t, ""))).alias(t))
    return rows.select(*out)


def first_contained(messages: DataFrame, contacts: DataFrame, sender: str, email: str, order: str) -> DataFrame:
    """Messages with the first contact (by ``order``) whose e-mail stands in the sender's text; messages without one are absent.

    An address with one @ stands in a text where its domain begins what follows an @ of the text, and its name ends what stands before.
    What follows an @, cut to each length that domains of contacts have, is joined to the domains; what stands before, cut to each
    length that names of the domain found have, to the addresses. So the rows of an @ are bounded by the lengths of contacts, and the
    time grows with the text. Contacts whose e-mail is null or has not one @ between two parts without blanks match nothing.
    """
    named = contacts.where(F.col(email).rlike(r"^[^@\s]+@[^@\s]+$")).groupBy(F.col(email).alias("_key")).agg(F.min(order).alias(order))
    named = named.withColumn("_domain", F.substring_index("_key", "@", -1))
    domains = named.groupBy("_domain").agg(F.collect_set(F.length("_key") - F.length("_domain") - 1).alias("_names"))
    lengths = domains.agg(F.collect_set(F.length("_domain")).alias("_lengths"))  # one row
    part = F.split(F.col("_run"), "@")
    runs = F.filter(F.split(F.col(sender), r"\s+"), lambda x: F.contains(x, F.lit("@")))
    rows = messages.withColumn("_run", F.explode(F.array_distinct(runs)))
    sides = F.transform(F.sequence(F.lit(1), F.size(part) - 1), lambda k: F.struct(F.element_at(part, k).alias("l"), F.element_at(part, k + 1).alias("r")))
    rows = rows.withColumn("_at", F.explode(F.array_distinct(sides))).select(*messages.columns, F.col("_at.l").alias("_l"), F.col("_at.r").alias("_r"))
    rows = rows.where("_l <> '' AND _r <> ''").join(F.broadcast(lengths))
    rows = rows.withColumn("_n", F.explode(F.filter("_lengths", lambda n: n <= F.length("_r")))).withColumn("_domain", F.left("_r", F.col("_n"))).drop("_lengths", "_r", "_n")
    rows = rows.join(domains, "_domain").withColumn("_n", F.explode(F.filter("_names", lambda n: n <= F.length("_l"))))
    hits = rows.withColumn("_key", F.concat(F.right("_l", F.col("_n")), F.lit("@"), "_domain")).select(*messages.columns, "_key").join(named.select("_key", order), "_key")
    return hits.groupBy(*messages.columns).agg(F.min(order).alias(order))


def result_issues(results: DataFrame) -> DataFrame:
    """(case, issue) of result files with an array of test cases: many duplicates, slower than before, little reduction."""
    c = results.select(F.posexplode("test_cases").alias("i", "c")).select("c.*")
    found = {
        "high duplicates": F.coalesce(F.col("normalization_analysis.current_duplicate_count"), F.lit(0)) > 5,
        "slower": F.coalesce(F.col("performance.speed_improvement"), F.lit(1.0)) < 1,
        "low reduction": F.coalesce(F.col("performance.reduction_percentage"), F.lit(0.0)) < 10,
    }
    return c.select("id", F.explode(F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in found.items()]))).alias("issue"))


def markdown_report(cases: DataFrame, title: str, key: str, lines: dict[str, Column]) -> DataFrame:
    """(section, line, text): a heading, then one section a case in order of its key. Sections are written one a row, so a report of
    any length is written by all tasks."""
    head = cases.sparkSession.createDataFrame([("", 0, f"# {title}")], "section string, line int, text string")
    parts = [F.concat(F.lit("## "), F.col(key).cast("string")), *[F.concat(F.lit(f"- **{n}**: "), v) for n, v in lines.items()]]
    return head.unionByName(cases.select(F.col(key).cast("string").alias("section"), F.posexplode(F.array(*parts)).alias("line", "text")))


def glob_pattern(pattern: str) -> str:
    """A file-name pattern (*, ?, [seq], [!seq]) as a regular expression of a whole key."""
    import fnmatch

    return fnmatch.translate(pattern).replace("(?s:", "(?s)(?:").replace("\\Z", "$").replace("\\z", "$")


def invalidate(entries: DataFrame, key: str, exact: str | None = None, namespace: str | None = None, pattern: str | None = None) -> DataFrame:
    """Entries left after dropping a key, else those of a namespace, else those a pattern matches."""
    k = F.col(key)
    gone = k == exact if exact else k.startswith(namespace + ".") if namespace else k.rlike("^" + glob_pattern(pattern)) if pattern else F.lit(False)
    return entries.where(~F.coalesce(gone, F.lit(False)))
