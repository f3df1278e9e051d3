"""Upserts, versioned state, typed parameters, ingest and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .relational import latest_each


def upsert(existing: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last writer wins by key: one aggregation over both, so a batch may hold a key more than once."""
    return latest_each(existing.unionByName(new), keys, order)


def insert_absent(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """existing and those rows of new whose key it lacks."""
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti"))


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Columns changed in the rows that meet a condition, as UPDATE would."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in changes.items()})


def update_latest(df: DataFrame, keys: list[str], order: str, changes: dict[str, Column]) -> DataFrame:
    """Columns changed in the newest row of each key."""
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order))) == 1
    return update_where(df.withColumn("_newest", newest), F.col("_newest"), changes).drop("_newest")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(~F.coalesce(condition, F.lit(False)))


def counters(events: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Occurrences and first and last time of each key."""
    return events.groupBy(*keys).agg(F.count("*").alias("failure_count"), F.min(time).alias("created_at"), F.max(time).alias("updated_at"))


def resolve_on_success(alerts: DataFrame, successes: DataFrame, key: str, time: str) -> DataFrame:
    """State of each alert: resolved where a success of its key came after it."""
    last = successes.groupBy(key).agg(F.max(time).alias("_last"))
    rows = alerts.join(last, key, "left")
    return rows.withColumn("state", F.when(F.col("_last") > F.col(time), "resolved").otherwise("active")).drop("_last")


def overlay(defaults: DataFrame, values: DataFrame, key: str, value: str) -> DataFrame:
    """Each parameter's stored value, else its default."""
    return defaults.join(values.select(key, F.col(value).alias("_v")), key, "left").withColumn(value, F.coalesce("_v", value)).withColumn("source", F.when(F.col("_v").isNotNull(), "stored").otherwise("default")).drop("_v")


def typed(kind: Column, text: Column) -> dict[str, Column]:
    """A parameter's text as each type; null where its type is another or the text does not parse."""
    return {
        "as_long": F.when(kind == "integer", text.try_cast("long")), "as_double": F.when(kind.isin("float", "integer"), text.try_cast("double")),
        "as_bool": F.when(kind == "boolean", F.lower(text).isin("true", "1", "yes")), "as_json": F.when(kind == "json", F.get_json_object(text, "$")), "as_text": F.when(kind == "string", text),
    }


def validated(kind: Column, text: Column, low: Column, high: Column, allowed: Column) -> Column:
    """ok, or what is wrong with a parameter: its type, below or above its bounds, not among the allowed ones."""
    n = text.try_cast("double")
    bad_type = (kind.isin("integer", "float") & n.isNull()) | ((kind == "integer") & text.try_cast("long").isNull())
    return F.when(text.isNull(), "missing").when(bad_type, "type").when(n < low, "below minimum").when(n > high, "above maximum").when(allowed.isNotNull() & ~F.array_contains(allowed, text), "not allowed").otherwise("ok")


def in_namespace(key: Column, namespace: str) -> tuple[Column, Column]:
    """Whether a dotted key belongs to a namespace, and the rest of the key."""
    return key.startswith(namespace + "."), F.substring(key, F.lit(len(namespace) + 2), F.length(key))


def versions(sets: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Parameter sets numbered v1.1, v1.2 in order of time, the newest active."""
    w = Window.partitionBy(*keys)
    n = F.row_number().over(w.orderBy(time))
    return sets.withColumn("version", F.concat(F.lit("v1."), n)).withColumn("is_active", n == F.count("*").over(w))


def snapshot(params: DataFrame, key: str, value: str) -> DataFrame:
    """One row: number of parameters and a hash of all, the same for the same content in any order."""
    return params.agg(F.count("*").alias("n"), F.bit_xor(F.conv(F.substring(F.md5(F.concat_ws("=", F.col(key).cast("string"), F.col(value).cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")).alias("content_hash"))


def feedback(current: DataFrame, overrides: DataFrame, key: str, value: str) -> DataFrame:
    """Control and treatment rows of an experiment: the value as it is, and as overridden."""
    t = current.join(overrides.select(key, F.col(value).alias("_o")), key, "left")
    arms = F.array(F.struct(F.lit("control").alias("arm"), F.col(value).alias("v")), F.struct(F.lit("treatment").alias("arm"), F.coalesce("_o", value).alias("v")))
    return t.select(key, F.explode(arms).alias("x")).select(key, "x.arm", F.col("x.v").alias(value))


def buckets(relations: DataFrame, keys: list[str], time: str) -> DataFrame:
    """A bucket per key with its events counted."""
    return relations.groupBy(*keys).agg(F.count("*").alias("event_count"), F.min(time).alias("first_seen"), F.max(time).alias("last_seen"))


def log_row(started: Column, ended: Column, found: Column, failed: Column) -> list[Column]:
    """Status, items and whole seconds of an extraction."""
    return [F.when(failed, "failed").when(found > 0, "success").otherwise("no_data").alias("status"), F.timestamp_diff("SECOND", started, ended).alias("duration_seconds")]


def yes_no(x: Column) -> Column:
    """Yes or No for the usual spellings; null for others."""
    t = F.lower(F.trim(x))
    return F.when(t.isin("yes", "y", "true", "1"), "Yes").when(t.isin("no", "n", "false", "0", ""), "No")


def read_delimited(spark: SparkSession, path: str, schema: str, sep: str = "\t", skip_bad: bool = True) -> DataFrame:
    """Delimited text with a header; malformed rows are skipped. Zipped files cannot be split: unzip them first."""
    return spark.read.schema(schema).option("sep", sep).option("header", True).option("quote", '"').option("mode", "DROPMALFORMED" if skip_bad else "FAILFAST").csv(path)


def read_aliased(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their canonical names, whatever alias (case and blanks aside) the header used; absent ones are null."""
    plain = lambda s: s.strip().lower().replace(" ", "").replace("_", "")
    there = {plain(c): c for c in df.columns}
    out = []
    for name, names in aliases.items():
        own = next((there[plain(n)] for n in [name, *names] if plain(n) in there), None)
        out.append((F.col(f"`{own}`") if own else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """All values quoted, quotes doubled."""
    df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"').csv(path)


def write_table(df: DataFrame, path: str, mode: str = "append", by: list[str] | None = None) -> None:
    w = df.write.mode(mode)
    (w.partitionBy(*by) if by else w).parquet(path)


def report_lines(metrics: DataFrame, title: str) -> DataFrame:
    """Markdown lines of a (name, value) frame."""
    return metrics.select(F.concat(F.lit(f"- {title}: **"), "name", F.lit("** "), F.col("value").cast("string")).alias("line"))


def failure_windows(events: DataFrame, time: str, failed: Column, span: str = "300 seconds", least: int = 3) -> DataFrame:
    """Windows in which enough failures fell to trip the breaker."""
    return events.where(failed).groupBy(F.window(time, span).alias("w")).agg(F.count("*").alias("failures")).select(F.col("w.start").alias("start"), "failures", (F.col("failures") >= least).alias("tripped"))


def compare_runs(a: DataFrame, b: DataFrame, name: str, value: str) -> DataFrame:
    """Change of each metric from run a to run b in percent; better or worse beyond 5."""
    rows = a.select(name, F.col(value).alias("before")).join(b.select(name, F.col(value).alias("after")), name, "full_outer")
    pct = F.try_divide((F.col("after") - F.col("before")) * 100.0, F.col("before"))
    return rows.withColumn("change_pct", pct).withColumn("verdict", F.when(F.col("change_pct") > 5, "better").when(F.col("change_pct") < -5, "worse").otherwise("same"))
