"""Quality rules: base counts of each text and cross-document line frequency. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged

SPACE = r"[\x20\x09-\x0D]"


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once a row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE + "+"), "")


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def repeat_words(words: Column, n: int = 3) -> Column:
    """Words that lie in an n-word window found twice or more in the text, the first included.

    Windows are sorted by hash, so equal ones are neighbours; a long text costs n log n, no pairs.
    """

    def window(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(n)])

    def grams(w: Column) -> Column:
        return F.when(F.size(w) >= n, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.struct(window(w, i).alias("h"), i.alias("p")))))

    def repeated(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.array_compact(F.transform(s, lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["p"]))))

    def covered(p: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))
        step = lambda a, x: F.struct((a["n"] + x + n - F.greatest(x, a["upto"])).alias("n"), (x + n).alias("upto"))
        return F.aggregate(p, zero, step, lambda a: a["n"])

    return F.coalesce(let(words, lambda w: let(grams(w), lambda s: covered(repeated(s)))), F.lit(0)).cast("long")


def base_counts(text: Column) -> dict[str, Column]:
    t = F.coalesce(text.cast("string"), F.lit(""))
    words, lines = words_of(t), lines_of(t)
    both = let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words")))
    return {
        "_w": both,
        "word_chars": (F.length(t) - F.regexp_count(t, F.lit(SPACE))).cast("long"),
        "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    }


def _key(id_col: str, host_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(host_col).cast("string"), F.col(text_col).cast("string"))


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col).cast("string"), F.lit(""))


def normal(text: Column) -> Column:
    """Lower case, runs of white space within a line as one blank, digits as 0; lines stay lines."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " "), "[0-9]", "0")


def normal_lines(text: Column) -> Column:
    """(h, n) of the distinct normalised lines that hold a word: their hash and length."""
    lines = F.filter(F.transform(F.split(normal(F.coalesce(text.cast("string"), F.lit(""))), "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    return F.transform(F.array_distinct(lines), lambda x: F.struct(F.xxhash64(x).alias("h"), F.length(x).alias("n")))


def frequent_lines(docs: DataFrame, host_col: str = "source", text_col: str = "text", max_docs: int = 20) -> DataFrame:
    """(host, h) of the lines that more than ``max_docs`` distinct documents of a host have.

    Documents of a host with the same set of normalised lines are one document, so copies count once; any other two are
    distinct. Counting is by (host, line, document) first, so a line that a third of all rows holds is spread over all tasks and
    reaches its host's count as one row a task.
    """
    sets = docs.select(_host(host_col).alias("host"), normal_lines(F.col(text_col)).alias("r"))
    # what each line needs of its document is made before the explode, so no row carries the whole document; outer, as the planner
    # would else normalise each text a second time to ask whether it has lines
    lines = sets.select("host", F.xxhash64(F.array_sort(F.col("r.h"))).alias("set"), F.col("r.h").alias("hs")).select("host", "set", F.explode_outer("hs").alias("h")).where("h IS NOT NULL")
    return staged(lines.groupBy("host", "h").agg(F.countDistinct("set").alias("docs")).where(F.col("docs") > max_docs).select("host", "h"), "frequent-lines")


def _with_frequent(lines: DataFrame, frequent: DataFrame, broadcast_rows: int, parts: int = 16) -> DataFrame:
    """lines(host, h, k, ...) that are frequent: a broadcast join up to ``broadcast_rows`` frequent lines (24 bytes each), a join
    dealt by (host, h, part) beyond, so that no line's rows land in one task."""
    if frequent.count() <= broadcast_rows:
        return lines.join(F.broadcast(frequent), ["host", "h"])
    dealt = frequent.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return lines.withColumn("_part", F.pmod("k", F.lit(parts)).cast("int")).join(dealt, ["host", "h", "_part"]).drop("_part")


def removed(docs: DataFrame, frequent: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", broadcast_rows: int = 500_000) -> DataFrame:
    """(k, n_frequent, frequent_chars, all_chars) of the documents with a frequent line: its distinct normalised lines."""
    r = docs.select(_key(id_col, host_col, text_col).alias("k"), _host(host_col).alias("host"), normal_lines(F.col(text_col)).alias("r"))
    lines = r.select("k", "host", F.aggregate("r", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("all"), "r")
    lines = lines.select("k", "host", "all", F.explode_outer("r").alias("r")).where("r IS NOT NULL").select("k", "host", "all", "r.h", "r.n")
    # equal rows have one key; each of its lines counts once
    hits = _with_frequent(lines, frequent, broadcast_rows).groupBy("k", "h").agg(F.first("n").alias("n"), F.first("all").alias("all"))
    return hits.groupBy("k").agg(F.count("*").alias("n_frequent"), F.sum("n").alias("frequent_chars"), F.first("all").alias("all_chars"))


NEW = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "depleted", "kept"]


def quality(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", max_docs: int = 20, min_left: float = 0.25, broadcast_rows: int = 500_000, counts: bool = False) -> DataFrame:
    """The rows of docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, depleted and kept.

    Depleted: of its distinct normalised lines' characters, less than ``min_left`` is left without its host's frequent
    lines (see frequent_lines). With ``counts`` also n_frequent_lines, left_chars and line_chars. Null and empty text: no
    words, base_failed, not depleted. Null hosts are one host. Repeated rows are one document in the counts and get a
    row each. Columns of docs with those names give way; other columns stay. An empty table gives an empty table.
    What is known of documents with frequent lines is broadcast up to ``broadcast_rows`` of them, and joined by a shuffle
    beyond.
    """
    small_batches(docs.sparkSession)
    gone = removed(docs, frequent_lines(docs, host_col, text_col, max_docs), id_col, host_col, text_col, broadcast_rows)
    gone = gone.withColumn("_gone", F.col("all_chars") - F.col("frequent_chars") < min_left * F.col("all_chars"))
    extra = ["n_frequent_lines", "left_chars", "line_chars"] if counts else []
    gone = staged(gone if counts else gone.where("_gone").select("k", "_gone"), "depleted")
    gone = F.broadcast(gone) if gone.count() <= broadcast_rows else gone
    own = docs.drop(*NEW, *extra)
    base = own.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own.columns)], _key(id_col, host_col, text_col).alias("k"), *[c.alias(n) for n, c in base_counts(F.col(text_col)).items()])
    if counts:
        base = base.withColumn("line_chars", F.aggregate(normal_lines(F.col(f"c{own.columns.index(text_col)}")), F.lit(0).cast("long"), lambda a, x: a + x["n"]))
    failed = (F.col("_w.n_words") < 50) | (100 * F.col("_w.n_repeat_words") > 50 * F.col("_w.n_words"))
    out = base.join(gone, "k", "left").withColumn("base_failed", failed).withColumn("depleted", F.coalesce("_gone", F.lit(False))).withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
    if counts:
        out = out.withColumn("n_frequent_lines", F.coalesce("n_frequent", F.lit(0).cast("long"))).withColumn("left_chars", F.col("line_chars") - F.coalesce("frequent_chars", F.lit(0).cast("long")))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(own.columns)], "_w.n_words", "word_chars", "n_symbols", "n_dup_lines", "_w.n_repeat_words", "base_failed", "depleted", "kept", *extra)


def without_frequent_lines(docs: DataFrame, id_col: str = "doc_id", host_col: str = "source", text_col: str = "text", max_docs: int = 20, broadcast_rows: int = 500_000) -> DataFrame:
    """docs with the frequent lines of their host taken out of their texts, for callers that clean and do not only reject.

    Every place of a frequent line goes; lines without a word and the order of lines stay; null texts stay null. Texts without
    a frequent line pass as they are. Repeated rows are cleaned each.
    """
    frequent = frequent_lines(docs, host_col, text_col, max_docs)
    key = docs.withColumn("_k", _key(id_col, host_col, text_col)).withColumn("_host", _host(host_col))
    each = key.select(F.col("_k").alias("k"), F.col("_host").alias("host"), F.col(text_col).cast("string").alias("_t")).distinct()
    lines = each.select("k", "host", F.split("_t", "\n").alias("x")).select("k", "host", F.posexplode("x").alias("pos", "line")).withColumn("h", F.xxhash64(F.trim(normal(F.col("line")))))
    bad = _with_frequent(lines.where(F.trim(normal(F.col("line"))) != ""), frequent, broadcast_rows)
    touched = staged(bad.groupBy("k").agg(F.array_sort(F.collect_set("pos")).alias("bad")), "touched")  # places in one document
    rest = touched.join(each, "k").select("k", F.split("_t", "\n").alias("x")).select("k", F.posexplode("x").alias("pos", "line"))
    rest = rest.join(touched.select("k", F.explode("bad").alias("pos")), ["k", "pos"], "left_anti").groupBy("k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), "\n").alias("_clean"))
    cleaned = touched.select(F.col("k").alias("_k")).join(rest.withColumnRenamed("k", "_k"), "_k", "left").select("_k", F.coalesce("_clean", F.lit("")).alias("_clean"))
    return key.join(cleaned, "_k", "left").withColumn(text_col, F.coalesce("_clean", F.col(text_col).cast("string"))).select(*docs.columns)
