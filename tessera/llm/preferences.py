"""Chat formatting of preference pairs. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gather(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turns): every conversation's turns in order. Null roles are user, null texts empty; repeated rows stay."""
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("user")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return conversations.groupBy(F.col(conv_col).alias("conv")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def by_opening(convs: DataFrame) -> DataFrame:
    """(chosen, chosen_turns, rejected, rejected_turns) of conversations with the same first turn.

    Of each opening, the conversation with most turns, then most characters, then the smallest id is chosen, and every
    other one is rejected against it: a row for each, never all pairs. Where an opening has one conversation, its row
    has no rejected side. An opening that many conversations share meets one row, so Spark may split it.
    """
    size = F.aggregate("turns", F.lit(0), lambda a, x: a + F.length(x["text"]))
    rows = convs.select("conv", "turns", F.xxhash64(F.get("turns", F.lit(0))["role"], F.get("turns", F.lit(0))["text"]).alias("h"), F.struct((-F.size("turns")).alias("n"), (-size).alias("c"), F.col("conv").alias("conv")).alias("rank"))
    best = rows.groupBy("h").agg(F.min_by("turns", "rank").alias("chosen_turns"), F.min("rank")["conv"].alias("chosen"), F.count("*").alias("n"))
    both = rows.join(best, "h")
    other = ~F.col("conv").eqNullSafe(F.col("chosen"))
    return both.where(other | (F.col("n") == 1)).select("chosen", "chosen_turns", F.when(other, F.col("conv")).alias("rejected"), F.when(other, F.col("turns")).alias("rejected_turns"))


def rendered(turn: Column) -> Column:
    return F.concat(head(turn), turn["text"], F.lit("<|end|>\n"))


def head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def text_of(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def trained(turns: Column, at: Column) -> Column:
    """Spans (start, length in characters) of what is learned: assistant texts with their end mark; at: characters before."""
    span = "array<struct<start:int,length:int>>"
    zero = F.struct(at.cast("int").alias("at"), F.array().cast(span).alias("spans"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(head(x))
        own = F.array(F.struct(begin.alias("start"), (F.length(x["text"]) + 7).alias("length")))
        return F.struct((a["at"] + F.length(rendered(x))).cast("int").alias("at"), F.when(x["role"] == "assistant", F.concat(a["spans"], own)).otherwise(a["spans"]).cast(span).alias("spans"))

    return F.aggregate(turns, zero, step, lambda a: a["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """How many leading turns are equal in role and text."""
    n = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: (x["role"] == y["role"]) & (x["text"] == y["text"]))
    first = F.array_position(same, False)
    return F.when(first == 0, n).otherwise(first - 1).cast("int")


def last_answer(turns: Column) -> Column:
    """Turns before the last assistant turn; all turns if there is none."""
    back = F.array_position(F.transform(F.reverse(turns), lambda x: x["role"] == "assistant"), True)
    return F.when(back == 0, F.size(turns)).otherwise(F.size(turns) - back).cast("int")


def preference_rows(pairs: DataFrame) -> DataFrame:
    """Prompt once, completions of both sides, and the spans of each that are learned.

    The prompt is the longest common prefix of turns; without a rejected side, all before the last assistant turn.
    Spans count from the beginning of prompt + completion and lie in the completion alone; the rest is masked.
    Equal sides have empty completions.
    """
    alone = F.col("rejected_turns").isNull()
    n = F.when(alone, last_answer(F.col("chosen_turns"))).otherwise(common_turns(F.col("chosen_turns"), F.col("rejected_turns")))
    rows = pairs.withColumn("n", n).withColumn("prompt", text_of(F.slice("chosen_turns", F.lit(1), F.col("n"))))
    rest = lambda c: F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0)))
    side = lambda c: (text_of(rest(c)), trained(rest(c), F.length("prompt")))
    (a, a_spans), (b, b_spans) = side("chosen_turns"), side("rejected_turns")
    return rows.select("chosen", "rejected", F.col("n").cast("long").alias("prompt_turns"), "prompt", a.alias("chosen_text"), b.alias("rejected_text"), a_spans.alias("chosen_spans"), b_spans.alias("rejected_spans"))
