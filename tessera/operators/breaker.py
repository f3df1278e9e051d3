"""Failure breakers that restart their count a span after the last restart, and error counts of trailing spans."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _restarts(t: np.ndarray, span: int) -> np.ndarray:
    """For each of the ascending times the place of the first one more than ``span`` later; len(t) where there is none."""
    return np.searchsorted(t, t + span, side="right")


def _summary(pdf: pd.DataFrame, span: int, block: int) -> pd.DataFrame:
    """What a block of a key's failures does to a count that began before it, for every time it may have begun.

    A count that began at a goes on until the first failure later than a + span, which restarts it. ``until`` and ``last``, ``after``: counts
    that began before until[k] - span (and not before until[k - 1] - span) leave the block as last begun at last[k], with after[k] failures.
    """
    t = np.sort(pdf["us"].to_numpy())
    n, step = len(t), _restarts(t, span)
    leave = np.arange(n)
    for i in range(n - 1, -1, -1):  # the last restart of the chain that begins at i
        if step[i] < n:
            leave[i] = leave[step[i]]
    m = min(n, int(np.searchsorted(t, (int(pdf["block"].iloc[0])) * block + span, side="right")) + 1)  # no count from before restarts later
    ends = np.flatnonzero(np.append(leave[1:m] != leave[: m - 1], True))  # the last place of each run of equal leavings
    return pd.DataFrame({"key": [pdf["key"].iloc[0]], "block": [pdf["block"].iloc[0]], "n": [n], "until": [t[ends].tolist()], "last": [t[leave[ends]].tolist()], "after": [(n - leave[ends]).tolist()]})


def _carried(pdf: pd.DataFrame, span: int) -> pd.DataFrame:
    """When a key's count began last and what it is as each block is entered: one pass over the key's blocks."""
    pdf = pdf.sort_values("block")
    began, count, out = None, 0, []
    for key, block, n, until, last, after in pdf[["key", "block", "n", "until", "last", "after"]].itertuples(index=False):
        out.append((key, block, began, count))
        k = 0 if began is None else int(np.searchsorted(np.asarray(until), began + span, side="right"))
        began, count = (int(last[k]), int(after[k])) if k < len(until) else (began, count + n)
    frame = pd.DataFrame(out, columns=["key", "block", "began", "before"])
    return frame.astype({"began": "Int64"})


def _counted(pdf: pd.DataFrame, span: int) -> pd.DataFrame:
    """Every failure of a block with its count and the time the count began."""
    pdf = pdf.sort_values(["us", "id"])
    t, n = pdf["us"].to_numpy(), len(pdf)
    step = _restarts(t, span)
    began, before = pdf["began"].iloc[0], int(pdf["before"].iloc[0])
    first = 0 if pd.isna(began) else int(np.searchsorted(t, int(began) + span, side="right"))
    count, at = before + np.arange(1, n + 1), np.full(n, -1 if pd.isna(began) else int(began))
    while first < n:
        end = min(n, int(step[first]))
        count[first:end], at[first:end] = np.arange(1, end - first + 1), t[first]
        first = end
    return pd.DataFrame({"key": pdf["key"].to_numpy(), "id": pdf["id"].to_numpy(), "us": t, "failures": count, "began": at})


def breaker(events: DataFrame, failed: Column, key: Column, time: str, id_col: str, span_seconds: int = 300, least: int = 3, block_seconds: int = 86_400) -> DataFrame:
    """One row per failure: key, id, time, failures, count_began, tripped.

    Each key's failures are counted in order of time (ties by id). A failure later than ``span_seconds`` after the count began restarts it:
    the count is 1 and begins then. From ``least`` failures on the breaker is tripped, until a failure restarts the count. No calendar
    window is that, as a count begins with an event.

    A key may hold any share of the rows: its time is cut into blocks. Each block says in one row what it does to a count that
    comes from before, for all times it may have begun (such chains of restarts soon meet, so few are told apart); one short pass
    over a key's blocks carries counts through them; then each block counts its own failures. Rows without key or time are no
    failures of any key; a null condition is no failure. Ids order ties and are cast to long. An empty table gives no rows.
    """
    span, block = span_seconds * 1_000_000, max(block_seconds, span_seconds) * 1_000_000
    kind = dict(events.select(key.alias("key")).dtypes)["key"]
    us = F.unix_micros(F.col(time).cast("timestamp"))
    rows = events.where(F.coalesce(failed, F.lit(False))).select(key.alias("key"), F.col(id_col).cast("long").alias("id"), us.alias("us")).where("key is not null and us is not null")
    rows = rows.withColumn("block", F.floor(F.col("us") / F.lit(block)).cast("long"))
    parts = rows.groupBy("key", "block").applyInPandas(lambda p: _summary(p, span, block), f"key {kind}, block long, n long, until array<long>, last array<long>, after array<long>")
    carried = parts.groupBy("key").applyInPandas(lambda p: _carried(p, span), f"key {kind}, block long, began long, before long")
    out = rows.join(carried, ["key", "block"]).groupBy("key", "block").applyInPandas(lambda p: _counted(p, span), f"key {kind}, id long, us long, failures long, began long")
    return out.select("key", "id", F.timestamp_micros("us").alias("time"), "failures", F.timestamp_micros("began").alias("count_began"), (F.col("failures") >= least).alias("tripped"))


def breaker_stream(failures: DataFrame, key: str, time: str, id_col: str, span_seconds: int = 300, least: int = 3) -> DataFrame:
    """The same rows from a stream of failures; the state of a key is when its count began and the count. A micro-batch is taken in
    order of time; a failure that comes in a later batch than newer ones is counted when it comes."""
    kind, span = dict(failures.dtypes)[key], span_seconds * 1_000_000

    def fold(keys: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(batches)).sort_values(["us", "id"])
        began, count = state.get if state.exists else (None, 0)
        out = []
        for i, t in zip(pdf["id"], pdf["us"]):
            began, count = (int(t), 1) if began is None or t - began > span else (began, count + 1)
            out.append((keys[0], i, t, count, began))
        state.update((began, count))
        yield pd.DataFrame(out, columns=["key", "id", "us", "failures", "began"])

    rows = failures.select(F.col(key).alias("key"), F.col(id_col).cast("long").alias("id"), F.unix_micros(F.col(time).cast("timestamp")).alias("us")).where("key is not null and us is not null")
    out = rows.groupBy("key").applyInPandasWithState(fold, f"key {kind}, id long, us long, failures long, began long", "began long, count long", "append", "NoTimeout")
    return out.select("key", "id", F.timestamp_micros("us").alias("time"), "failures", F.timestamp_micros("began").alias("count_began"), (F.col("failures") >= least).alias("tripped"))


def recent_errors(events: DataFrame, failed: Column, key: str, time: str, as_of: Column, many: int = 5) -> DataFrame:
    """Per key: errors of the last hour and the last day before ``as_of``, events of that day, a rate, and whether more than ``many`` of the
    hour ask for attention. The rate is two points an error of the day, at most 100. Events after ``as_of`` do not count; an error a
    whole hour old is none of the hour. One aggregation; only rows of the day and keys are read into it."""
    t = F.col(time).cast("timestamp")
    since = lambda span: (t > as_of - F.expr(f"INTERVAL 1 {span}")) & (t <= as_of)
    bad = F.coalesce(failed, F.lit(False))
    g = events.groupBy(key).agg(F.count(F.when(since("HOUR") & bad, 1)).alias("errors_hour"), F.count(F.when(since("DAY") & bad, 1)).alias("errors_day"), F.count(F.when(since("DAY"), 1)).alias("events_day"))
    return g.select("*", F.least(F.col("errors_day") * 2, F.lit(100)).alias("rate"), (F.col("errors_hour") > many).alias("needs_attention"))


def trailing_errors(events: DataFrame, failed: Column, key: str, time: str, id_col: str) -> DataFrame:
    """Per failure: how many failures of its key fell into the hour and the day up to it, itself and ties included."""
    us = F.unix_micros(F.col(time).cast("timestamp"))
    rows = events.where(F.coalesce(failed, F.lit(False))).select(key, F.col(id_col), F.col(time).alias("time"), us.alias("_us"))
    w = Window.partitionBy(key).orderBy("_us")
    back = lambda seconds: F.count("*").over(w.rangeBetween(-seconds * 1_000_000 + 1, 0))
    return rows.select(key, id_col, "time", back(3600).alias("errors_hour"), back(86_400).alias("errors_day"))


def with_reloaded(stream: DataFrame, read: Callable[[], DataFrame], on: list[str], use: Callable[[DataFrame, int], None], checkpoint: str, key: str = "param_key", value: str = "value") -> list:
    """Joins each micro-batch to a snapshot of parameters that is read again when its content has changed.

    ``read`` gives the parameter table as it is now. Before each batch its content hash (one small row) is compared with that of the snapshot
    in use; only if it moved are the parameters read again, and the batch sees one snapshot throughout. ``use`` gets the joined rows
    and the number of the batch and must be idempotent. Returns (batch, content hash) of every snapshot that was taken.
    """
    from .state import snapshot

    held: dict = {"hash": None, "rows": None}
    taken: list = []

    def each(rows: DataFrame, k: int) -> None:
        now = read()
        n, content = snapshot(now, key, value).first()
        if (n, content) != held["hash"]:
            if held["rows"] is not None:
                held["rows"].unpersist()
            held["hash"], held["rows"] = (n, content), now.persist()
            taken.append((k, content))
        use(rows.join(held["rows"], on, "left"), k)

    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    if held["rows"] is not None:
        held["rows"].unpersist()
    return taken
