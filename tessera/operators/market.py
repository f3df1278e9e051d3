"""Indicators, patterns, events and signals of price series.

A series is one (symbol, interval); every row is emitted, null until its warm-up is over. Sums run over whole cents
(long), so averages and deviations are exact quotients whatever the order of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.numeric import normal_cdf, ratio
from tessera.sources.staging import cut


def bars(trades: DataFrame, symbol: str, time: str, price: str, volume: str, order: list[str], dealt: bool = False) -> DataFrame:
    """(symbol, day, open, high, low, close, volume) of trades; first and last by ``order``. ``dealt`` deals the trades by symbol, which is
    the only shuffle then, windows by symbol included: narrower than sums of days where a day has few trades."""
    if dealt:
        trades = trades.select(*dict.fromkeys([symbol, time, price, volume, *order])).repartition(symbol)
    by = F.struct(*order)
    return trades.groupBy(F.col(symbol).alias("symbol"), F.to_date(time).alias("day")).agg(
        F.min_by(price, by).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, by).alias("close"), F.sum(F.col(volume).cast("long")).alias("volume"),
    )


def cents(x) -> Column:
    return F.round((F.col(x) if isinstance(x, str) else x) * 100).cast("long")


def _w(n: int | None = None):
    w = Window.partitionBy("symbol").orderBy("day")
    return w if n is None else w.rowsBetween(1 - n, 0)


def numbered(b: DataFrame) -> DataFrame:
    """Row number, cents and the close before."""
    return b.withColumns({"rn": F.row_number().over(_w()), "c": cents("close"), "prev": F.lag("close").over(_w())})


def sma(n: int, x: str = "c", scale: float = 100.0) -> Column:
    return F.when(F.col("rn") >= n, F.sum(x).over(_w(n)) / (scale * n))


def rolling_std(n: int) -> Column:
    """Population deviation of the close over n rows from exact sums of cents and their squares."""
    s, q = F.sum("c").over(_w(n)), F.sum(F.col("c") * F.col("c")).over(_w(n))
    return F.when(F.col("rn") >= n, F.sqrt((q * n - s * s).cast("double")) / (100.0 * n))


def averages(b: DataFrame) -> DataFrame:
    return numbered(b).select("symbol", "day", "close", *[sma(n).alias(f"sma_{n}") for n in (20, 50, 200)])


def bollinger(b: DataFrame, n: int = 20, k: float = 2.0) -> DataFrame:
    rows = numbered(b).withColumns({"middle": sma(n), "std": rolling_std(n)})
    return rows.select("symbol", "day", "middle", (F.col("middle") + F.col("std") * k).alias("upper"), (F.col("middle") - F.col("std") * k).alias("lower"), (F.col("std") * (2 * k)).alias("width"))


def vwap(b: DataFrame) -> DataFrame:
    """Running mean of the typical price weighted by volume: one division of exact sums."""
    w = _w().rowsBetween(Window.unboundedPreceding, 0)
    top = F.sum((cents("high") + cents("low") + cents("close")) * F.col("volume")).over(w)
    return b.select("symbol", "day", F.try_divide(top.cast("double"), F.sum("volume").over(w).cast("double") * 300.0).alias("vwap"))


def pivots(b: DataFrame) -> DataFrame:
    p = (F.col("high") + F.col("low") + F.col("close")) / 3.0
    span = F.col("high") - F.col("low")
    return b.select("*", p.alias("pivot"), (p * 2.0 - F.col("low")).alias("r1"), (p + span).alias("r2"), (p * 2.0 - F.col("high")).alias("s1"), (p - span).alias("s2"))


def obv(b: DataFrame) -> DataFrame:
    """Volume added on rises and taken off on falls; the first row counts as it is."""
    rows = numbered(b)
    step = F.when(F.col("prev").isNull() | (F.col("close") > F.col("prev")), F.col("volume")).when(F.col("close") < F.col("prev"), -F.col("volume")).otherwise(0)
    return rows.withColumn("step", step).select("symbol", "day", F.sum("step").over(_w().rowsBetween(Window.unboundedPreceding, 0)).alias("obv"))


def stochastic(b: DataFrame, n: int = 5) -> DataFrame:
    """Slow K and D: three-row means of 100 (close - low) / (high - low) over n rows, 0 in a flat range."""
    low, high = F.min("low").over(_w(n)), F.max("high").over(_w(n))
    rows = numbered(b).withColumn("raw", F.when(F.col("rn") >= n, ratio((F.col("close") - low) * 100.0, high - low)))
    mean = lambda c: (F.col(c) + F.lag(c, 1).over(_w()) + F.lag(c, 2).over(_w())) / 3.0
    return rows.withColumn("k", mean("raw")).withColumn("d", mean("k")).select("symbol", "day", "k", "d")


def volume_ratio(b: DataFrame, n: int = 20) -> DataFrame:
    rows = numbered(b).withColumn("volume_sma", sma(n, "volume", 1.0))
    return rows.select("symbol", "day", "volume_sma", ratio("volume", "volume_sma").alias("volume_ratio"))


def folds(b: DataFrame, last: int | None = None) -> DataFrame:
    """Adds ema_12, ema_26, rsi_14, macd, macd_signal, macd_histogram and atr_14: recurrences in the order of days.

    Seeds are means of the first n values. The two lines of macd start together at row 26 (each from the mean of its
    last rows), its signal eight rows later; the three are null before. One numpy loop a symbol, behind the shuffle by
    symbol that the windows before it need anyway. With ``last`` only so many last rows of a symbol are given back.
    """
    tr = F.greatest(cents("high") - cents("low"), F.abs(cents("high") - cents("prev")), F.abs(cents("low") - cents("prev")))
    rows = numbered(b).withColumn("tr", tr)
    schema = "symbol long, day date, ema_12 double, ema_26 double, rsi_14 double, macd double, macd_signal double, macd_histogram double, atr_14 double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rn")
        x, c, tr = pdf["close"].to_numpy(), pdf["c"].to_numpy(), pdf["tr"].fillna(0).to_numpy(np.int64)
        n = len(x)
        up, down = np.maximum(np.diff(c, prepend=c[:1]), 0), np.maximum(-np.diff(c, prepend=c[:1]), 0)
        mean = lambda v, end, size, scale: float(v[end - size : end].sum()) / (scale * size)
        out = np.full((7, n), np.nan)
        e12 = e26 = fast = slow = signal = gain = loss = atr = total = 0.0
        for i in range(n):
            r = i + 1
            e12 = mean(c, 12, 12, 100.0) if r == 12 else e12 + 2.0 / 13 * (x[i] - e12)
            e26 = mean(c, 26, 26, 100.0) if r == 26 else e26 + 2.0 / 27 * (x[i] - e26)
            fast = mean(c, 26, 12, 100.0) if r == 26 else fast + 2.0 / 13 * (x[i] - fast)
            slow = mean(c, 26, 26, 100.0) if r == 26 else slow + 2.0 / 27 * (x[i] - slow)
            if r == 15:
                gain, loss, atr = mean(up, 15, 14, 1.0), mean(down, 15, 14, 1.0), mean(tr, 15, 14, 1.0)
            elif r > 15:
                gain, loss, atr = (gain * 13 + up[i]) / 14, (loss * 13 + down[i]) / 14, (atr * 13 + tr[i]) / 14
            if r >= 12:
                out[0, i] = e12
            if r >= 26:
                out[1, i] = e26
                line = fast - slow
                total = total + line
                signal = total / 9 if r == 34 else signal + 0.2 * (line - signal)
                if r >= 34:
                    out[3, i], out[4, i], out[5, i] = line, signal, line - signal
            if r >= 15:
                out[2, i] = 100.0 * (gain / (gain + loss)) if gain + loss else 0.0
                out[6, i] = atr / 100.0
        names = ["ema_12", "ema_26", "rsi_14", "macd", "macd_signal", "macd_histogram", "atr_14"]
        return pd.DataFrame({"symbol": pdf["symbol"], "day": pdf["day"], **{k: v for k, v in zip(names, out)}})[-(last or n) :]

    made = rows.select("symbol", "day", "rn", "close", "c", "tr").groupBy("symbol").applyInPandas(run, schema)
    return made.select("symbol", "day", *[F.nanvl(F.col(c), F.lit(None).cast("double")).alias(c) for c in made.columns[2:]])


def indicators(b: DataFrame, last: int | None = None) -> DataFrame:
    """Bars with every indicator, close and all: what patterns, events and signals read. With ``last`` only so many last rows of a
    symbol, made of all its rows, go on to be joined; LOOK_BACK are enough for ``last_rows``."""
    rows = numbered(pivots(b)).withColumns({"sma_20": sma(20), "sma_50": sma(50), "sma_200": sma(200), "std": rolling_std(20), "volume_sma": sma(20, "volume", 1.0)})
    rows = rows.withColumns({"upper": F.col("sma_20") + F.col("std") * 2.0, "lower": F.col("sma_20") - F.col("std") * 2.0, "width": F.col("std") * 4.0, "volume_ratio": ratio("volume", "volume_sma")})
    if last:
        rows = rows.withColumn("n", F.count("*").over(Window.partitionBy("symbol"))).where(F.col("rn") > F.col("n") - last).drop("n")
    return rows.join(folds(b, last), ["symbol", "day"])


def _back(x: str, n: int) -> Column:
    return F.lag(x, n).over(_w())


def latest(rows: DataFrame) -> DataFrame:
    """The last row of each symbol."""
    return rows.withColumn("n", F.max("rn").over(Window.partitionBy("symbol"))).where("rn = n").drop("n")


def risk_reward(entry: Column, target: Column, stop: Column) -> Column:
    return ratio(F.abs(target - entry), F.abs(entry - stop))


#: Rows of a symbol that its last row looks back to, itself included.
LOOK_BACK = 20


def last_rows(ind: DataFrame) -> DataFrame:
    """Each symbol's last row with what patterns and events look back to: all window functions in one pass."""
    back = {"close_6": _back("close", 6), "rsi_6": _back("rsi_14", 6), "p50": _back("sma_50", 1), "p200": _back("sma_200", 1), "recent": F.collect_list("atr_14").over(_w(20))}
    return latest(ind.withColumns(back))


def patterns(ind: DataFrame, surge: float = 1.5) -> DataFrame:
    """(symbol, name, confidence, risk_reward, bullish, strength) at each symbol's last row."""
    return patterns_at(last_rows(ind), surge)


def patterns_at(rows: DataFrame, surge: float = 1.5) -> DataFrame:
    """Patterns of last_rows."""
    rsi, close, vr = F.col("rsi_14"), F.col("close"), F.col("volume_ratio")
    sure = F.least(50.0 + F.when(vr > 2.0, 20.0).when(vr > 1.5, 10.0).otherwise(0.0) + F.when((rsi > 60) | (rsi < 40), 10.0).otherwise(0.0) + F.when(F.col("macd_histogram") > 0, 10.0).otherwise(0.0), F.lit(100.0))
    narrow = F.try_divide(F.col("width"), F.col("sma_20")) * 100.0

    def one(name, when, confidence, rr, bullish, strength):
        return F.when(when, F.struct(F.lit(name).alias("name"), confidence.alias("confidence"), rr.alias("risk_reward"), bullish.alias("bullish"), strength.alias("strength")))

    strong = lambda c: F.when(c, "strong").otherwise("moderate")
    yes, no = F.lit(True), F.lit(False)
    found = F.array(
        one("upper breakout", (F.col("rn") >= 5) & (close > F.col("upper")) & (vr > surge), sure, risk_reward(close, close * 1.05, F.col("sma_20")), yes, strong(rsi > 60)),
        one("support breakdown", (F.col("rn") >= 5) & (close < F.col("s1")) & (vr > surge), sure, risk_reward(close, F.col("s2"), F.col("pivot")), no, strong(rsi < 40)),
        one("squeeze", (F.col("rn") >= 10) & (narrow < 5), F.lit(70.0), F.lit(2.67), F.coalesce(rsi > 50, no), strong(narrow < 3)),
        one("bullish divergence", (F.col("rn") >= 14) & (close < F.col("close_6")) & (rsi > F.col("rsi_6")) & (rsi < 30), F.lit(65.0), F.lit(2.0), yes, F.lit("moderate")),
        one("bearish divergence", (F.col("rn") >= 14) & (close > F.col("close_6")) & (rsi < F.col("rsi_6")) & (rsi > 70), F.lit(65.0), F.lit(2.0), no, F.lit("moderate")),
    )
    return rows.select("symbol", F.explode(F.array_compact(found)).alias("p")).select("symbol", "p.*")


def volatility(ind: DataFrame, n: int = 20) -> DataFrame:
    """Percent of the last n ATR values strictly below the present one, at every row from the n-th on."""
    recent = F.collect_list("atr_14").over(_w(n))
    below = F.size(F.filter(recent, lambda x: x < F.col("atr_14")))
    return ind.select("symbol", "day", "rn", "close", "atr_14", F.when(F.col("rn") >= n, below / float(n) * 100.0).alias("atr_percentile"))


def crosses(ind: DataFrame) -> DataFrame:
    """Golden and death crosses at every row: the 50-row mean passing the 200-row mean."""
    a, b, pa, pb = F.col("sma_50"), F.col("sma_200"), _back("sma_50", 1), _back("sma_200", 1)
    kind = F.when((a > b) & (pa <= pb), "golden").when((a < b) & (pa >= pb), "death")
    return ind.select("symbol", "day", kind.alias("cross")).where("cross IS NOT NULL")


def events(ind: DataFrame) -> DataFrame:
    """(symbol, event, significance, price_impact) at each symbol's last row."""
    return events_at(last_rows(ind))


def events_at(rows: DataFrame) -> DataFrame:
    """Events of last_rows."""
    share = F.size(F.filter("recent", lambda x: x < F.col("atr_14"))) / 20.0 * 100.0

    def one(name, when, size, impact):
        return F.when(when, F.struct(F.lit(name).alias("event"), size.alias("significance"), impact.alias("price_impact")))

    a, b = F.col("sma_50"), F.col("sma_200")
    found = F.array(
        one("volatility spike", (F.col("rn") >= 20) & (share > 90), share, F.try_divide(F.col("atr_14"), F.col("close")) * 100.0),
        one("volume surge", F.col("volume_ratio") > 3.0, F.least(F.col("volume_ratio") * 20.0, F.lit(100.0)), F.lit(0.0)),
        one("golden cross", (F.col("rn") >= 10) & (a > b) & (F.col("p50") <= F.col("p200")), F.lit(85.0), F.lit(5.0)),
        one("death cross", (F.col("rn") >= 10) & (a < b) & (F.col("p50") >= F.col("p200")), F.lit(85.0), F.lit(-5.0)),
    )
    return rows.select("symbol", F.explode(F.array_compact(found)).alias("e")).select("symbol", "e.*")


#: What each source of a signal weighs.
SIGNAL_WEIGHTS = {"technical": 0.3, "pattern": 0.25, "event": 0.15, "options": 0.3}


def _split(up: Column, down: Column) -> tuple[Column, Column]:
    """Both as percents of their sum, 50 each where it is 0 or null."""
    total = F.coalesce(up + down, F.lit(0.0))
    return tuple(F.when(total == 0, 50.0).otherwise(x / F.nullif(total, F.lit(0.0)) * 100.0) for x in (up, down))


def composite(ind: DataFrame, flow: DataFrame) -> DataFrame:
    """Bullish and bearish score of each symbol from indicators, the three surest patterns, events and option flow
    (symbol, sentiment), with the direction their difference gives. Sources without rows count 50 each. The last rows, one a
    symbol, are made once and kept for all four."""
    now = cut(last_rows(ind))
    pts = lambda c, p: F.when(c, p).otherwise(0.0)
    rsi, close = F.col("rsi_14"), F.col("close")
    macd, over50, over200 = F.coalesce(F.col("macd_histogram") > 0, F.lit(False)), F.coalesce(close > F.col("sma_50"), F.lit(False)), F.coalesce(close > F.col("sma_200"), F.lit(False))
    up = pts(rsi < 30, 20.0) + pts(macd, 15.0) + pts(over50, 10.0) + pts(over200, 10.0) + pts(close > F.col("upper"), 10.0)
    down = pts(rsi > 70, 20.0) + pts(~macd, 15.0) + pts(~over50, 10.0) + pts(~over200, 10.0) + pts(close < F.col("lower"), 10.0)
    t_up, t_down = _split(up, down)
    tech = now.select("symbol", t_up.alias("technical_up"), t_down.alias("technical_down"))

    first = Window.partitionBy("symbol").orderBy(F.desc("confidence"), "name")
    p = patterns_at(now).withColumn("r", F.row_number().over(first)).where("r <= 3")
    cf = F.col("confidence").cast("decimal(18,4)")
    p = p.groupBy("symbol").agg(F.sum(F.when(F.col("bullish"), cf).otherwise(0)).cast("double").alias("u"), F.sum(F.when(F.col("bullish"), F.lit(0)).otherwise(cf)).cast("double").alias("d"))
    ev = events_at(now)
    sg = F.round("significance", 4).cast("decimal(18,4)")
    ev = ev.groupBy("symbol").agg(F.sum(F.when(F.col("price_impact") > 0, sg).otherwise(0)).cast("double").alias("eu"), F.sum(F.when(F.col("price_impact") < 0, sg).otherwise(0)).cast("double").alias("ed"))
    rows = tech.join(p, "symbol", "left").join(ev, "symbol", "left").join(flow, "symbol", "left")
    (pu, pd_), (eu, ed) = _split(F.col("u"), F.col("d")), _split(F.col("eu"), F.col("ed"))
    ou = F.when(F.col("sentiment") == "bullish", 70.0).when(F.col("sentiment") == "bearish", 30.0).otherwise(50.0)
    w = SIGNAL_WEIGHTS
    bull = F.col("technical_up") * w["technical"] + pu * w["pattern"] + eu * w["event"] + ou * w["options"]
    bear = F.col("technical_down") * w["technical"] + pd_ * w["pattern"] + ed * w["event"] + (100.0 - ou) * w["options"]
    rows = rows.select("symbol", bull.alias("bullish_score"), bear.alias("bearish_score"))
    diff = F.col("bullish_score") - F.col("bearish_score")
    way = F.when(diff > 40, "strong_buy").when(diff > 20, "buy").when(diff < -40, "strong_sell").when(diff < -20, "sell").otherwise("hold")
    return rows.select("symbol", F.round("bullish_score", 4).alias("bullish_score"), F.round("bearish_score", 4).alias("bearish_score"), F.round(F.abs(diff), 4).alias("confidence_score"), way.alias("direction"))


def greeks(rows: DataFrame, rate: float = 0.045) -> DataFrame:
    """Black-Scholes delta, gamma, theta and vega of (s, k, dte, sigma, kind), 4 digits; all 0 without deviation or time."""
    t = F.greatest(F.col("dte") / 365.0, F.lit(0.001))
    s, k, v = F.col("s"), F.col("k"), F.nullif(F.col("sigma"), F.lit(0.0))
    d1 = (F.log(s / k) + (rate + 0.5 * v * v) * t) / (v * F.sqrt(t))
    d2 = d1 - v * F.sqrt(t)
    density = F.exp(-d1 * d1 / 2.0) * 0.3989422804014327
    decay = -s * density * v / (F.sqrt(t) * 2.0)
    carry = k * rate * F.exp(-rate * t)
    call = F.col("kind") == "call"
    out = {
        "delta": F.when(call, normal_cdf(d1)).otherwise(normal_cdf(d1) - 1.0), "gamma": density / (s * v * F.sqrt(t)),
        "theta": F.when(call, (decay - carry * normal_cdf(d2)) / 365.0).otherwise((decay + carry * normal_cdf(-d2)) / 365.0), "vega": s * density * F.sqrt(t) / 100.0,
    }
    good = (F.col("sigma") > 0) & (F.col("dte") >= 0) & (s > 0) & (k > 0)
    return rows.withColumns({n: F.when(good, F.round(c, 4)).otherwise(0.0) for n, c in out.items()})


def option_flags(rows: DataFrame, unusual: float = 2.0, least_volume: int = 100) -> DataFrame:
    """Moneyness, volume to open interest, premium and the unusual flag of (s, k, kind, volume, open_interest, last)."""
    v, oi = F.coalesce("volume", F.lit(0)), F.coalesce("open_interest", F.lit(0))
    r = ratio(v, oi)
    itm = F.when(F.col("kind") == "call", F.col("s") > F.col("k")).otherwise(F.col("s") < F.col("k"))
    return rows.withColumns({"moneyness": ratio("s", "k"), "in_the_money": itm, "volume_oi_ratio": r, "premium": F.col("last") * v * 100.0, "unusual": (r > unusual) & (v > least_volume)})


def smart_money(rows: DataFrame, least: float = 0.7, k: int = 20) -> DataFrame:
    """Trades near the asking side, largest premium first; rows has last, bid, ask, premium."""
    aggression = F.try_divide(F.col("last") - F.col("bid"), F.col("ask") - F.col("bid"))
    return rows.withColumn("aggression", aggression).where(F.col("aggression") > least).orderBy(F.desc("premium"), "contract").limit(k)


def microstructure(q: DataFrame) -> DataFrame:
    """Midpoint, spread relative to it in percent, depth imbalance, deviation from vwap and place in the day's range."""
    mid = (F.col("bid") + F.col("ask")) / 2.0
    pct = lambda a, b: F.try_divide(a, b) * 100.0
    sizes = F.col("bid_size") + F.col("ask_size")
    return q.withColumns({
        "midpoint": mid, "relative_spread": pct(F.col("ask") - F.col("bid"), F.when(mid > 0, mid)), "depth_imbalance": F.try_divide((F.col("bid_size") - F.col("ask_size")).cast("double"), F.when(sizes > 0, sizes).cast("double")),
        "vwap_deviation": pct(F.col("price") - F.col("vwap"), F.nullif(F.col("vwap"), F.lit(0.0))), "range_position": F.try_divide(F.col("price") - F.col("low"), F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low"))),
    })


def liquidity(q: DataFrame) -> DataFrame:
    """Score of sizes (50 at 1000) and spread (50 to 10), and a name for the spread; the spread is in percent of the bid."""
    p = ratio((F.col("ask") - F.col("bid")) * 100.0, "bid")
    by = F.when(p < 0.1, 50.0).when(p < 0.5, 40.0).when(p < 1.0, 30.0).when(p < 2.0, 20.0).otherwise(10.0)
    name = F.when(p < 0.1, "excellent").when(p < 0.25, "good").when(p < 0.5, "fair").when(p < 1.0, "wide").otherwise("very_wide")
    return q.withColumns({"spread_pct": p, "liquidity_score": F.least((F.col("bid_size") + F.col("ask_size")) / 20.0, F.lit(50.0)) + by, "spread_quality": name})


def session_of(ts, zone: str = "America/New_York") -> Column:
    """closed, pre, regular or post by minutes of the local day; ts is UTC."""
    local = F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone)
    m = F.hour(local) * 60 + F.minute(local)
    return F.when((m < 240) | (m >= 1200), "closed").when(m < 570, "pre").when(m < 960, "regular").otherwise("post")


def freshness(rows: DataFrame, last: str, as_of: Column, open_now: Column, force: Column, stale_hours: float = 48.0) -> DataFrame:
    """Whether to extract, and why: forced, never before, open market, or stale although closed."""
    hours = (as_of.cast("double") - F.col(last).cast("timestamp").cast("double")) / 3600.0
    why = F.when(force, "forced").when(F.col(last).isNull(), "initial").when(open_now, "open").when(hours > stale_hours, "stale").otherwise("closed")
    return rows.withColumn("reason", why).withColumn("extract", F.col("reason") != "closed")


def since_watermark(rows: DataFrame, seen: DataFrame, key: str, time: str, overlap: str) -> DataFrame:
    """Rows newer than each key's greatest stored time less an overlap; keys without one come whole."""
    high = seen.groupBy(key).agg(F.max(time).alias("_high"))
    return rows.join(high, key, "left").where(F.col("_high").isNull() | (F.col(time) > F.col("_high") - F.expr(f"INTERVAL {overlap}"))).drop("_high")


def rolling_extremes(b: DataFrame, n: int = 3) -> DataFrame:
    """Greatest and least close of the last n rows, null before the n-th."""
    w = _w(n)
    return numbered(b).select("symbol", "day", F.when(F.col("rn") >= n, F.max("close").over(w)).alias("high_3"), F.when(F.col("rn") >= n, F.min("close").over(w)).alias("low_3"))


def daily_return(b: DataFrame) -> DataFrame:
    return numbered(b).select("symbol", "day", F.try_divide((F.col("close") - F.col("prev")) * 100.0, F.col("prev")).alias("change_pct"), ((F.col("high") + F.col("low") + F.col("close")) / 3.0 * F.col("volume")).alias("money_flow"))


__all__ = ["SIGNAL_WEIGHTS", "averages", "bars", "bollinger", "composite", "crosses", "daily_return", "events", "folds", "freshness", "greeks", "indicators", "last_rows", "liquidity", "microstructure", "obv", "option_flags", "patterns", "pivots", "risk_reward", "rolling_extremes", "session_of", "since_watermark", "smart_money", "stochastic", "volatility", "volume_ratio", "vwap"]
