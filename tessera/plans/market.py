"""Price series bound to line items: a symbol is a supplier, a trade a line, the price its extended price."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import market as M

from .registry import query, table

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]
BY = ", ".join(ORDER)
BARS = f"""bars AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS day, first(l_extendedprice ORDER BY {BY}) AS open, max(l_extendedprice) AS high, min(l_extendedprice) AS low, last(l_extendedprice ORDER BY {BY}) AS close, sum(l_quantity)::BIGINT AS volume FROM lineitem GROUP BY 1, 2)"""
N = """n AS (SELECT *, row_number() OVER w AS rn, CAST(round(close * 100) AS BIGINT) AS c, CAST(round(high * 100) AS BIGINT) AS ch, CAST(round(low * 100) AS BIGINT) AS cl, lag(close) OVER w AS prev FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY day))"""
D = "::DOUBLE"


def roll(expr: str, n: int) -> str:
    return f"sum({expr}) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def sma(n: int, x: str = "c", scale: int = 100) -> str:
    return f"CASE WHEN rn >= {n} THEN {roll(x, n)}::DOUBLE / {scale * n}{D} END"


STD = f"CASE WHEN rn >= 20 THEN sqrt(({roll('c * c', 20)} * 20 - {roll('c', 20)} * {roll('c', 20)})::DOUBLE) / 2000{D} END"
#: The recurrences, row by row over row numbers.
REC = f"""g AS (SELECT *, greatest(ch - cl, abs(ch - CAST(round(prev * 100) AS BIGINT)), abs(cl - CAST(round(prev * 100) AS BIGINT))) AS tr, c - CAST(round(prev * 100) AS BIGINT) AS df FROM n),
 s AS (SELECT symbol, day, rn, close, tr, coalesce(greatest(df, 0), 0) AS up, coalesce(greatest(-df, 0), 0) AS dn, {roll('c', 12)}::DOUBLE AS s12, {roll('c', 26)}::DOUBLE AS s26, {roll('coalesce(greatest(df, 0), 0)', 14)}::DOUBLE AS su, {roll('coalesce(greatest(-df, 0), 0)', 14)}::DOUBLE AS sd, {roll('coalesce(tr, 0)', 14)}::DOUBLE AS st FROM g),
 rec AS (SELECT symbol, day, rn, NULL{D} AS e12, NULL{D} AS e26, NULL{D} AS fast, NULL{D} AS slow, NULL{D} AS gain, NULL{D} AS loss, NULL{D} AS atr, 0{D} AS total, NULL{D} AS sig FROM s WHERE rn = 1
 UNION ALL SELECT symbol, day, rn, e12, e26, fast, slow, gain, loss, atr, total2, CASE WHEN rn = 34 THEN total2 / 9{D} WHEN rn > 34 THEN sig + 0.2{D} * ((fast - slow) - sig) END FROM (SELECT *, CASE WHEN rn >= 26 THEN total + (fast - slow) ELSE 0{D} END AS total2 FROM (
 SELECT s.symbol, s.day, s.rn, CASE WHEN s.rn = 12 THEN s12 / 1200{D} WHEN s.rn > 12 THEN e12 + 2{D} / 13{D} * (close - e12) END AS e12, CASE WHEN s.rn = 26 THEN s26 / 2600{D} WHEN s.rn > 26 THEN e26 + 2{D} / 27{D} * (close - e26) END AS e26,
 CASE WHEN s.rn = 26 THEN s12 / 1200{D} WHEN s.rn > 26 THEN fast + 2{D} / 13{D} * (close - fast) END AS fast, CASE WHEN s.rn = 26 THEN s26 / 2600{D} WHEN s.rn > 26 THEN slow + 2{D} / 27{D} * (close - slow) END AS slow,
 CASE WHEN s.rn = 15 THEN su / 14{D} WHEN s.rn > 15 THEN (gain * 13{D} + up) / 14{D} END AS gain, CASE WHEN s.rn = 15 THEN sd / 14{D} WHEN s.rn > 15 THEN (loss * 13{D} + dn) / 14{D} END AS loss, CASE WHEN s.rn = 15 THEN st / 14{D} WHEN s.rn > 15 THEN (atr * 13{D} + tr) / 14{D} END AS atr,
 total, sig FROM rec r JOIN s ON s.symbol = r.symbol AND s.rn = r.rn + 1))),
 f AS (SELECT symbol, day, e12 AS ema_12, e26 AS ema_26, CASE WHEN gain + loss = 0 THEN 0{D} ELSE 100{D} * (gain / (gain + loss)) END AS rsi_14, CASE WHEN rn >= 34 THEN fast - slow END AS macd, sig AS macd_signal, CASE WHEN rn >= 34 THEN (fast - slow) - sig END AS macd_histogram, atr / 100{D} AS atr_14 FROM rec)"""
FOLDS = f"WITH RECURSIVE {BARS}, {N}, {REC}"
IND = FOLDS + f""", a AS (SELECT *, (high + low + close) / 3.0{D} AS pv, {sma(20)} AS sma_20, {sma(50)} AS sma_50, {sma(200)} AS sma_200, {STD} AS std, {sma(20, 'volume', 1)} AS volume_sma FROM n),
 i AS (SELECT a.*, pv * 2.0{D} - high AS s1, pv - (high - low) AS s2, sma_20 + std * 2.0{D} AS upper, sma_20 - std * 2.0{D} AS lower, std * 4.0{D} AS width, coalesce(volume::DOUBLE / nullif(volume_sma, 0), 0.0) AS volume_ratio, f.* EXCLUDE (symbol, day) FROM a JOIN f ON f.symbol = a.symbol AND f.day = a.day),
 b AS (SELECT *, lag(close, 6) OVER w AS close_6, lag(rsi_14, 6) OVER w AS rsi_6, lag(sma_50) OVER w AS p50, lag(sma_200) OVER w AS p200, list(atr_14) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS recent, count(*) OVER (PARTITION BY symbol) AS cnt FROM i WINDOW w AS (PARTITION BY symbol ORDER BY day)),
 last AS (SELECT *, len(list_filter(recent, lambda x: x < atr_14)) / 20.0{D} * 100.0{D} AS share, least(50.0{D} + CASE WHEN volume_ratio > 2.0 THEN 20 WHEN volume_ratio > 1.5 THEN 10 ELSE 0 END + CASE WHEN rsi_14 > 60 OR rsi_14 < 40 THEN 10 ELSE 0 END + CASE WHEN macd_histogram > 0 THEN 10 ELSE 0 END, 100.0) AS sure FROM b WHERE rn = cnt),
 pat AS (SELECT symbol, 'upper breakout' AS name, sure AS confidence, coalesce(abs(close * 1.05{D} - close) / nullif(abs(close - sma_20), 0), 0.0) AS risk_reward, true AS bullish, CASE WHEN rsi_14 > 60 THEN 'strong' ELSE 'moderate' END AS strength FROM last WHERE rn >= 5 AND close > upper AND volume_ratio > 1.5
 UNION ALL SELECT symbol, 'support breakdown', sure, coalesce(abs(s2 - close) / nullif(abs(close - pv), 0), 0.0), false, CASE WHEN rsi_14 < 40 THEN 'strong' ELSE 'moderate' END FROM last WHERE rn >= 5 AND close < s1 AND volume_ratio > 1.5
 UNION ALL SELECT symbol, 'squeeze', 70.0, 2.67, coalesce(rsi_14 > 50, false), CASE WHEN width / sma_20 * 100.0{D} < 3 THEN 'strong' ELSE 'moderate' END FROM last WHERE rn >= 10 AND width / sma_20 * 100.0{D} < 5
 UNION ALL SELECT symbol, 'bullish divergence', 65.0, 2.0, true, 'moderate' FROM last WHERE rn >= 14 AND close < close_6 AND rsi_14 > rsi_6 AND rsi_14 < 30
 UNION ALL SELECT symbol, 'bearish divergence', 65.0, 2.0, false, 'moderate' FROM last WHERE rn >= 14 AND close > close_6 AND rsi_14 < rsi_6 AND rsi_14 > 70),
 ev AS (SELECT symbol, 'volatility spike' AS event, share AS significance, atr_14 / close * 100.0{D} AS price_impact FROM last WHERE rn >= 20 AND share > 90 UNION ALL SELECT symbol, 'volume surge', least(volume_ratio * 20.0{D}, 100.0), 0.0 FROM last WHERE volume_ratio > 3.0
 UNION ALL SELECT symbol, 'golden cross', 85.0, 5.0 FROM last WHERE rn >= 10 AND sma_50 > sma_200 AND p50 <= p200 UNION ALL SELECT symbol, 'death cross', 85.0, -5.0 FROM last WHERE rn >= 10 AND sma_50 < sma_200 AND p50 >= p200)
"""
PLAIN = f"WITH {BARS}, {N} "


def bars_of(spark, d, dealt: bool = False) -> DataFrame:
    return M.bars(table(spark, d, "lineitem"), "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", ORDER, dealt)


@query("SRC-01 WIN-13", f"WITH {BARS} SELECT * FROM bars")
def bars(spark, d):
    return bars_of(spark, d)


@query("WIN-02", PLAIN + f"SELECT symbol, day, close, {sma(20)} AS sma_20, {sma(50)} AS sma_50, {sma(200)} AS sma_200 FROM n")
def moving_averages(spark, d):
    return M.averages(bars_of(spark, d))


@query("WIN-07", PLAIN + f", m AS (SELECT symbol, day, {sma(20)} AS middle, {STD} AS std FROM n) SELECT symbol, day, middle, middle + std * 2.0{D} AS upper, middle - std * 2.0{D} AS lower, std * 4.0{D} AS width FROM m")
def bollinger(spark, d):
    return M.bollinger(bars_of(spark, d))


@query("WIN-11", PLAIN + f"SELECT symbol, day, (sum((ch + cl + c) * volume) OVER w)::DOUBLE / nullif((sum(volume) OVER w)::DOUBLE * 300.0{D}, 0) AS vwap FROM n WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
def vwap(spark, d):
    return M.vwap(bars_of(spark, d))


@query("WIN-12", PLAIN + f", p AS (SELECT *, (high + low + close) / 3.0{D} AS pv FROM bars) SELECT symbol, day, pv AS \"pivot\", pv * 2.0{D} - low AS r1, pv + (high - low) AS r2, pv * 2.0{D} - high AS s1, pv - (high - low) AS s2 FROM p")
def pivots(spark, d):
    return M.pivots(bars_of(spark, d)).select("symbol", "day", "pivot", "r1", "r2", "s1", "s2")


@query("WIN-09", PLAIN + "SELECT symbol, day, (sum(CASE WHEN prev IS NULL OR close > prev THEN volume WHEN close < prev THEN -volume ELSE 0 END) OVER (PARTITION BY symbol ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS obv FROM n")
def obv(spark, d):
    return M.obv(bars_of(spark, d))


@query("WIN-06", PLAIN + f""", r AS (SELECT symbol, day, CASE WHEN rn >= 5 THEN coalesce((close - min(low) OVER v) * 100.0{D} / nullif(max(high) OVER v - min(low) OVER v, 0), 0.0) END AS raw FROM n WINDOW v AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)),
 k AS (SELECT symbol, day, (raw + lag(raw, 1) OVER w + lag(raw, 2) OVER w) / 3.0{D} AS k FROM r WINDOW w AS (PARTITION BY symbol ORDER BY day)) SELECT symbol, day, k, (k + lag(k, 1) OVER w + lag(k, 2) OVER w) / 3.0{D} AS d FROM k WINDOW w AS (PARTITION BY symbol ORDER BY day)""")
def stochastic(spark, d):
    return M.stochastic(bars_of(spark, d))


@query("WIN-10 WIN-19", PLAIN + f", v AS (SELECT *, {sma(20, 'volume', 1)} AS volume_sma FROM n) SELECT symbol, day, volume_sma, coalesce(volume::DOUBLE / nullif(volume_sma, 0), 0.0) AS volume_ratio FROM v")
def volume_ratio(spark, d):
    return M.volume_ratio(bars_of(spark, d))


@query("WIN-03 WIN-04 WIN-05 WIN-08", FOLDS + " SELECT * FROM f")
def ema_rsi_macd_atr(spark, d):
    return M.folds(bars_of(spark, d))


@query("WIN-14 WIN-15 WIN-16 WIN-17", IND + " SELECT * FROM pat")
def market_patterns(spark, d):
    return M.patterns(M.indicators(bars_of(spark, d)))


@query("WIN-18", IND + " SELECT symbol, day, rn::INT AS rn, close, atr_14, CASE WHEN rn >= 20 THEN len(list_filter(recent, lambda x: x < atr_14)) / 20.0::DOUBLE * 100.0::DOUBLE END AS atr_percentile FROM b")
def volatility_spike(spark, d):
    return M.volatility(M.indicators(bars_of(spark, d)))


@query("WIN-20", IND + " SELECT symbol, day, CASE WHEN sma_50 > sma_200 THEN 'golden' ELSE 'death' END AS \"cross\" FROM b WHERE (sma_50 > sma_200 AND p50 <= p200) OR (sma_50 < sma_200 AND p50 >= p200)")
def crosses(spark, d):
    return M.crosses(M.indicators(bars_of(spark, d)))


@query("WIN-18 WIN-19 WIN-20", IND + " SELECT * FROM ev")
def market_events(spark, d):
    return M.events(M.indicators(bars_of(spark, d)))


FLOW = """, ratio AS (SELECT l_suppkey AS symbol, CAST(sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS DOUBLE) / nullif(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END), 0) AS r FROM lineitem GROUP BY 1),
 flow AS (SELECT symbol, CASE WHEN r < 0.95 THEN 'bullish' WHEN r > 1.05 THEN 'bearish' ELSE 'neutral' END AS sentiment FROM ratio)"""


def option_flow(spark, d) -> DataFrame:
    side = lambda s: F.sum(F.when(F.col("l_linestatus") == s, F.col("l_quantity")).otherwise(0.0))
    r = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("symbol")).agg(F.try_divide(side("F"), side("O")).alias("r"))
    return r.select("symbol", F.when(F.col("r") < 0.95, "bullish").when(F.col("r") > 1.05, "bearish").otherwise("neutral").alias("sentiment"))


@query("WIN-21", IND + FLOW + f""", tech AS (SELECT symbol, (CASE WHEN rsi_14 < 30 THEN 20 ELSE 0 END + CASE WHEN macd_histogram > 0 THEN 15 ELSE 0 END + CASE WHEN close > sma_50 THEN 10 ELSE 0 END + CASE WHEN close > sma_200 THEN 10 ELSE 0 END + CASE WHEN close > upper THEN 10 ELSE 0 END){D} AS u,
 (CASE WHEN rsi_14 > 70 THEN 20 ELSE 0 END + CASE WHEN macd_histogram > 0 THEN 0 ELSE 15 END + CASE WHEN close > sma_50 THEN 0 ELSE 10 END + CASE WHEN close > sma_200 THEN 0 ELSE 10 END + CASE WHEN close < lower THEN 10 ELSE 0 END){D} AS dn FROM last),
 top AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY confidence DESC, name) AS r FROM pat), p AS (SELECT symbol, CAST(sum(CASE WHEN bullish THEN CAST(confidence AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS u, CAST(sum(CASE WHEN bullish THEN 0 ELSE CAST(confidence AS DECIMAL(18,4)) END) AS DOUBLE) AS dn FROM top WHERE r <= 3 GROUP BY 1),
 e AS (SELECT symbol, CAST(sum(CASE WHEN price_impact > 0 THEN CAST(round(significance, 4) AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS u, CAST(sum(CASE WHEN price_impact < 0 THEN CAST(round(significance, 4) AS DECIMAL(18,4)) ELSE 0 END) AS DOUBLE) AS dn FROM ev GROUP BY 1),
 sc AS (SELECT t.symbol, t.u / (t.u + t.dn) * 100.0{D} * 0.3{D} + coalesce(p.u / nullif(p.u + p.dn, 0) * 100.0{D}, 50.0) * 0.25{D} + coalesce(e.u / nullif(e.u + e.dn, 0) * 100.0{D}, 50.0) * 0.15{D} + (CASE sentiment WHEN 'bullish' THEN 70.0 WHEN 'bearish' THEN 30.0 ELSE 50.0 END){D} * 0.3{D} AS bull,
 t.dn / (t.u + t.dn) * 100.0{D} * 0.3{D} + coalesce(p.dn / nullif(p.u + p.dn, 0) * 100.0{D}, 50.0) * 0.25{D} + coalesce(e.dn / nullif(e.u + e.dn, 0) * 100.0{D}, 50.0) * 0.15{D} + (CASE sentiment WHEN 'bullish' THEN 30.0 WHEN 'bearish' THEN 70.0 ELSE 50.0 END){D} * 0.3{D} AS bear
 FROM tech t LEFT JOIN p ON p.symbol = t.symbol LEFT JOIN e ON e.symbol = t.symbol LEFT JOIN flow ON flow.symbol = t.symbol)
 SELECT symbol, round(bull, 4) AS bullish_score, round(bear, 4) AS bearish_score, round(abs(bull - bear), 4) AS confidence_score, CASE WHEN bull - bear > 40 THEN 'strong_buy' WHEN bull - bear > 20 THEN 'buy' WHEN bull - bear < -40 THEN 'strong_sell' WHEN bull - bear < -20 THEN 'sell' ELSE 'hold' END AS direction FROM sc""")
def composite_signal(spark, d):
    return M.composite(M.indicators(bars_of(spark, d, dealt=True), M.LOOK_BACK), option_flow(spark, d))


@query("MTH-06", PLAIN + f"SELECT symbol, day, (close - prev) * 100.0{D} / prev AS change_pct, (high + low + close) / 3.0{D} * volume AS money_flow FROM n")
def daily_return(spark, d):
    return M.daily_return(bars_of(spark, d))


CHAIN = """chain AS (SELECT p_partkey AS contract, p_retailprice AS s, p_retailprice * (0.8::DOUBLE + (p_partkey % 9) * 0.05::DOUBLE) AS k, 5 + p_partkey % 300 AS dte, (p_partkey % 13) * 0.05::DOUBLE AS sigma, CASE WHEN p_partkey % 2 = 0 THEN 'call' ELSE 'put' END AS kind, p_size * 10 AS volume, p_partkey % 150 AS open_interest,
 p_size::DOUBLE AS last, p_size - 1.0::DOUBLE AS bid, p_size + (p_partkey % 4) * 0.3::DOUBLE AS ask FROM part)"""


def chain(spark, d) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        k.alias("contract"), F.col("p_retailprice").alias("s"), (F.col("p_retailprice") * (0.8 + (k % 9) * 0.05)).alias("k"), (5 + k % 300).alias("dte"), ((k % 13) * 0.05).alias("sigma"), F.when(k % 2 == 0, "call").otherwise("put").alias("kind"),
        (F.col("p_size") * 10).alias("volume"), (k % 150).alias("open_interest"), F.col("p_size").cast("double").alias("last"), (F.col("p_size") - 1.0).alias("bid"), (F.col("p_size") + (k % 4) * 0.3).alias("ask"),
    )


def cdf(x: str) -> str:
    t = f"(1.0{D} / (1.0{D} + 0.2316419{D} * abs({x})))"
    up = f"(0.3989422804014327{D} * exp(-({x}) * ({x}) / 2.0{D}) * ({t} * (0.319381530{D} + {t} * (-0.356563782{D} + {t} * (1.781477937{D} + {t} * (-1.821255978{D} + {t} * 1.330274429{D}))))))"
    return f"CASE WHEN {x} >= 0 THEN 1.0{D} - {up} ELSE {up} END"


@query("MTH-01", f"""WITH {CHAIN}, t AS (SELECT *, greatest(dte / 365.0{D}, 0.001) AS t FROM chain), a AS (SELECT *, (ln(s / k) + (0.045{D} + 0.5{D} * sigma * sigma) * t) / nullif(sigma * sqrt(t), 0) AS d1 FROM t), b AS (SELECT *, d1 - sigma * sqrt(t) AS d2, exp(-d1 * d1 / 2.0{D}) * 0.3989422804014327{D} AS pdf FROM a),
 c AS (SELECT contract, kind, sigma > 0 AS ok, {cdf('d1')} AS n1, {cdf('d2')} AS n2, {cdf('(-d2)')} AS m2, pdf / (s * sigma * sqrt(t)) AS g, -s * pdf * sigma / (sqrt(t) * 2.0{D}) AS decay, k * 0.045{D} * exp(-0.045{D} * t) AS carry, s * pdf * sqrt(t) / 100.0{D} AS v FROM b)
 SELECT contract, CASE WHEN ok THEN round(CASE kind WHEN 'call' THEN n1 ELSE n1 - 1.0{D} END, 4) ELSE 0.0 END AS delta, CASE WHEN ok THEN round(g, 4) ELSE 0.0 END AS gamma, CASE WHEN ok THEN round(CASE kind WHEN 'call' THEN (decay - carry * n2) / 365.0{D} ELSE (decay + carry * m2) / 365.0{D} END, 4) ELSE 0.0 END AS theta, CASE WHEN ok THEN round(v, 4) ELSE 0.0 END AS vega FROM c""")
def greeks(spark, d):
    return M.greeks(chain(spark, d)).select("contract", "delta", "gamma", "theta", "vega")


@query("MTH-02", f"WITH {CHAIN} SELECT contract, s / k AS moneyness, CASE kind WHEN 'call' THEN s > k ELSE s < k END AS in_the_money, coalesce(volume::DOUBLE / nullif(open_interest, 0), 0.0) AS volume_oi_ratio, last * volume * 100.0{D} AS premium, coalesce(volume::DOUBLE / nullif(open_interest, 0), 0.0) > 2 AND volume > 100 AS unusual FROM chain")
def option_flags(spark, d):
    return M.option_flags(chain(spark, d)).select("contract", "moneyness", "in_the_money", "volume_oi_ratio", "premium", "unusual")


@query("MTH-03 FIL-09", f"WITH {CHAIN}, a AS (SELECT contract, last * volume * 100.0{D} AS premium, (last - bid) / nullif(ask - bid, 0) AS aggression FROM chain) SELECT * FROM a WHERE aggression > 0.7 ORDER BY premium DESC, contract LIMIT 20")
def smart_money(spark, d):
    return M.smart_money(M.option_flags(chain(spark, d))).select("contract", "premium", "aggression")


QUOTES = f"q AS (SELECT symbol, day, low AS bid, low * (1.0{D} + (volume % 40) / 1000.0{D}) AS ask, volume AS bid_size, volume * 3 % 500 AS ask_size, close AS price, open AS vwap, high, low FROM bars)"


def quotes(spark, d) -> DataFrame:
    v = F.col("volume")
    return bars_of(spark, d).select("symbol", "day", F.col("low").alias("bid"), (F.col("low") * (1.0 + (v % 40) / 1000.0)).alias("ask"), v.alias("bid_size"), (v * 3 % 500).alias("ask_size"), F.col("close").alias("price"), F.col("open").alias("vwap"), "high", "low")


@query("MTH-04", f"""WITH {BARS}, {QUOTES}, m AS (SELECT *, (bid + ask) / 2.0{D} AS midpoint FROM q) SELECT symbol, day, midpoint, (ask - bid) / midpoint * 100.0{D} AS relative_spread, (bid_size - ask_size)::DOUBLE / nullif(bid_size + ask_size, 0) AS depth_imbalance, (price - vwap) / vwap * 100.0{D} AS vwap_deviation, (price - low) / nullif(high - low, 0) AS range_position FROM m""")
def microstructure(spark, d):
    return M.microstructure(quotes(spark, d)).select("symbol", "day", "midpoint", "relative_spread", "depth_imbalance", "vwap_deviation", "range_position")


@query("MTH-05", f"""WITH {BARS}, {QUOTES}, p AS (SELECT *, (ask - bid) * 100.0{D} / bid AS p FROM q) SELECT symbol, day, p AS spread_pct, least((bid_size + ask_size) / 20.0{D}, 50.0) + CASE WHEN p < 0.1 THEN 50 WHEN p < 0.5 THEN 40 WHEN p < 1.0 THEN 30 WHEN p < 2.0 THEN 20 ELSE 10 END AS liquidity_score,
 CASE WHEN p < 0.1 THEN 'excellent' WHEN p < 0.25 THEN 'good' WHEN p < 0.5 THEN 'fair' WHEN p < 1.0 THEN 'wide' ELSE 'very_wide' END AS spread_quality FROM p""")
def liquidity(spark, d):
    return M.liquidity(quotes(spark, d)).select("symbol", "day", "spread_pct", "liquidity_score", "spread_quality")


@query("WIN-29", """WITH l AS (SELECT event_id, hour(ts - INTERVAL 5 HOUR) * 60 + minute(ts) AS m FROM events) SELECT event_id, CASE WHEN m < 240 OR m >= 1200 THEN 'closed' WHEN m < 570 THEN 'pre' WHEN m < 960 THEN 'regular' ELSE 'post' END AS session FROM l""")
def session_class(spark, d):
    return table(spark, d, "events").select("event_id", M.session_of("ts").alias("session"))


@query("WIN-30", """WITH g AS (SELECT n.n_nationkey AS k, max(o_orderdate) AS last FROM nation n LEFT JOIN customer c ON c.c_nationkey = n.n_nationkey AND n.n_nationkey % 5 > 0 LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1), r AS (SELECT k, CASE WHEN k % 7 = 0 THEN 'forced' WHEN last IS NULL THEN 'initial' WHEN k % 2 = 0 THEN 'open' WHEN epoch(TIMESTAMP '2001-08-02') - epoch(last) > 48 * 3600 THEN 'stale' ELSE 'closed' END AS reason FROM g) SELECT k, reason, reason <> 'closed' AS extract FROM r""")
def freshness_gate(spark, d):
    n, c = table(spark, d, "nation").select(F.col("n_nationkey").alias("k")), table(spark, d, "customer").where("c_nationkey % 5 > 0").select(F.col("c_nationkey").alias("k"), "c_custkey")
    rows = n.join(c, "k", "left").join(table(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left").groupBy("k").agg(F.max("o_orderdate").alias("last"))
    return M.freshness(rows, "last", F.lit("2001-08-02").cast("timestamp"), F.col("k") % 2 == 0, F.col("k") % 7 == 0).select("k", "reason", "extract")


@query("WIN-31 STM-03", """WITH h AS (SELECT user_id, max(ts) AS high FROM events WHERE ts < TIMESTAMP '2024-01-20' AND user_id % 10 > 0 GROUP BY 1) SELECT e.event_id FROM events e LEFT JOIN h ON h.user_id = e.user_id WHERE high IS NULL OR ts > high - INTERVAL 1 DAY""")
def high_watermark(spark, d):
    e = table(spark, d, "events")
    seen = e.where((F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz")) & (F.col("user_id") % 10 > 0))
    return M.since_watermark(e, seen, "user_id", "ts", "1 DAY").select("event_id")


@query("WIN-27", PLAIN + "SELECT symbol, day, CASE WHEN rn >= 3 THEN max(close) OVER w END AS high_3, CASE WHEN rn >= 3 THEN min(close) OVER w END AS low_3 FROM n WINDOW w AS (PARTITION BY symbol ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")
def rolling_extremes(spark, d):
    return M.rolling_extremes(bars_of(spark, d))
