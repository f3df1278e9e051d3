"""Worked examples, nulls, zeros and ties that the generated tables do not hold."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions.numeric import cosine, normal_cdf
from tessera.functions.text import clean_post, company_name, fill_template, money
from tessera.operators import campaign, entity, filings, graph, market, network, relational, social, state

UTC = dt.timezone.utc


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_engagement(spark):
    rows = [(1, 500, 200, 50, 30, None, 10000, dt.datetime(2025, 1, 15, 10, 30), False, False, True, "tweet"), (2, 50, 10, 5, 2, None, 10000, dt.datetime(2025, 1, 15, 14), True, False, False, "tweet"), (3, 100, 20, 30, 5, None, 10000, dt.datetime(2025, 1, 15, 18), False, False, False, "reply"), (4, None, None, None, None, 0, None, None, None, None, None, None)]
    names = "tweet_id long, like_count long, retweet_count long, reply_count long, quote_count long, impressions long, followers long, created_at timestamp, has_media boolean, has_url boolean, has_hashtag boolean, tweet_type string"
    p = spark.createDataFrame(rows, names)
    rate = {r["tweet_id"]: r["rate"] for r in social.engagement_rate(p).collect()}
    assert rate[1] == 100 and rate[2] == pytest.approx(9.3) and rate[3] == pytest.approx(25.0) and rate[4] == 0
    real = p.where("tweet_id < 4")
    assert social.baseline(real).first()["mean_engagement"] == 334
    assert social.viral(real, F.lit("2025-01-16").cast("timestamp")).count() == 0
    assert social.timing(p, {"hour": F.hour("created_at")}, 5).first()["hour"] == 10
    types = {r["content_type"]: r["average_engagement"] for r in social.content_types(real).collect()}
    assert types == {"text_only": 467.5, "with_media": 67, "with_hashtags": 780, "replies": 155}
    assert social.best_of(social.content_types(real), "content_type", "average_engagement").first()["best"] == "with_hashtags"


def test_influence_bounds(spark):
    u = spark.createDataFrame([(1, 10**9, 0, 10**6, True, "b", "l", "w", dt.datetime(2020, 1, 1), 99.0), (2, None, None, None, None, None, None, None, None, None)], "user_id long, followers_count long, following_count long, tweets_count long, verified boolean, bio string, location string, website string, created_at timestamp, engagement_rate double")
    got = {r["user_id"]: r["influence_score"] for r in social.influence(u, F.lit("2021-01-01").cast("timestamp")).collect()}
    assert got == {1: 100.0, 2: 0.0}


def test_names(spark):
    for raw, want in (("Exact Sciences Corporation", "exact sciences"), ("Freenome Holdings, Inc.", "freenome"), ("GRAIL, Inc.", "grail"), (None, None), ("", "")):
        assert one(spark, company_name(F.lit(raw).cast("string")).alias("x"))["x"] == want
    assert one(spark, money(F.lit("$1,234.5 million")).alias("x"))["x"] == 1234.5e6
    assert one(spark, money(F.lit("none")).alias("x"))["x"] is None
    assert one(spark, clean_post(F.lit("@a b  $XY #t http://q.z/1")).alias("x"))["x"] == "@user b TICKER_XY # t http"
    assert one(spark, fill_template(F.lit("{A} {a}{B}"), {"A": F.lit("x$1"), "b": F.lit(None)}).alias("x"))["x"] == "x$1 x$1"


def test_greeks(spark):
    df = spark.createDataFrame([(100.0, 100.0, 30, 0.5, "call"), (100.0, 100.0, 30, 0.5, "put"), (100.0, 100.0, 30, 0.0, "call"), (100.0, None, 30, 0.5, "call")], "s double, k double, dte int, sigma double, kind string")
    a, b, c, e = market.greeks(df).collect()
    assert (a["delta"], a["gamma"], a["theta"], a["vega"]) == (0.5388, 0.0277, -0.1008, 0.1138)
    assert (b["delta"], b["theta"]) == (-0.4612, -0.0885)
    assert c["delta"] == c["vega"] == e["delta"] == 0
    for x in (-3.0, -0.2, 0.0, 1.0, 2.5):
        assert one(spark, normal_cdf(F.lit(x)).alias("v"))["v"] == pytest.approx(0.5 * math.erfc(-x / math.sqrt(2)), abs=8e-8)


def bar_rows(n, seed=1):
    rng = np.random.default_rng(seed)
    close = np.round(100 + np.cumsum(rng.normal(size=n)), 2)
    return [(1, dt.date(2020, 1, 1) + dt.timedelta(days=k), float(c), float(round(c + 1, 2)), float(round(c - 1.5, 2)), float(c), int(rng.integers(0, 100))) for k, c in enumerate(close)]


@pytest.mark.parametrize("n", [1, 13, 14, 15, 19, 20, 26, 34, 199, 200, 201])
def test_indicator_warm_up(spark, n):
    rows = bar_rows(n)
    b = spark.createDataFrame(rows, "symbol long, day date, open double, high double, low double, close double, volume long")
    ind = {r["day"]: r for r in market.indicators(b).collect()}
    assert len(ind) == n
    for k, r in enumerate(rows, 1):
        got = ind[r[1]]
        for name, need in (("sma_20", 20), ("sma_50", 50), ("sma_200", 200), ("ema_12", 12), ("ema_26", 26), ("rsi_14", 15), ("atr_14", 15), ("macd", 34), ("upper", 20)):
            assert (got[name] is not None) == (k >= need), (name, k)
    closes = [r[5] for r in rows]
    if n >= 20:
        last = ind[rows[-1][1]]
        assert last["sma_20"] == pytest.approx(np.mean(closes[-20:])) and last["std"] == pytest.approx(np.std(closes[-20:]))
    if n > 15:
        up, down = np.maximum(np.diff(closes), 0), np.maximum(-np.diff(closes), 0)
        g, lo = up[:14].mean(), down[:14].mean()
        for x, y in zip(up[14:], down[14:]):
            g, lo = (g * 13 + x) / 14, (lo * 13 + y) / 14
        assert ind[rows[-1][1]]["rsi_14"] == pytest.approx(100 * g / (g + lo))


def test_market_edges(spark):
    q = spark.createDataFrame([(0.0, 0.0, 0, 0, 1.0, 0.0, 1.0, 1.0)], "bid double, ask double, bid_size long, ask_size long, price double, vwap double, high double, low double")
    r = market.microstructure(q).first()
    assert r["relative_spread"] is None and r["depth_imbalance"] is None and r["range_position"] is None and r["vwap_deviation"] is None
    assert market.liquidity(q).first()["spread_quality"] == "excellent"
    days = spark.createDataFrame([("2024-03-10 13:29:00",), ("2024-03-08 14:30:00",), ("2024-07-01 13:30:00",), ("2024-07-01 03:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("ts"), "t")
    assert [r["s"] for r in days.select(market.session_of("ts").alias("s")).collect()] == ["pre", "regular", "regular", "closed"]


def test_periods(spark):
    d = F.lit("2024-02-10").cast("date")
    r = one(spark, relational.period_of(d).alias("a"), relational.previous_period(d).alias("b"), *[c.alias(n) for n, c in zip("cd", relational.period_bounds(F.lit("Q4-2023")))])
    assert (r["a"], r["b"], r["c"], r["d"]) == ("Q1-2024", "Q4-2023", dt.date(2023, 10, 1), dt.date(2023, 12, 31))


def test_graph_demo(spark):
    m = lambda s, t, k: (s, t, k)
    base = [m("ceo", "fda", "mention"), m("ceo", "inv1", "mention"), m("ceo", "ana", "mention"), m("inv1", "ceo", "retweet"), m("inv1", "ceo", "mention"), m("ana", "ceo", "mention"), m("ana", "inv1", "mention"), m("fda", "ceo", "reply"), m("inv2", "ana", "retweet"), m("x", "x", "mention")]
    e = graph.build_edges(spark.createDataFrame(base * 3, "src string, dst string, kind string"), 2)
    assert {(r["src"], r["dst"]): r["weight"] for r in e.collect()}[("inv1", "ceo")] == 9 and e.count() == 8
    s = graph.stats(e).first()
    assert (s["nodes"], s["edges"], s["components"], s["density"], s["average_degree"]) == (5, 8, 1, 0.4, 3.2)
    ranks = {r["node"]: r["pagerank"] for r in graph.pagerank(e, tolerance=1e-12).collect()}
    names = sorted(ranks)
    w = {(r["src"], r["dst"]): r["weight"] for r in e.collect()}
    x = dict.fromkeys(names, 1 / 5)
    for _ in range(60):
        out = {v: sum(k for (a, _), k in w.items() if a == v) for v in names}
        lost = sum(x[v] for v in names if not out[v])
        x = {v: 0.15 / 5 + 0.85 * (sum(x[a] * k / out[a] for (a, b), k in w.items() if b == v) + lost / 5) for v in names}
    assert ranks == pytest.approx(x) and sum(ranks.values()) == pytest.approx(1)
    ends = {r["node"]: r["bridge_ends"] for r in network.cut_nodes(e).collect()}
    assert ends["fda"] == 1 and ends["inv2"] == 1
    assert {r["node"]: r["betweenness"] for r in network.path_centrality(e).collect()}["ceo"] > 0


def test_reach_and_components(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (4, 5), (9, 8)], "src long, dst long").withColumn("weight", F.lit(1))
    assert {r["node"]: r["level"] for r in graph.reach(e, 1).collect()} == {1: 0, 2: 1, 3: 2, 4: 3}
    assert graph.reach(e, 77).count() == 0
    assert {r["node"]: r["component"] for r in graph.components(e).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 9: 8, 8: 8}


def test_chunks(spark):
    texts = [(1, "One two. Three four! " * 300), (2, "x" * 5000), (3, ""), (4, None), (5, "Ab. Cd" * 3), (6, "y" * 2000)]
    df = spark.createDataFrame(texts, "k long, t string")
    by = {}
    for r in filings.sentence_chunks(df, "k", "t").orderBy("k", "chunk").collect():
        by.setdefault(r["k"], []).append(r)
    assert set(by) == {1, 2, 5, 6} and len(by[6]) == 1
    for k, t in texts:
        if k in by:
            assert by[k][0]["start"] == 0 and by[k][-1]["end"] == len(t)
            for a, b in zip(by[k], by[k][1:]):
                assert a["start"] < b["start"] <= a["end"] and b["end"] > a["end"]
            assert all(r["text"] == t[r["start"] : r["end"]] and len(r["text"]) <= 2000 for r in by[k])
    own = filings.stride_chunks(df, "k", "t").collect()
    assert {r["k"] for r in own} == {1, 2, 5, 6} and [r["start"] for r in own if r["k"] == 2] == [0, 1800, 3600]
    heads = filings.heading_chunks(spark.createDataFrame([(1, "intro\nITEM a\nbody\nITEM b\n" + "z" * 20)], "k long, t string"), "k", "t", "ITEM", most=10).orderBy("chunk").collect()
    assert "".join(r["text"] for r in heads) == "intro\nITEM a\nbody\nITEM b\n" + "z" * 20


def test_pages(spark):
    html = "<html><script>var x='<p>no</p>'</script><nav>menu</nav><p>" + "A long paragraph of text. " * 3 + "</p><p>short</p></html>"
    df = spark.createDataFrame([(1, html), (2, "<b>only a line that is long enough</b>"), (3, None), (4, "")], "k long, h string")
    got = {r["k"]: r["t"] for r in df.select("k", filings.page_text("h").alias("t")).collect()}
    assert got[1] == ("A long paragraph of text. " * 3).strip() and got[2] == "only a line that is long enough" and got[4] == ""
    u = spark.createDataFrame([("http://a.b/2024/03/15/big-news_today/",), ("http://a.b/20240230/x",), ("http://a.b/2024-1-5",)], "u string")
    assert [r["d"] for r in u.select(filings.url_date("u").alias("d")).collect()] == [dt.date(2024, 3, 15), None, dt.date(2024, 1, 5)]
    assert u.select(filings.url_title("u").alias("t")).first()["t"] == "Big News Today"


def test_entities(spark):
    rows = spark.createDataFrame([(1, "Goldman Sachs Group", 0.5), (1, "goldman sachs", 0.9), (1, "GS", 0.4), (1, "Other Corp", 0.3)], "g long, text string, score double")
    got = {r["text"]: (r["canonical"], r["confidence"]) for r in entity.greedy_groups(rows, ["g"], "text", "score").collect()}
    assert got["goldman sachs"] == got["GS"] == ("Goldman Sachs Group", 0.9) and got["Other Corp"] == ("Other Corp", 0.3)
    known = spark.createDataFrame([("Exact Sciences Corporation", 1), ("Grail, Inc.", 2)], "name string, entity long")
    names = spark.createDataFrame([("Grail, Inc.",), ("exact sciences",), ("Exact Science Inc",), ("Nobody",)], "name string")
    got = {r["name"]: (r["canonical_id"], r["method"]) for r in entity.resolve(names, known, known, "name", "entity").collect()}
    assert got["Grail, Inc."] == ("2", "exact") and got["exact sciences"] == ("1", "canonical") and got["Exact Science Inc"] == ("1", "fuzzy") and got["Nobody"][1] == "new"
    assert one(spark, cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0))).alias("x"))["x"] is None


def test_upserts(spark):
    a, b = (spark.createDataFrame(r, "k long, v string, t long") for r in ([(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (1, "d", 3), (3, "e", 1), (2, "old", 0)]))
    got = state.upsert(a, b, ["k"], ["t"])
    assert {r["k"]: r["v"] for r in got.collect()} == {1: "d", 2: "b", 3: "e"}
    assert {r["k"]: r["v"] for r in state.upsert(got, b, ["k"], ["t"]).collect()} == {1: "d", 2: "b", 3: "e"}
    x, y = state.snapshot(a, "k", "v").first(), state.snapshot(a.orderBy(F.desc("k")), "k", "v").first()
    assert x == y


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, None)], "k long, v string")
    state.write_csv(df, str(tmp_path / "c"))
    assert sorted(map(tuple, spark.read.schema(df.schema).option("header", True).option("escape", '"').csv(str(tmp_path / "c")).collect())) == [(1, 'say "hi", ok'), (2, None)]
    (tmp_path / "t.tsv").write_text("id\tname\n1\t\"A\"\nbad\tx\n2\tB\n")
    assert [tuple(r) for r in state.read_delimited(spark, str(tmp_path / "t.tsv"), "id long, name string").collect()] == [(1, "A"), (2, "B")]
    raw = spark.createDataFrame([("a@b.c", "Ann")], "`E-Mail Address` string, first_name string")
    assert state.read_aliased(raw, {"Email": ["E-Mail Address"], "First Name": [], "Title": ["Role"]}).first() == ("a@b.c", "Ann", None)
    state.write_table(df, str(tmp_path / "p"), "overwrite", ["k"])
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2


def test_campaign(spark):
    t = F.lit
    assert one(spark, campaign.priority(t(1), t("CEO"), t("a"), t("b"), t(9)).alias("x"))["x"] == 100
    assert one(spark, campaign.priority(t(12), t(None).cast("string"), t(None).cast("string"), t(""), t(20)).alias("x"))["x"] == 40
    assert one(spark, campaign.clean_profile_url(t("https://www.linkedin.com/in/www.linkedin.com/in/joe/")).alias("x"))["x"] == "https://www.linkedin.com/in/joe"
    assert one(spark, campaign.any_of(t("a, b ,,c,d,e,f,g,h")).alias("x"))["x"] == "a OR b OR c OR d OR e OR f OR g"
    assert one(spark, campaign.action_of(t("LinkedIn Invite"), t(""), t("")).alias("x"))["x"] == "connect"


def test_repartition_changes_nothing(spark):
    from tessera.plans import QUERIES
    from tessera.plans.market import bars_of

    a = sorted(map(tuple, market.folds(bars_of(spark, "/root/testdata/sf0.001")).collect()), key=repr)
    b = sorted(map(tuple, market.folds(bars_of(spark, "/root/testdata/sf0.001").repartition(7)).collect()), key=repr)
    assert a == b and "bars" in QUERIES


def test_around_equals_pattern(spark):
    """Cutting far text out changes no stretch: words near one another, at line ends, overlapping, in long and empty lines."""
    import random
    import re

    rng = random.Random(1)
    word = "sanctions"
    pieces = ["x" * 99, "x" * 100, "x" * 101, "y" * 250, "\n", " ", "", "anctions", word, word, "z" * 40, "ä" * 120]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, t string")
    got = {r["k"]: r["m"] for r in rows.select("k", filings.around(F.col("t"), word).alias("m")).collect()}
    assert got == {k: re.findall(f".{{0,100}}{word}.{{0,100}}", t) for k, t in enumerate(texts)}


def test_citations_and_posts(spark):
    text = "See U.S. Pat. Nos. 5,123,456; 6,234,567. U.S. Patent Application Publication No. 2010/0123456 and Patent No. 12. Smith and Jones, 2001; Nature Reviews 2019;562:203-210. Lee and Kim et al. (2011), Table and Figure, 2003. Doe et al., 1999"
    r = spark.createDataFrame([(text,), (None,), ("",)], "t string").select(filings.patent_citations("t").alias("p"), filings.paper_citations("t").alias("q")).collect()
    assert r[0]["p"] == ["US5123456", "US6234567", "US20100123456"]
    assert r[0]["q"] == ["Doe et al., 1999", "Lee and Kim et al. (2011)", "Smith and Jones, 2001", "Nature Reviews 2019;562:203-210"] and r[1]["q"] == r[2]["p"] == []
    post = "FDA-approved Zetamab, therapy Nova Plus Fast Track Designation; Pfizer $12.5M $ABC Phase IIb"
    got = {(r["kind"], r["entity"]) for r in filings.entities(spark.createDataFrame([(1, post)], "k long, t string"), ["k"], "t", filings.POST_ENTITIES).collect()}
    assert got == {("fda", "FDA-approved"), ("fda", "Fast Track Designation"), ("drug", "Zetamab"), ("drug", "therapy Nova Plus Fast Track Designation"), ("company", "Pfizer"), ("price", "$12.5M"), ("ticker", "$ABC"), ("phase", "Phase IIb")}
