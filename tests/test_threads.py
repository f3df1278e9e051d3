"""Threads whose slope is just 0.1 or -0.1 fall on the side that SQL gives them."""

import duckdb

from tessera import plans
from tessera.plans.social import DOWN, UP

#: Hits of hopeful and gloomy words of six turns each: the slope is 0.1 up to its last digit.
TIES = [
    [(1, 1), (2, 1), (1, 1), (1, 0), (2, 1), (3, 1)],
    [(2, 1), (2, 1), (2, 1), (1, 0), (1, 0), (3, 1)],
    [(0, 1), (2, 1), (2, 1), (2, 1), (0, 1), (3, 1)],
]


def test_slopes_at_the_limit(spark, tmp_path):
    sides = [*TIES, *[[(b, a) for a, b in t] for t in TIES], *[t[::-1] for t in TIES], [(0, 1), (0, 1), (0, 1), (0, 0)], [(1, 0)]]
    rows = [(k, n, "|".join(UP[:a] + DOWN[:b])) for k, t in enumerate(sides) for n, (a, b) in enumerate(t)]
    spark.createDataFrame(rows, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r["trend"] for r in plans.QUERIES["thread_trend"](spark, str(tmp_path)).collect()}
    c = duckdb.connect()
    c.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = dict(c.sql(f"SELECT conv_id, trend FROM ({plans.ORACLE['thread_trend']})").fetchall())
    assert got == want and len(got) == len(sides)
