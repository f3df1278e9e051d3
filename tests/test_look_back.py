"""Signals need only the last rows of a symbol, made of all its rows."""

from tessera.operators import market as M
from tessera.plans import market as P

DATA = "/root/testdata/sf0.001"


def test_last_rows_of_few_equal_those_of_all(spark):
    few = M.indicators(P.bars_of(spark, DATA, dealt=True), M.LOOK_BACK)
    assert few.groupBy("symbol").count().agg({"count": "max"}).first()[0] == M.LOOK_BACK
    a, b = ({r["symbol"]: r.asDict() for r in M.last_rows(x).collect()} for x in (M.indicators(P.bars_of(spark, DATA)), few))
    assert a == b and a
