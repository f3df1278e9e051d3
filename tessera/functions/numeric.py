"""Column functions for numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def exact_sum(x, scale: int = 4) -> Column:
    """Sum in decimals, as a double: the same whatever order rows come in."""
    return F.sum(col(x).cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(x, scale: int = 4) -> Column:
    """Mean as one division of an exact sum."""
    return F.try_divide(exact_sum(x, scale), F.count(col(x)).cast("double"))


def ratio(a, b) -> Column:
    """a / b as doubles, 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(col(a).cast("double"), col(b).cast("double")), F.lit(0.0))


def share(a, b, digits: int = 1) -> Column:
    return F.round(F.try_divide(col(a) * 100.0, col(b)), digits)


def tiers(x, steps: list[tuple[float, object]], otherwise) -> Column:
    """The value of the first step that x reaches, steps from high to low; otherwise below all."""
    out = None
    for least, value in steps:
        c = col(x) >= least
        out = F.when(c, F.lit(value)) if out is None else out.when(c, F.lit(value))
    return out.otherwise(F.lit(otherwise))


def clamp(x, low: float, high: float) -> Column:
    return F.least(F.greatest(col(x), F.lit(low)), F.lit(high))


def normal_cdf(x) -> Column:
    """Cumulative normal distribution by the Abramowitz-Stegun polynomial 26.2.17 (error below 7.5e-8)."""
    x = col(x)
    t = 1.0 / (1.0 + 0.2316419 * F.abs(x))
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = 0.3989422804014327 * F.exp(-x * x / 2.0) * poly
    return F.when(x >= 0, 1.0 - upper).otherwise(upper)


def cosine(a, b) -> Column:
    """Cosine of two float arrays in double precision; null where a norm is 0."""
    a, b = (F.transform(col(v), lambda x: x.cast("double")) for v in (a, b))
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
