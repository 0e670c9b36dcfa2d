"""Statistical formulas as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Z95 = 1.96


def wilson(k: Column, n: Column, z: float = Z95, empty: tuple[float, float] = (0.0, 0.0)) -> Column:
    """struct(rate, low, high): Wilson interval, clamped to 0..1; ``empty`` where n is 0."""
    p, m = k / n, n.cast("double")
    centre, half, scale = p + z * z / (2 * m), z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m)), 1 + z * z / m
    some = n > 0
    low = F.when(some, F.greatest(F.lit(0.0), (centre - half) / scale)).otherwise(empty[0])
    high = F.when(some, F.least(F.lit(1.0), (centre + half) / scale)).otherwise(empty[1])
    return F.struct(F.when(some, p).otherwise(0.0).alias("rate"), low.alias("low"), high.alias("high"))


def cochran(n: Column, error: float = 0.05, z: float = Z95, p: float = 0.5) -> Column:
    """Sample size for a proportion with finite-population correction; 0 for an empty population."""
    n0 = z * z * p * (1 - p) / (error * error)
    return F.when(n <= 0, 0).otherwise(F.least(n.cast("long"), F.ceil(F.lit(n0) / (1 + (n0 - 1) / n))))


def chi_square(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Pearson's statistic of a 2x2 table; null if a margin is 0."""
    a, b, c, d = (x.cast("double") for x in (a, b, c, d))
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return F.when(margins > 0, (a + b + c + d) * F.pow(a * d - b * c, 2) / margins)


@F.pandas_udf(DoubleType())
def _erfc(x):
    import pandas as pd

    return pd.Series([math.erfc(v) if v == v else None for v in x], dtype="float64")


def chi_square_p(a: Column, b: Column, c: Column, d: Column) -> Column:
    """p value; 1 if a margin is 0. Spark has no erfc, so this one is an Arrow UDF; decisions use the statistic."""
    return F.coalesce(_erfc(F.sqrt(chi_square(a, b, c, d) / 2)), F.lit(1.0))


def verdict(low: Column, high: Column, target: float = 0.95) -> Column:
    """Acceptance on the interval, not on the point."""
    return F.when(low > target, "CUMPLE").when(high < target, "NO CUMPLE").otherwise("insuficiente")


def clamp_confidence(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), c)))


def confidence_note(c: Column) -> Column:
    """What was wrong with a confidence that had to be clamped; null if nothing was."""
    out_of_range = F.concat(F.lit("confianza fuera de rango ("), c.cast("string"), F.lit("), acotada"))
    return F.when(F.isnan(c), F.lit("el modelo devolvio una confianza no numerica")).when((c < 0) | (c > 1), out_of_range)
