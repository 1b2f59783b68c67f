"""Closed-form statistics as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcast.functions.casts import col


def student_t_two_sided(t: str | Column, df: str | Column) -> Column:
    """P(|T| >= |t|) for a whole number of degrees of freedom.

    The distribution function has a finite trigonometric series for integer df. Term k+1 is term k
    times cos^2 times a ratio of small integers, so one fold over 1..df/2 adds it up exactly.
    """
    nu = col(df).cast("double")
    theta = F.atan(F.abs(col(t)) / F.sqrt(nu))
    sin, cos = F.sin(theta), F.cos(theta)
    cos2 = cos * cos
    odd = (nu % 2) == 1

    start = F.struct(
        F.when(odd, F.when(nu > 1, cos).otherwise(F.lit(0.0))).otherwise(F.lit(1.0)).alias("sum"),
        F.when(odd, cos).otherwise(F.lit(1.0)).alias("term"),
    )

    def step(acc: Column, k: Column) -> Column:
        up = F.when(odd, 2.0 * k).otherwise(2.0 * k - 1.0)
        down = F.when(odd, 2.0 * k + 1.0).otherwise(2.0 * k)
        term = acc["term"] * cos2 * up / down
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    last = F.floor(F.when(odd, (nu - 3) / 2).otherwise((nu - 2) / 2)).cast("int")
    steps = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    series = F.aggregate(steps, start, step, lambda acc: acc["sum"])
    inside = F.when(odd, (theta + sin * series) * (2.0 / math.pi)).otherwise(sin * series)
    return F.when((nu >= 1) & col(t).isNotNull(), F.greatest(F.lit(0.0), 1.0 - inside))


def wape(y: str | Column, yhat: str | Column) -> Column:
    """Aggregate: sum |y - yhat| / sum |y| over rows that have both; NULL when the divisor is 0."""
    a, b = col(y), col(yhat)
    both = a.isNotNull() & b.isNotNull()
    return F.try_divide(F.sum(F.when(both, F.abs(a - b))), F.sum(F.when(both, F.abs(a))))
