"""Arithmetic of the 13-period fiscal year."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillcast.config import PERIODS_PER_YEAR
from tillcast.functions.casts import col


def seasonality(fp: str | Column) -> dict[str, Column]:
    angle = col(fp).cast("double") * F.lit(2.0 * math.pi) / F.lit(float(PERIODS_PER_YEAR))
    return {"p13_sin": F.sin(angle), "p13_cos": F.cos(angle)}


def period_index(fy: str | Column, fp: str | Column) -> Column:
    """Periods since year 0; consecutive periods differ by 1."""
    return col(fy) * PERIODS_PER_YEAR + col(fp) - 1


def advance(fy: str | Column, fp: str | Column, k: str | int | Column) -> tuple[Column, Column]:
    """(fiscal year, fiscal period) k periods later."""
    step = F.lit(k) if isinstance(k, int) else col(k)
    idx = period_index(fy, fp) + step
    year = F.floor(idx / PERIODS_PER_YEAR).cast("int")
    return year, (F.pmod(idx, F.lit(PERIODS_PER_YEAR)) + 1).cast("int")


def period_label(fy: str | Column, fp: str | Column, mark: str = "P") -> Column:
    """'2001-P3'. The period is not padded, so sort by (year, period), never by the label."""
    return F.concat(col(fy).cast("string"), F.lit("-" + mark), col(fp).cast("string"))


def month_of_yyyymm(c: str | Column) -> Column:
    """Month end of a YYYYMM number or text; anything else is NULL."""
    return F.last_day(F.to_date(F.try_to_timestamp(col(c).cast("string"), F.lit("yyyyMM"))))
