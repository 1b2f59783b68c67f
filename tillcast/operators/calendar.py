"""Fiscal calendar: attributes, day lookup, interval lookup, alignment checks.

A calendar has 13 rows a year and its daily form 366, so both are safe to broadcast whatever the
size of the fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.casts import to_day, to_double, to_int
from tillcast.functions.names import standard_fiscal


def prepare_calendar(cal: DataFrame, required: bool = True) -> DataFrame:
    """Standard names, real dates, days_in_period and is_5w filled in where they are missing."""
    out = standard_fiscal(cal, required)
    out = out.withColumns({c: to_int(c) for c in ("fiscal_year", "fiscal_period") if c in out.columns})
    dates = [c for c in ("BeginningDate", "EndingDate") if c in out.columns]
    out = out.withColumns({c: to_day(c) for c in dates})
    if "days_in_period" not in out.columns and len(dates) == 2:
        out = out.withColumn("days_in_period", days_in_period("BeginningDate", "EndingDate"))
    if "is_5w" not in out.columns:
        out = out.withColumn("is_5w", is_five_week(out))
    return out


def days_in_period(first: str, last: str) -> Column:
    return (F.datediff(F.col(last), F.col(first)) + 1).cast("int")


def is_five_week(cal: DataFrame) -> Column:
    """From the number of weeks, else from 35 days or more, else 0."""
    if "weeks_in_period" in cal.columns:
        hit = to_double("weeks_in_period") == 5
    elif "days_in_period" in cal.columns:
        hit = to_double("days_in_period") >= 35
    else:
        hit = F.lit(False)
    return F.coalesce(hit, F.lit(False)).cast("int")


def rounded_weeks(days: str | Column) -> Column:
    """Period length in weeks, halves to even: the research rule for five-week periods."""
    return F.bround(F.col(days) / 7 if isinstance(days, str) else days / 7).cast("int")


def period_attributes(cal: DataFrame, *cols: str) -> DataFrame:
    """One row per (fiscal_year, fiscal_period)."""
    picked = [F.max(c).alias(c) for c in cols]
    return cal.groupBy("fiscal_year", "fiscal_period").agg(*picked)


def attach_period_attributes(df: DataFrame, cal: DataFrame, *cols: str) -> DataFrame:
    dim = period_attributes(cal, *cols)
    return df.join(F.broadcast(dim), ["fiscal_year", "fiscal_period"], "left")


def daily_calendar(cal: DataFrame, *cols: str) -> DataFrame:
    """One row per calendar day. The range lookup becomes an equality join this way."""
    spans = cal.where(F.col("BeginningDate") <= F.col("EndingDate"))
    return spans.select(
        F.explode(F.sequence("BeginningDate", "EndingDate")).alias("event_date"),
        "fiscal_year",
        "fiscal_period",
        *cols,
    )


def map_dates(df: DataFrame, cal: DataFrame, *cols: str, date_col: str = "event_date") -> DataFrame:
    """Fiscal period of each date, ends included; a date outside the calendar gets NULL."""
    daily = daily_calendar(cal, *cols).withColumnRenamed("event_date", date_col)
    return df.join(F.broadcast(daily), date_col, "left")


def misaligned(df: DataFrame, cal: DataFrame, date_col: str) -> DataFrame:
    """Rows whose date is no period end."""
    ends = cal.select(F.col("EndingDate").alias("_end")).distinct()
    return df.join(F.broadcast(ends), to_day(date_col) == F.col("_end"), "left_anti")


def year_pairs(df: DataFrame, cal: DataFrame, date_col: str, year_col: str) -> DataFrame:
    """How often each stated year meets each calendar year on the period end."""
    ends = cal.select(F.col("EndingDate").alias("_end"), "fiscal_year").distinct()
    joined = df.join(F.broadcast(ends), to_day(date_col) == F.col("_end"), "left")
    pairs = joined.where(F.col("fiscal_year").isNotNull()).groupBy(year_col, "fiscal_year")
    return pairs.agg(F.count("*").alias("rows"))
