"""Forecast errors by group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.functions.casts import col
from tillcast.functions.stats import wape
from tillcast.operators.ranking import exact_percentiles


def join_actuals(fc: DataFrame, hist: DataFrame) -> DataFrame:
    """Forecast rows with the observed sales of the same store and period, if any; several rows add up."""
    keys = ["store_number", "fiscal_year", "fiscal_period"]
    observed = hist.groupBy(*keys).agg(F.sum("actual").alias("actual"))
    return fc.join(observed, keys, "left")


def wape_by(df: DataFrame, by: Sequence[str], actual: str, forecasts: dict[str, str]) -> DataFrame:
    """Ratio of sums inside each group; NULL for a group without a usable pair."""
    cols = [wape(actual, f).alias(out) for out, f in forecasts.items()]
    return df.groupBy(*by).agg(*cols)


def as_percent(c: str | Column) -> Column:
    """Percent with two decimals, halves to even."""
    return F.bround(col(c) * 100, 2)


def store_errors(df: DataFrame, actual: str, forecast: str) -> DataFrame:
    """(store_number, wape, mae, mean_actual_sales)."""
    return df.groupBy("store_number").agg(
        wape(actual, forecast).alias("wape"),
        F.avg(F.abs(col(actual) - col(forecast))).alias("mae"),
        F.avg(col(actual)).alias("mean_actual_sales"),
    )


def store_error_summary(errors: DataFrame) -> DataFrame:
    """Mean, median and p10/p90 of the per-store WAPE; stores without one do not count."""
    spread = exact_percentiles(errors, "wape", {"p10": 0.1, "median": 0.5, "p90": 0.9})
    mean = errors.agg(F.avg("wape")).scalar()
    return spread.withColumn("mean", mean)


def worst_stores(errors: DataFrame, n: int = 15) -> DataFrame:
    return errors.orderBy(F.col("wape").desc_nulls_last(), "store_number").limit(n)
