"""Forecast against budget."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.keys import digits_key, store_id
from tillcast.functions.names import normalize_budget, normalize_forecast
from tillcast.operators.rollups import PERIOD, totals


def with_proxy_years(budget: DataFrame, fc: DataFrame, growth: float = 0.0) -> DataFrame:
    """Budget rows plus, for every forecast year without a budget, last year's grown by `growth`.

    A year can only be carried if the year before has a real budget. budget_source tells them apart.
    """
    have = budget.select("fiscal_year").distinct()
    need = fc.select("fiscal_year").distinct().join(have, "fiscal_year", "left_anti")
    from_year = need.select(F.col("fiscal_year").alias("_to"), (F.col("fiscal_year") - 1).alias("fiscal_year"))
    carried = budget.join(F.broadcast(from_year), "fiscal_year").select(
        "store_key",
        F.col("_to").alias("fiscal_year"),
        "fiscal_period",
        (F.col("budget_total_net_sales") * (1.0 + growth)).alias("budget_total_net_sales"),
        F.concat(F.lit("proxy_from_"), F.col("fiscal_year").cast("string")).alias("budget_source"),
    )
    return budget.withColumn("budget_source", F.lit("real")).unionByName(carried)


def budget_gap(fc: DataFrame, budget: DataFrame, proxies: bool = False, growth: float = 0.0) -> DataFrame:
    """Forecast rows with their budget, gap and gap percent.

    The percent is NULL without a positive budget, and for proxies without a non-zero one.
    """
    key = store_id if proxies else digits_key
    real = normalize_budget(budget, key)
    rows = normalize_forecast(fc, "forecast_baseline").withColumn("store_key", key("store_number"))
    if "source" not in rows.columns:
        rows = rows.withColumn("source", F.lit("model"))
    side = with_proxy_years(real, rows, growth) if proxies else real
    joined = rows.join(side, ["store_key", *PERIOD], "left").drop("store_key")
    gap = F.col("forecast_baseline") - F.col("budget_total_net_sales")
    usable = F.col("budget_total_net_sales") != 0 if proxies else F.col("budget_total_net_sales") > 0
    return joined.withColumns(
        {"gap_value": gap, "gap_percent": F.when(usable, gap / F.col("budget_total_net_sales"))}
    )


def budget_totals(gaps: DataFrame) -> DataFrame:
    sums = {
        "total_forecast": "forecast_baseline",
        "total_budget": "budget_total_net_sales",
        "gap_value": "gap_value",
    }
    return totals(gaps, PERIOD, sums)


def first_gaps(gaps: DataFrame, n: int = 15) -> DataFrame:
    return gaps.orderBy(*PERIOD, "store_number").limit(n)


def unmatched_budgets(gaps: DataFrame) -> DataFrame:
    """Distinct store-periods without a budget."""
    missing = gaps.where(F.col("budget_total_net_sales").isNull())
    return missing.select("store_number", *PERIOD).distinct()


