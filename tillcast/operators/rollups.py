"""Forecast totals by state, period, source and scenario."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.casts import col, sum0
from tillcast.functions.fiscal import period_label

PERIOD = ["fiscal_year", "fiscal_period"]


def totals(df: DataFrame, by: Sequence[str], sums: dict[str, str], stores: bool = True) -> DataFrame:
    """Sums (0 for a group without values) and distinct stores.

    Store-level partial sums come first; the distinct count then is a plain count of stores.
    """
    if not stores:
        return df.groupBy(*by).agg(*[sum0(src).alias(out) for out, src in sums.items()])
    per_store = df.groupBy(*by, "store_number").agg(*[F.sum(col(src)).alias(out) for out, src in sums.items()])
    return per_store.groupBy(*by).agg(
        *[sum0(out).alias(out) for out in sums], F.count("store_number").alias("stores")
    )


def by_state(fc: DataFrame, forecast: str = "forecast") -> DataFrame:
    return totals(fc, ["State", *PERIOD], {"forecast": forecast})


def by_state_source(fc: DataFrame) -> DataFrame:
    """Rows and stores per state and forecast source."""
    per_store = fc.groupBy("State", "source", "store_number").agg(F.count("*").alias("n"))
    return per_store.groupBy("State", "source").agg(F.sum("n").alias("rows"), F.count("store_number").alias("stores"))


def by_period(fc: DataFrame, forecast: str = "forecast") -> DataFrame:
    return totals(fc, PERIOD, {"forecast": forecast})


def with_grand_total(fc: DataFrame, forecast: str = "forecast") -> DataFrame:
    """Period totals plus one row without a period: the grand total and all contributing stores."""
    per_store = fc.groupBy(*PERIOD, "store_number").agg(F.sum(col(forecast)).alias("f"))
    return (
        per_store.groupingSets([PERIOD, []], *PERIOD)
        .agg(sum0("f").alias("forecast"), F.count_distinct("store_number").alias("stores"))
    )


def top_state_periods(states: DataFrame, n: int = 15) -> DataFrame:
    return states.orderBy(F.col("forecast").desc_nulls_last(), "State", *PERIOD).limit(n)


def period_labels(fc: DataFrame) -> list[str]:
    """Labels of the forecast periods in time order; one row per period reaches the driver."""
    rows = fc.select(*PERIOD).distinct().orderBy(*PERIOD).collect()
    return [f"{r['fiscal_year']}-P{r['fiscal_period']}" for r in rows]


def state_period_pivot(fc: DataFrame, labels: Sequence[str] | None = None, forecast: str = "forecast") -> DataFrame:
    """States by periods with a Total column and an 'All States' row; absent cells are 0.

    The labels choose the columns only: totals are over all periods.

    The extra row falls out of the same aggregation through grouping sets.
    """
    labels = list(labels or period_labels(fc))
    small = fc.groupBy("State", *PERIOD).agg(F.sum(col(forecast)).alias("f"))
    labelled = small.withColumn("period", period_label(*PERIOD))
    cells = [F.coalesce(F.sum(F.when(F.col("period") == p, F.col("f"))), F.lit(0.0)).alias(p) for p in labels]
    return (
        labelled.groupingSets([["State"], []], "State")
        .agg(*cells, sum0("f").alias("Total"), F.grouping_id().alias("_all"))
        .withColumn("State", F.when(F.col("_all") == 1, "All States").otherwise(F.col("State")))
        .drop("_all")
    )


def scenario_pivot(fc: DataFrame, scenarios: Sequence[str]) -> DataFrame:
    """(store_number, period) rows, one forecast column per scenario."""
    labelled = fc.withColumn("period", period_label(*PERIOD))
    return labelled.groupBy("store_number", "period").pivot("scenario", list(scenarios)).agg(F.sum("forecast"))


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("rows"))
