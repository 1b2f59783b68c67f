"""Column-name resolution, done on the schema alone so it never runs a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.casts import col, to_day, to_double, to_key

# Accepted spellings, first match wins.
FISCAL_YEAR_NAMES = ("fiscal_year", "year", "fy", "fiscalyear")
FISCAL_PERIOD_NAMES = ("fiscal_period", "period", "fp", "fiscalperiod")
SUPER_BOWL_NAMES = ("superbowl", "super_bowl")
LABOR_DATE_NAMES = ("event_date", "date", "work_date", "shift_date")
LABOR_STORE_NAMES = (
    "Labor_Store_Number", "store_number", "Store_Number", "store", "storeid", "store_id", "Store",
)
LABOR_HOUR_PARTS = ("normal_hours", "ot_hours", "dt_hours")
BUDGET_STORE_NAMES = (
    "store_number", "Heatmap_Store_Number", "heatmap_storenumber", "Store_Number", "store", "storeid",
)
FORECAST_NAMES = ("sales_forecast", "our_forecast", "forecast")


def first_named(df: DataFrame, names: Sequence[str], any_case: bool = False) -> str | None:
    if not any_case:
        return next((n for n in names if n in df.columns), None)
    by_lower = {c.strip().lower(): c for c in reversed(df.columns)}
    return next((by_lower[n.lower()] for n in names if n.lower() in by_lower), None)


def standard_fiscal(df: DataFrame, required: bool = True) -> DataFrame:
    """Renames whatever the fiscal columns are called to fiscal_year and fiscal_period."""
    fy = first_named(df, FISCAL_YEAR_NAMES, any_case=True)
    fp = first_named(df, FISCAL_PERIOD_NAMES, any_case=True)
    if fy is None or fp is None:
        if required:
            raise KeyError(f"calendar needs fiscal year and period columns; it has {df.columns}")
        return df
    return df.withColumnsRenamed({fy: "fiscal_year", fp: "fiscal_period"})


def super_bowl_column(df: DataFrame) -> str | None:
    return next(
        (c for c in df.columns if c.strip().lower().replace(" ", "") in SUPER_BOWL_NAMES), None
    )


def store_column(df: DataFrame) -> str:
    """store_number, else the first column that mentions both store and number."""
    if "store_number" in df.columns:
        return "store_number"
    for c in df.columns:
        if "store" in c.lower() and "number" in c.lower():
            return c
    raise KeyError(f"no store number column in {df.columns}")


def normalize_labor(df: DataFrame, by_date: bool = True) -> DataFrame:
    """(store_number, event_date, department, hours) whatever the source calls them.

    Without `by_date` the rows carry fiscal_year and fiscal_period of their own in place of a date.
    """
    if by_date:
        day = first_named(df, LABOR_DATE_NAMES)
        if day is None:
            raise KeyError(f"labor needs a date column, one of {LABOR_DATE_NAMES}")
        placed = [to_day(day).alias("event_date")]
    else:
        missing = {"fiscal_year", "fiscal_period"} - set(df.columns)
        if missing:
            raise KeyError(f"labor without a calendar needs columns {sorted(missing)}")
        placed = [to_key(c).alias(c) for c in ("fiscal_year", "fiscal_period")]
    store = first_named(df, LABOR_STORE_NAMES)
    if store is None:
        raise KeyError(f"labor needs a store column, one of {LABOR_STORE_NAMES}")
    dept = first_named(df, ("department", "dept"))
    if "total_hours" in df.columns:
        hours = to_double("total_hours")
    else:
        parts = [F.coalesce(to_double(c), F.lit(0.0)) for c in LABOR_HOUR_PARTS if c in df.columns]
        hours = sum(parts[1:], parts[0]) if parts else F.lit(0.0)
    return df.select(
        F.trim(col(store).cast("string")).alias("store_number"),
        *placed,
        (col(dept).cast("string") if dept else F.lit("Unknown")).alias("department"),
        hours.alias("hours"),
    )


def normalize_budget(df: DataFrame, key_fn) -> DataFrame:
    """(store_key, fiscal_year, fiscal_period, budget_total_net_sales), unplaced rows dropped."""
    store = first_named(df, BUDGET_STORE_NAMES)
    if store is None:
        raise KeyError(f"budget needs a store column, one of {BUDGET_STORE_NAMES}")
    fy = first_named(df, ("fiscal_year", "year"))
    fp = first_named(df, ("fiscal_period", "period_number"))
    amount = first_named(df, ("budget_total_net_sales", "total_net_sales"))
    if None in (fy, fp, amount):
        raise KeyError(f"budget needs year, period and amount columns; it has {df.columns}")
    return df.select(
        key_fn(store).alias("store_key"),
        to_key(fy).alias("fiscal_year"),
        to_key(fp).alias("fiscal_period"),
        to_double(amount).alias("budget_total_net_sales"),
    ).where(F.col("fiscal_year").isNotNull() & F.col("fiscal_period").isNotNull())


def normalize_forecast(df: DataFrame, out: str = "sales_forecast") -> DataFrame:
    """Trimmed store, integer fiscal keys and one forecast column named `out`."""
    name = first_named(df, FORECAST_NAMES)
    if name is None:
        raise KeyError(f"forecast table needs one of {FORECAST_NAMES}; it has {df.columns}")
    kept = [c for c in df.columns if c in ("source", "State", "scenario")]
    return df.select(
        *kept,
        F.trim(F.col("store_number").cast("string")).alias("store_number"),
        to_key("fiscal_year").alias("fiscal_year"),
        to_key("fiscal_period").alias("fiscal_period"),
        to_double(name).alias(out),
    )


def normalize_history(df: DataFrame) -> DataFrame:
    """Trimmed store, integer fiscal keys and the observed sales as `actual`."""
    missing = {"store_number", "fiscal_year", "fiscal_period", "total_net_sales"} - set(df.columns)
    if missing:
        raise KeyError(f"sales history is missing columns {sorted(missing)}")
    return df.withColumns(
        {
            "store_number": F.trim(F.col("store_number").cast("string")),
            "fiscal_year": to_key("fiscal_year"),
            "fiscal_period": to_key("fiscal_period"),
            "actual": to_double("total_net_sales"),
        }
    )
