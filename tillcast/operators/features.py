"""Feature table: calendar, events, price index, seasonality and lags in one lazy plan.

The grain is one row per store and date, so a store's window holds no more rows than the calendar
has dates. Side tables are joined before the only shuffle (on the store).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import SALES_LAG, ForecastConfig
from tillcast.functions.casts import col, gate, ratio, require, to_day, to_double, to_key
from tillcast.functions.fiscal import period_index, seasonality
from tillcast.functions.keys import drop_stores, store_id
from tillcast.operators.calendar import attach_period_attributes, map_dates, prepare_calendar
from tillcast.operators.dims import attach_event_flags, cpi_by_period, super_bowl_flags


def store_window(cfg: ForecastConfig) -> Window:
    return Window.partitionBy(cfg.store_col).orderBy(cfg.date_col, cfg.fy, cfg.fp)


def lagged(value: str | Column, w: Window) -> Column:
    """The store's previous row, whichever period that is."""
    return F.lag(col(value)).over(w)


def last_known_before(value: str | Column, w: Window) -> Column:
    """Forward fill and lag in one step: the newest value before the current row."""
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    return F.last(col(value), ignorenulls=True).over(before)


def clean_sales(
    base: DataFrame, cfg: ForecastConfig, exclude_stores: Sequence[object] | None = None
) -> DataFrame:
    require(base, [cfg.store_col, cfg.date_col, cfg.target], "sales")
    casts = {
        cfg.store_col: store_id(cfg.store_col),
        cfg.date_col: to_day(cfg.date_col),
        cfg.target: to_double(cfg.target),
    }
    if "total_advertising" in base.columns:
        casts["total_advertising"] = F.coalesce(to_double("total_advertising"), F.lit(0.0))
    ids = cfg.exclude_stores if exclude_stores is None else exclude_stores
    return drop_stores(base.withColumns(casts), cfg.store_col, ids)


def place_in_calendar(df: DataFrame, cal: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Fiscal keys (kept if the input has them) and is_5w."""
    df = df.drop("is_5w")
    if {cfg.fy, cfg.fp} <= set(df.columns):
        keyed = df.withColumns({cfg.fy: to_key(cfg.fy), cfg.fp: to_key(cfg.fp)})
        return attach_period_attributes(keyed, cal, "is_5w")
    return map_dates(df, cal, "is_5w", date_col=cfg.date_col)


def build_feature_table(
    base: DataFrame,
    calendar: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    events: DataFrame | None = None,
    cpi: DataFrame | None = None,
    exclude_stores: Sequence[object] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Keys, target and the configured features; columns the input already has are not recomputed.

    Rows need a target and a sales lag. Other features fall back to 0. `keep` carries extra columns.
    """
    cal = prepare_calendar(calendar)
    df = clean_sales(base, cfg, exclude_stores)
    if events is not None:
        flags, keys = super_bowl_flags(events, cal)
        df = attach_event_flags(df.drop("Super Bowl"), flags, keys)
    elif "Super Bowl" not in df.columns:
        alias = col("Super_Bowl") if "Super_Bowl" in df.columns else F.lit(0)
        df = df.withColumn("Super Bowl", alias)
    if "Super_Bowl" in cfg.feature_list and "Super_Bowl" not in df.columns:
        df = df.withColumn("Super_Bowl", col("Super Bowl"))

    df = place_in_calendar(df, cal, cfg).withColumns(seasonality(cfg.fp))

    if cpi is not None and "CPI_m1" not in df.columns:
        by_period = cpi_by_period(cpi, cal)
        df = df.drop("CPI").join(F.broadcast(by_period), ["fiscal_year", "fiscal_period"], "left")

    w = store_window(cfg)
    lags: dict[str, Column] = {}
    if SALES_LAG not in df.columns:
        lags[SALES_LAG] = lagged(cfg.target, w)
    if "adv_m1" not in df.columns:
        has_adv = "total_advertising" in df.columns
        lags["adv_m1"] = lagged("total_advertising", w) if has_adv else F.lit(0.0)
    if "CPI_m1" not in df.columns:
        lags["CPI_m1"] = last_known_before("CPI", w) if "CPI" in df.columns else F.lit(0.0)
    df = df.withColumns(lags)

    features = list(cfg.feature_list)
    df = df.withColumns({f: F.lit(0.0) for f in features if f not in df.columns})
    number = {f: to_double(f) for f in features}
    filled = [
        (number[f] if f == SALES_LAG else F.coalesce(number[f], F.lit(0.0))).alias(f) for f in features
    ]
    out = df.select(
        cfg.store_col, cfg.date_col, cfg.fy, cfg.fp, cfg.target, *filled,
        *[c for c in keep if c not in (*features, cfg.target)],
    )
    needed = [cfg.target] + ([SALES_LAG] if SALES_LAG in features else [])
    return out.na.drop(subset=needed)


def gap_check(df: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Rows whose previous row is not the previous fiscal period, with the number of periods missing."""
    w = store_window(cfg)
    idx = period_index(cfg.fy, cfg.fp)
    gaps = df.withColumn("missing_periods", idx - F.lag(idx).over(w) - 1)
    return gaps.where(F.col("missing_periods") > 0).select(
        cfg.store_col, cfg.fy, cfg.fp, "missing_periods"
    )


def gated_measures(df: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """Measures that count only where the store's keep flag is 1, their sales ratios, and lags."""
    gated = df.withColumns(
        {
            "adv": gate("Advertising_keep", "total_advertising"),
            "dlv": gate("Delivery_keep", "total_delivery"),
            "food": gate("FoodCost_keep", "total_food_cost"),
        }
    ).withColumns({"deliverypct": ratio("dlv", cfg.target), "foodpct": ratio("food", cfg.target)})
    w = store_window(cfg)
    sources = {SALES_LAG: cfg.target, "adv_m1": "adv", "deliverypct_m1": "deliverypct", "foodpct_m1": "foodpct"}
    return gated.withColumns({out: lagged(src, w) for out, src in sources.items()})
