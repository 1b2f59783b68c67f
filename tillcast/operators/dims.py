"""Side tables: events, price index, weather, states, id crosswalk."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import MONTHS
from tillcast.functions.casts import col, finite_sql, flag01, require, to_day, to_double
from tillcast.functions.fiscal import month_of_yyyymm
from tillcast.functions.keys import digits_key
from tillcast.functions.names import super_bowl_column
from tillcast.operators.calendar import daily_calendar

# Misspelled state names in the inputs.
STATE_FIXES = {"Kanas": "Kansas", "Alabma": "Alabama"}


# ---- events ----------------------------------------------------------------------------------

def event_flags(events: DataFrame, flags: dict[str, str], keys: Sequence[str]) -> DataFrame:
    """One row per key with each flag at its maximum, so repeated event rows cannot fan out."""
    require(events, [*keys, *flags], "events")
    return (
        events.withColumn("event_date", to_day("event_date"))
        .groupBy(*keys)
        .agg(*[F.max(flag01(src)).alias(out) for src, out in flags.items()])
    )


def attach_event_flags(df: DataFrame, flags: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join; rows without an event get 0. Size decides the join strategy, not a hint."""
    names = [c for c in flags.columns if c not in keys]
    joined = df.join(flags, list(keys), "left")
    return joined.withColumns({c: F.coalesce(col(c), F.lit(0)) for c in names})


def super_bowl_flags(events: DataFrame, cal: DataFrame) -> tuple[DataFrame, list[str]]:
    """(flag table, its keys) from date-keyed, store-and-date-keyed or period-keyed events."""
    src = super_bowl_column(events)
    if src is None:
        raise KeyError(f"no Super Bowl column in events: {events.columns}")
    if "event_date" not in events.columns:
        starts = cal.select("fiscal_year", "fiscal_period", F.col("BeginningDate").alias("event_date"))
        events = events.join(F.broadcast(starts), ["fiscal_year", "fiscal_period"])
    keys = ["event_date"] + (["store_number"] if "store_number" in events.columns else [])
    if len(keys) == 2:
        events = events.withColumn("store_number", F.trim(F.col("store_number").cast("string")))
    return event_flags(events, {src: "Super Bowl"}, keys), keys


def events_by_period(events: DataFrame, cal: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Events lifted to fiscal periods: flagged if any of the period's days is, dated at its start."""
    daily = daily_calendar(cal, "BeginningDate")
    hits = events.withColumn("event_date", to_day("event_date")).join(F.broadcast(daily), "event_date")
    return (
        hits.groupBy("fiscal_year", "fiscal_period", "BeginningDate")
        .agg(*[F.max(flag01(f)).alias(f) for f in flags])
        .withColumnRenamed("BeginningDate", "event_date")
    )


# ---- consumer price index --------------------------------------------------------------------

def cpi_monthly(cpi: DataFrame, backfill: bool = True) -> DataFrame:
    """Wide months to (cal_month, CPI), gaps filled in time order. Twelve rows a year."""
    year = next(c for c in cpi.columns if c.lower() == "year")
    months = [m for m in MONTHS if m in cpi.columns]
    long = cpi.selectExpr(f"`{year}` AS _y", *[f"{finite_sql(f'try_cast({m} AS DOUBLE)')} AS {m}" for m in months])
    month_no = f"array_position(array({', '.join(repr(m) for m in MONTHS)}), Month)"
    dated = long.unpivot(["_y"], months, "Month", "CPI").selectExpr(
        f"last_day(make_date(CAST(_y AS INT), CAST({month_no} AS INT), 1)) AS cal_month", "CPI"
    )
    in_time = Window.partitionBy(F.lit(1)).orderBy("cal_month")
    past = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    future = in_time.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = F.last("CPI", ignorenulls=True).over(past)
    if backfill:
        filled = F.coalesce(filled, F.first("CPI", ignorenulls=True).over(future))
    return dated.withColumn("CPI", filled)


def cpi_by_period(cpi: DataFrame, cal: DataFrame) -> DataFrame:
    """(fiscal_year, fiscal_period, CPI): the month that holds the period's last day."""
    if {"fiscal_year", "fiscal_period", "CPI"} <= set(cpi.columns):
        keyed = cpi
    else:
        monthly = cpi if "cal_month" in cpi.columns else cpi_monthly(cpi)
        ends = cal.withColumn("cal_month", F.last_day("EndingDate"))
        keyed = ends.join(F.broadcast(monthly), "cal_month", "left")
    return keyed.groupBy("fiscal_year", "fiscal_period").agg(F.max(to_double("CPI")).alias("CPI"))


# ---- weather and states ----------------------------------------------------------------------

def clean_state(c: str | Column) -> Column:
    out = F.initcap(F.trim(col(c)))
    for wrong, right in STATE_FIXES.items():
        out = F.replace(out, F.lit(wrong), F.lit(right))
    return out


def weather_by_period(weather: DataFrame, cal: DataFrame) -> DataFrame:
    """Wide states to (fiscal_year, fiscal_period, State, avg_temp) by the month's last day."""
    states = [c for c in weather.columns if c.strip() != "Date"]
    dated = weather.select(
        month_of_yyyymm("Date").alias("event_date"), *[to_double(s).alias(s.strip()) for s in states]
    )
    placed = dated.join(F.broadcast(daily_calendar(cal)), "event_date")
    long = placed.unpivot(
        ["event_date", "fiscal_year", "fiscal_period"], [s.strip() for s in states], "State", "avg_temp"
    )
    return (
        long.withColumn("State", clean_state("State"))
        .groupBy("fiscal_year", "fiscal_period", "State")
        .agg(F.max_by("avg_temp", "event_date").alias("avg_temp"))
    )


def state_of_store(source: DataFrame) -> DataFrame:
    """(store_number, State), one row per store: the most frequent state, ties to the first name.

    Reads a hierarchy, or else the first state-like column of a fact table.
    """
    if {"Heatmap_Store_Number", "State"} <= set(source.columns):
        store, state = "Heatmap_Store_Number", "State"
    else:
        store = "store_number"
        state = next((c for c in source.columns if "state" in c.lower() and c != store), None)
        if state is None:
            raise KeyError(f"no state column in {source.columns}")
    pairs = source.select(
        F.trim(col(store).cast("string")).alias("store_number"), F.trim(col(state)).alias("State")
    ).where(F.col("State").isNotNull())
    counted = pairs.groupBy("store_number", "State").agg(F.count("*").alias("n"))
    return counted.groupBy("store_number").agg(
        F.min_by("State", F.struct(-F.col("n"), F.col("State"))).alias("State")
    )


def attach_state(df: DataFrame, source: DataFrame, default: str | None = "Unknown") -> DataFrame:
    out = df.join(state_of_store(source), "store_number", "left")
    return out.withColumn("State", F.coalesce("State", F.lit(default))) if default else out


def attach_weather(df: DataFrame, weather: DataFrame) -> DataFrame:
    """avg_temp by period and cleaned state; NULL where either is unknown."""
    cleaned = df.withColumn("State", clean_state("State"))
    return cleaned.join(weather, ["fiscal_year", "fiscal_period", "State"], "left")


# ---- store id crosswalk ----------------------------------------------------------------------

def key_map(hierarchy: DataFrame) -> DataFrame:
    """(store_key, hm_key): every store number and every sales id, mapped pairs before identities."""
    stores = hierarchy.toDF(*[c.strip() for c in hierarchy.columns])
    require(stores, ["Store_Number", "Heatmap_Store_Number"], "hierarchy")
    pairs = stores.select("Store_Number", "Heatmap_Store_Number").na.drop()
    mapped = pairs.select(
        digits_key("Store_Number").alias("store_key"),
        digits_key("Heatmap_Store_Number").alias("hm_key"),
        F.lit(0).alias("rank"),
    )
    same = mapped.select(F.col("hm_key").alias("store_key"), "hm_key", F.lit(1).alias("rank"))
    return (
        mapped.unionByName(same)
        .groupBy("store_key")
        .agg(F.min_by("hm_key", F.struct("rank", "hm_key")).alias("hm_key"))
    )


def attach_hm_key(df: DataFrame, mapping: DataFrame, store_col: str = "store_number") -> DataFrame:
    """hm_key of each row's store; an unmapped store keeps its own digits."""
    keyed = df.withColumn("store_key", digits_key(store_col))
    joined = keyed.join(mapping, "store_key", "left")
    return joined.withColumn("hm_key", F.coalesce("hm_key", "store_key")).drop("store_key")


def keep_keys(
    df: DataFrame, key: str, allowed: DataFrame | None = None, excluded: DataFrame | None = None
) -> DataFrame:
    """Allow list first, deny list second; both are one-column tables of keys."""
    out = df
    if allowed is not None:
        out = out.join(allowed.toDF(key), key, "left_semi")
    if excluded is not None:
        out = out.join(excluded.toDF(key), key, "left_anti")
    return out


def active_stores(fc: DataFrame, hierarchy: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Forecast rows of stores the hierarchy knows, minus an exclude list."""
    known = hierarchy.select(F.trim(F.col("Heatmap_Store_Number").cast("string")))
    return keep_keys(fc, "store_number", known.distinct(), excluded)
