"""Does an event or a cost share move a store's sales? One regression of log sales per store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.casts import clip, col, flag01, ratio, to_day, to_double
from tillcast.functions.stats import student_t_two_sided
from tillcast.operators.ranking import exact_median
from tillcast.operators.splits import history_length

MIN_ROWS = 6
SIGNIFICANT = 0.05

# Driver -> (effect column, factor on the slope, keep column).
EFFECTS = {
    "advertising": ("elasticity_per_1k", 100.0, "Advertising_keep"),
    "delivery": ("pct_change_per_10pp", 10.0, "Delivery_keep"),
    "food": ("pct_change_per_5pp", 5.0, "FoodCost_keep"),
}


def _moments(x: str, y: str) -> Column:
    """Aggregate: what a simple regression needs, from rows where x is known."""
    return F.expr(
        f"struct(regr_count({y}, {x}) AS n, regr_sxx({y}, {x}) AS sxx, regr_sxy({y}, {x}) AS sxy,"
        f" regr_syy({y}, {x}) AS syy, min({x}) AS lo, max({x}) AS hi)"
    )


def _fit(m: str) -> dict[str, Column]:
    """coef and p_value from a moments struct; NULL with fewer than six rows or a constant driver."""
    c = {k: F.col(f"{m}.{k}") for k in ("n", "sxx", "sxy", "syy", "lo", "hi")}
    usable = (c["n"] >= MIN_ROWS) & (c["lo"] < c["hi"])
    slope = F.when(usable, F.try_divide(c["sxy"], c["sxx"]))
    rest = F.greatest(c["syy"] - slope * c["sxy"], F.lit(0.0))
    dof = (c["n"] - 2).cast("double")
    error = F.sqrt(rest / dof / c["sxx"])
    t = F.when(error > 0, slope / error).when(slope.isNotNull() & (slope != 0), F.lit(float("inf")))
    return {"coef": slope, "p_value": F.when(usable, student_t_two_sided(t, dof))}


def _keep() -> Column:
    return F.when(F.col("p_value") < SIGNIFICANT, 1).otherwise(0)


def event_effects(sales: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(store_number, event, coef, p_value, percent_effect, keep, fiscal_duration).

    All events are aggregated side by side in one pass and only the per-store results are turned
    into rows, so the fact is not multiplied by the number of events.
    """
    known = sales.withColumn("_y", F.log1p(to_double("total_net_sales"))).where(F.col("_y").isNotNull())
    marks = known.withColumns({f"_x{i}": flag01(f).cast("double") for i, f in enumerate(flags)})
    per_store = marks.groupBy("store_number").agg(*[_moments(f"_x{i}", "_y").alias(f"m{i}") for i in range(len(flags))])
    cells = F.array(*[F.struct(F.lit(f).alias("event"), F.col(f"m{i}").alias("m")) for i, f in enumerate(flags)])
    rows = per_store.select("store_number", F.inline(cells)).withColumns(_fit("m"))
    return rows.join(history_length(known), "store_number").select(
        "store_number", "event", "coef", "p_value",
        (F.expm1("coef") * 100).alias("percent_effect"), _keep().alias("keep"), "fiscal_duration",
    )


def driver_input(sales: DataFrame, driver: str) -> DataFrame:
    """(store_number, event_date, _y, _x): log sales and the previous row's driver value."""
    source = {"advertising": "total_advertising", "delivery": "total_delivery", "food": "total_food_cost"}[driver]
    rows = sales.select(
        "store_number",
        to_day("event_date").alias("event_date"),
        to_double("total_net_sales").alias("_s"),
        to_double(source).alias("_v"),
    ).na.drop()
    now = {
        "advertising": F.col("_v") / 1000.0,
        # A share over zero sales is infinite and cuts off at 1; zero over zero is unknown.
        "delivery": clip(F.when((F.col("_s") == 0) & (F.col("_v") > 0), F.lit(1.0)).otherwise(ratio("_v", "_s")), 0.0, 1.0),
        "food": clip(ratio("_v", "_s"), 0.0, 2.0),
    }[driver]
    w = Window.partitionBy("store_number").orderBy("event_date")
    return rows.withColumn("_x", F.lag(now).over(w)).withColumn("_y", F.log1p("_s"))


def driver_effects(sales: DataFrame, driver: str) -> DataFrame:
    """(store_number, coef, p_value, <effect>, keep, fiscal_duration) of a lagged driver."""
    name, factor, _ = EFFECTS[driver]
    rows = driver_input(sales, driver)
    fitted = rows.groupBy("store_number").agg(
        _moments("_x", "_y").alias("m"), F.count_distinct("event_date").alias("fiscal_duration")
    ).withColumns(_fit("m"))
    return fitted.select(
        "store_number", "coef", "p_value", (F.col("coef") * factor).alias(name), _keep().alias("keep"), "fiscal_duration"
    )


def effect_summary(effects: DataFrame, effect: str, by: Sequence[str] = ()) -> DataFrame:
    """Stores, stores with an effect, their percentage and the median effect."""
    counts = effects.groupBy(*by).agg(
        F.count_distinct("store_number").alias("total_stores"),
        F.sum("keep").alias("stores_with_effect"),
        (F.avg("keep") * 100).alias("percent_stores_with_effect"),
    )
    median = exact_median(effects, effect, by, "median_effect")
    if by:
        return counts.join(median, list(by), "left")
    return counts.withColumn("median_effect", median.scalar())


def keep_pivot(effects: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row per store, one 0/1 column per event."""
    return effects.groupBy("store_number").pivot("event", list(flags)).agg(F.max("keep"))


def keep_flags(effects: DataFrame, driver: str) -> DataFrame:
    return effects.select("store_number", F.col("keep").alias(EFFECTS[driver][2]))


def attach_keep_flags(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """Left joins of per-store 0/1 tables; a store that was not tested keeps nothing."""
    out = df
    for t in tables:
        names = [c for c in t.columns if c != "store_number"]
        out = out.join(t, "store_number", "left").withColumns({c: F.coalesce(col(c), F.lit(0)) for c in names})
    return out


def top_stores(effects: DataFrame, effect: str, n: int = 15, ascending: bool = False) -> DataFrame:
    """Strongest significant effects, highest first or, for risks, most negative first."""
    order = F.col(effect).asc_nulls_last() if ascending else F.col(effect).desc_nulls_last()
    return effects.where("keep = 1").orderBy(order, "store_number").limit(n).select("store_number", effect)


def effect_histogram(effects: DataFrame, effect: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, stores): equal-width bins from minimum to maximum, the last one closed.

    If all effects are equal the range is widened by half a unit each way.
    """
    known = effects.where(col(effect).isNotNull())
    pad = F.when(F.min(effect) == F.max(effect), 0.5).otherwise(0.0)
    span = known.agg(F.struct((F.min(effect) - pad).alias("lo"), (F.max(effect) + pad).alias("hi"))).scalar()
    width = (F.col("_s.hi") - F.col("_s.lo")) / bins
    index = F.least(F.floor((col(effect) - F.col("_s.lo")) / width), F.lit(bins - 1))
    placed = known.withColumn("_s", span).withColumns({"bin": index.cast("int"), "_w": width})
    return placed.groupBy("bin").agg(
        F.max(F.col("_s.lo") + F.col("bin") * F.col("_w")).alias("low"),
        F.max(F.col("_s.lo") + (F.col("bin") + 1) * F.col("_w")).alias("high"),
        F.count("*").alias("stores"),
    )
