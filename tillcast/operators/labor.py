"""Labor hours, their split by department, and labor cost from sales forecasts.

Labor rows are the largest input. They are read once and folded to (store, period, department) on the
map side; that small table is staged, and everything later works on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.casts import clip, finite_sql, require, sum0, to_double, to_key
from tillcast.functions.names import normalize_forecast, normalize_labor
from tillcast.operators.calendar import daily_calendar, prepare_calendar
from tillcast.operators.dims import attach_hm_key, attach_state, keep_keys, key_map
from tillcast.operators.ranking import exact_percentiles
from tillcast.sources.staging import staged

MIN_COVERAGE = 0.90
SPREAD = 16  # parts of the department list that stores are joined with
BLOCK_DAYS = 63  # days that share the bits of one long
PARTS = 200  # of the store-periods, so that the windows over them hold little at a time
PERIOD = ["fiscal_year", "fiscal_period"]
STORE_PERIOD = ["store_number", *PERIOD]


def dept_hours(labor: DataFrame, calendar: DataFrame | None) -> DataFrame:
    """Hours per store, period and department, with the days worked as bit sets.

    The period lookup is a broadcast join in the scan stage and days are folded into longs, so the
    only shuffle of labor rows carries one partial sum per store, period and department. Periods of
    any length fit: each `BLOCK_DAYS` days are a block with a row and a bit set of its own, so a usual
    period has one. Days outside the calendar drop out. Without a calendar rows keep the fiscal keys
    they carry, and their days are unknown.
    """
    if calendar is None:
        rows = normalize_labor(labor, by_date=False).na.drop(subset=PERIOD)
        rows = rows.withColumns({"day_block": F.lit(0), "_bit": F.lit(None).cast("long"), "days_in_period": F.lit(None).cast("int")})
    else:
        cal = daily_calendar(prepare_calendar(calendar), "days_in_period", "BeginningDate")
        rows = normalize_labor(labor).join(F.broadcast(cal), "event_date")
        day = F.date_diff("event_date", "BeginningDate")
        rows = rows.withColumns({"day_block": F.floor(day / BLOCK_DAYS).cast("int"), "_bit": F.call_function("shiftleft", F.lit(1).cast("long"), day % BLOCK_DAYS)})
    return rows.groupBy(*STORE_PERIOD, "department", "day_block").agg(
        sum0("hours").alias("total_hours"),
        F.bit_or("_bit").alias("days"),
        F.max("days_in_period").alias("days_in_period"),
    )


def coverage(days: Column, length: Column) -> Column:
    """Share of a period's days that were worked; 0 if the length is unknown, NULL if the days are."""
    share = F.try_divide(days.cast("double"), length.cast("double"))
    return F.when(days.isNotNull(), F.least(F.lit(1.0), F.coalesce(share, F.lit(0.0))))


def store_hours(depts: DataFrame) -> DataFrame:
    """Hours and share of days with labor per store and period.

    Rows are placed by store and period once, for the blocks and for the sums over them.
    """
    blocks = depts.repartition(*STORE_PERIOD).groupBy(*STORE_PERIOD, "day_block").agg(
        F.sum("total_hours").alias("total_hours"), F.bit_or("days").alias("days"), F.max("days_in_period").alias("days_in_period")
    )
    whole = blocks.groupBy(*STORE_PERIOD).agg(
        F.sum("total_hours").alias("total_hours"),
        F.sum(F.bit_count("days")).alias("coverage_days"),
        F.max("days_in_period").alias("days_in_period"),
    )
    return whole.withColumn("coverage_pct_active", coverage(F.col("coverage_days"), F.col("days_in_period")))


def to_hm(df: DataFrame, mapping: DataFrame, allowed: DataFrame | None, excluded: DataFrame | None) -> DataFrame:
    return keep_keys(attach_hm_key(df, mapping), "hm_key", allowed, excluded)


def gated(df: DataFrame, min_coverage: float) -> DataFrame:
    """Rows with enough coverage; all rows if none has it or none is known."""
    best = df.agg(F.max("coverage_pct_active")).scalar()
    return df.where((F.col("coverage_pct_active") >= min_coverage) | F.coalesce(best < min_coverage, F.lit(True)))


def hours_by_hm(
    labor: DataFrame, calendar: DataFrame | None, mapping: DataFrame,
    allowed: DataFrame | None = None, excluded: DataFrame | None = None,
) -> DataFrame:
    """Staged (hm_key, period, department) hours with the store's total and coverage beside them.

    Several labor ids of one store become one, so later joins cannot fan out. Rows are placed by
    store-period once, for the fold and for the totals over it, in a given number of parts: parts of a
    size that follows the shuffle's bytes were large once their rows were unpacked.
    """
    store_period = ["hm_key", *PERIOD]
    mapped = to_hm(dept_hours(labor, calendar), mapping, allowed, excluded).repartition(PARTS, *store_period)
    folded = mapped.groupBy(*store_period, "department", "day_block").agg(
        F.sum("total_hours").alias("total_hours"),
        F.bit_or("days").alias("days"),
        F.max("days_in_period").alias("days_in_period"),
    )
    block = Window.partitionBy(*store_period, "day_block")
    whole = Window.partitionBy(*store_period)
    days = F.when(F.row_number().over(block.orderBy("department")) == 1, F.bit_count(F.bit_or("days").over(block)))
    totals = folded.withColumn("days", days).withColumns(
        {"store_hours": F.sum("total_hours").over(whole), "worked": F.sum("days").over(whole)}
    )
    per_dept = totals.groupBy(*store_period, "department").agg(
        F.sum("total_hours").alias("total_hours"),
        F.max("store_hours").alias("store_hours"),
        F.max(coverage(F.col("worked"), F.col("days_in_period"))).alias("coverage_pct_active"),
    )
    return staged(per_dept)


def hm_totals(depts: DataFrame) -> DataFrame:
    """The store totals that `hours_by_hm` repeats on every department row, once per store-period."""
    return depts.groupBy("hm_key", *PERIOD).agg(
        F.max("store_hours").alias("total_hours"), F.max("coverage_pct_active").alias("coverage_pct_active")
    )


def hours_per_sales(hours: DataFrame, sales: DataFrame, min_coverage: float = MIN_COVERAGE) -> tuple[DataFrame, Column]:
    """(store medians of hours per sales, chain ratio as a scalar column).

    The chain ratio is the median over all store-periods, total hours over total sales where that is
    not positive, and 0 without any data.
    """
    joined = staged(hours.join(sales, ["hm_key", *PERIOD]))
    rows = gated(joined, min_coverage).where(F.col("sales") > 0)
    rows = rows.withColumn("hrs_per_sales", F.col("total_hours") / F.col("sales"))
    per_store = rows.groupBy("hm_key").agg(F.median("hrs_per_sales").alias("ratio_store"))
    overall = rows.agg(F.coalesce(F.try_divide(F.sum("total_hours"), F.sum("sales")), F.lit(0.0)).alias("overall"))
    both = overall.withColumn("median", exact_percentiles(rows, "hrs_per_sales", {"m": 0.5}).scalar())
    chain = both.select(F.when(F.col("median") > 0, F.col("median")).otherwise(F.col("overall"))).scalar()
    return per_store, chain


def department_shares(depts: DataFrame, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(hm_key, department, share_final): store medians, chain medians in the gaps, summing to 1 per store.

    Every store gets every department the chain knows, so the result has stores times departments
    rows; stores whose shares sum to 0 split evenly.
    """
    usable = (F.col("store_hours") > 0) & (F.col("total_hours") >= 0)
    rows = gated(depts, min_coverage).where(usable).withColumn("share", F.col("total_hours") / F.col("store_hours"))
    per_store = rows.groupBy("hm_key", "department").agg(F.median("share").alias("share"))
    per_chain = exact_percentiles(rows, "share", {"share_chain": 0.5}, by=["department"])
    none = depts.sparkSession.range(1).where(per_store.agg(F.count("*")).scalar() == 0).select(F.lit("Unknown").alias("department"))
    names = per_store.select("department").distinct().union(none)
    spread = F.pmod(F.xxhash64("department"), F.lit(SPREAD)).cast("int")
    stores = depts.select("hm_key").distinct().withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    grid = stores.join(names.withColumn("_part", spread), "_part").select("hm_key", "department")
    # Without any department data the only department is Unknown, with all of the hours.
    chain = F.coalesce("share_chain", F.when(F.col("department") == "Unknown", F.lit(1.0)), F.lit(0.0))
    filled = (
        grid.join(per_store, ["hm_key", "department"], "left")
        .join(per_chain, "department", "left")
        .withColumn("_s", F.greatest(F.lit(0.0), F.coalesce("share", chain)))
    )
    of_store = Window.partitionBy("hm_key")
    total, count = F.sum("_s").over(of_store), F.count("*").over(of_store)
    return filled.select(
        "hm_key", "department", F.when(total > 0, F.col("_s") / total).otherwise(1.0 / count).alias("share_final")
    )


def build_labor_forecasts(
    hierarchy: DataFrame,
    labor: DataFrame,
    calendar: DataFrame | None,
    sales_history: DataFrame,
    final_fc: DataFrame,
    allowed: DataFrame | None = None,
    excluded: DataFrame | None = None,
    min_coverage: float = MIN_COVERAGE,
) -> tuple[DataFrame, DataFrame]:
    """(store hours, department hours) of the forecast periods.

    Without a calendar labor carries its own fiscal keys; coverage is then unknown and all rows count.
    """
    mapping = key_map(hierarchy)
    depts = hours_by_hm(labor, calendar, mapping, allowed, excluded)

    amount = "sales" if "sales" in sales_history.columns else "total_net_sales"
    require(sales_history, [*STORE_PERIOD, amount], "sales history")
    per_store = sales_history.groupBy(
        F.trim(F.col("store_number").cast("string")).alias("store_number"),
        *[to_key(c).alias(c) for c in PERIOD],
    ).agg(sum0(amount).alias("sales"))
    sales = to_hm(per_store, mapping, allowed, excluded).groupBy("hm_key", *PERIOD).agg(F.sum("sales").alias("sales"))

    ratios, chain = hours_per_sales(hm_totals(depts), sales, min_coverage)
    shares = department_shares(depts, min_coverage)

    fc = to_hm(normalize_forecast(final_fc), mapping, allowed, excluded)
    ratio = F.greatest(F.lit(0.0), F.coalesce("ratio_store", chain))
    store = (
        fc.withColumn("sales_forecast", F.coalesce("sales_forecast", F.lit(0.0)))
        .join(ratios, "hm_key", "left")
        .withColumn("hours_forecast", F.col("sales_forecast") * ratio)
        .select("hm_key", *PERIOD, "sales_forecast", "hours_forecast")
    )
    dept = (
        store.join(shares, "hm_key", "left")
        .withColumn("department", F.coalesce("department", F.lit("Unknown")))
        .withColumn("hours_forecast_dept", F.col("hours_forecast") * F.coalesce("share_final", F.lit(1.0)))
        .select("hm_key", *PERIOD, "department", "hours_forecast_dept")
    )
    return store, dept


def labor_totals(store: DataFrame) -> DataFrame:
    return store.groupBy(*PERIOD).agg(
        sum0("sales_forecast").alias("total_sales"), sum0("hours_forecast").alias("total_hours")
    )


def cost_ratios(costs: DataFrame) -> DataFrame:
    """Labor cost over sales per store, NULL where sales add up to 0."""
    require(costs, ["store_number", "total_labor_cost", "total_net_sales"], "labor cost source")
    sums = costs.groupBy(F.trim(F.col("store_number").cast("string")).alias("store_number")).agg(
        sum0(to_double("total_labor_cost")).alias("c"), sum0(to_double("total_net_sales")).alias("s")
    )
    return sums.select("store_number", F.expr(finite_sql("try_divide(c, s)")).alias("labor_cost_ratio"))


def build_labor_cost_forecast(
    final_fc: DataFrame,
    state_source: DataFrame | None = None,
    cost_source: DataFrame | None = None,
    ratios: DataFrame | None = None,
    allowed: DataFrame | None = None,
    excluded: DataFrame | None = None,
) -> DataFrame:
    """Forecast rows with state, cost ratio and cost.

    A store without a ratio takes the median over forecast rows, so stores weigh as often as they
    are forecast.
    """
    if ratios is None and cost_source is None:
        raise ValueError("give either ratios or a cost source")
    fc = keep_keys(normalize_forecast(final_fc).drop("State"), "store_number", allowed, excluded)
    fc = attach_state(fc, state_source) if state_source is not None else fc.withColumn("State", F.lit("Unknown"))
    if ratios is None:
        ratios = cost_ratios(cost_source)
    else:
        require(ratios, ["store_number", "labor_cost_ratio"], "labor cost ratios")
        ratios = ratios.select(
            F.trim(F.col("store_number").cast("string")).alias("store_number"),
            to_double("labor_cost_ratio").alias("labor_cost_ratio"),
        )
    joined = staged(fc.join(ratios, "store_number", "left"))
    median = exact_percentiles(joined, "labor_cost_ratio", {"m": 0.5}).scalar()
    filled = joined.withColumn("labor_cost_ratio", F.coalesce("labor_cost_ratio", median))
    kept = ["source"] if "source" in joined.columns else []
    return filled.withColumn("labor_cost_ratio", clip("labor_cost_ratio", 0.0)).select(
        *kept, *STORE_PERIOD, "State", "sales_forecast", "labor_cost_ratio",
        (F.col("sales_forecast") * F.col("labor_cost_ratio")).alias("pred_total_labor_cost"),
    )
