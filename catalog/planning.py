"""Sales drivers, rollups, budget and labor."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CFG, calendar, history, period_events, query, stored_features, view
from catalog.models import STORE_PERIOD, _next6, fixed_model
from tillcast.operators import budget, dims, drivers, labor, rollups
from tillcast.operators import forecast as fc
from tillcast.operators.features import gated_measures
from tillcast.sources import testbed as tb
from tillcast.sources.staging import staged

# ---- drivers ---------------------------------------------------------------------------------

# Two-sided Student-t p-value: the finite series with its coefficients from the gamma function.
_P = """CASE WHEN v % 2 = 1
  THEN greatest(0, 1 - (th + sin(th) * coalesce(list_sum(list_transform(range(0, CAST((v - 1) // 2 AS BIGINT)), lambda k: sqrt(pi()) / 2 * exp(lgamma(k + 1) - lgamma(k + 1.5)) * cos(th) ** (2 * k + 1))), 0)) * 2 / pi())
  ELSE greatest(0, 1 - sin(th) * coalesce(list_sum(list_transform(range(0, CAST(v // 2 AS BIGINT)), lambda k: exp(lgamma(k + 0.5) - lgamma(k + 1)) / sqrt(pi()) * cos(th) ** (2 * k))), 0)) END"""


def regression_views(name: str, rows: str, keys: str) -> str:
    """View <name>: coef, p_value and keep of log1p sales on x per key."""
    view(f"{name}_m", rows, f"""
        SELECT {keys}, regr_count(y, x) AS n, regr_sxx(y, x) AS sxx, regr_sxy(y, x) AS sxy, regr_syy(y, x) AS syy, min(x) AS lo, max(x) AS hi FROM {rows} GROUP BY {keys}""")
    view(f"{name}_f", f"{name}_m", f"""
        SELECT {keys}, CASE WHEN ok THEN b END AS coef, CASE WHEN ok THEN {_P} END AS p_value FROM (
          SELECT *, atan(abs(b / sqrt(greatest(syy - b * sxy, 0) / (n - 2) / sxx)) / sqrt(n - 2)) AS th, CAST(n - 2 AS BIGINT) AS v FROM (
            SELECT *, n >= 6 AND lo < hi AS ok, sxy / nullif(sxx, 0) AS b FROM {name}_m))""")
    view(name, f"{name}_f", f"SELECT *, CASE WHEN p_value < 0.05 THEN 1 ELSE 0 END AS keep FROM {name}_f")
    return name


view("evrows", "sales evp", """
    SELECT s.store_number, event, ln(1 + sales) AS y, CAST(CASE WHEN event = 'Super Bowl' THEN coalesce(e.sb, 0) ELSE coalesce(e.te, 0) END AS DOUBLE) AS x
    FROM sales s LEFT JOIN evp e ON e.beg = s.event_date, (VALUES ('Super Bowl'), ('Thanksgiving Eve')) v(event)""")
regression_views("evfx", "evrows", "store_number, event")
view("duration", "sales", "SELECT store_number, count(DISTINCT event_date) AS fiscal_duration FROM sales GROUP BY 1")
EVENTS = ["Super Bowl", "Thanksgiving Eve"]


def _event_effects(spark, sf):
    rows = tb.sales_period(spark, sf).join(
        F.broadcast(period_events(spark).drop("fiscal_year", "fiscal_period")), "event_date", "left"
    )
    return drivers.event_effects(rows, EVENTS)


@query(
    "driver_event",
    "store_number:s event:s coef:6 p_value:6 percent_effect:4 keep:i fiscal_duration:b",
    "SELECT f.*, (exp(coef) - 1) * 100 AS percent_effect, fiscal_duration FROM evfx f JOIN duration USING (store_number)",
    "evfx duration",
)
def driver_event(spark, sf):
    return _event_effects(spark, sf)


_LAGGED = {
    "advertising": "adv / 1000",
    "delivery": "least(1, greatest(0, dlv / nullif(sales, 0)))",
    "food": "least(2, greatest(0, food / nullif(sales, 0)))",
}
for _d, _expr in _LAGGED.items():
    view(f"{_d}_rows", "salesx", f"""
        SELECT store_number, ln(1 + sales) AS y, lag({_expr}) OVER (PARTITION BY store_number ORDER BY event_date) AS x FROM salesx""")
    regression_views(f"{_d}_fx", f"{_d}_rows", "store_number")
    _name, _factor, _ = drivers.EFFECTS[_d]

    def _driver(spark, sf, d=_d):
        return drivers.driver_effects(tb.sales_period(spark, sf, extra=True), d)

    query(
        {"advertising": "driver_ads"}.get(_d, f"driver_{_d}"),
        f"store_number:s coef:8 p_value:6 {_name}:6 keep:i fiscal_duration:b",
        f"SELECT f.*, coef * {_factor} AS {_name}, fiscal_duration FROM {_d}_fx f JOIN duration USING (store_number)",
        f"{_d}_fx duration",
    )(_driver)


@query(
    "driver_summary",
    "driver:s total_stores:b stores_with_effect:b percent_stores_with_effect:4 median_effect:6",
    """SELECT event AS driver, count(DISTINCT store_number) AS total_stores, sum(keep) AS stores_with_effect, avg(keep) * 100 AS percent_stores_with_effect, median((exp(coef) - 1) * 100) AS median_effect FROM evfx GROUP BY 1
    """ + "".join(
        f" UNION ALL SELECT '{d}', count(DISTINCT store_number), sum(keep), avg(keep) * 100, median(coef * {drivers.EFFECTS[d][1]}) FROM {d}_fx" for d in _LAGGED
    ),
    "evfx " + " ".join(f"{d}_fx" for d in _LAGGED),
)
def driver_summary(spark, sf):
    ev = drivers.effect_summary(staged(_event_effects(spark, sf)), "percent_effect", ["event"]).withColumnRenamed("event", "driver")
    sales = staged(tb.sales_period(spark, sf, extra=True))
    for d in _LAGGED:
        one = drivers.effect_summary(staged(drivers.driver_effects(sales, d)), drivers.EFFECTS[d][0])
        ev = ev.unionByName(one.withColumn("driver", F.lit(d)))
    return ev


@query(
    "keep_pivot",
    "store_number:s super_bowl:i thanksgiving_eve:i",
    """SELECT store_number, max(CASE WHEN event = 'Super Bowl' THEN keep END) AS super_bowl, max(CASE WHEN event <> 'Super Bowl' THEN keep END) AS thanksgiving_eve FROM evfx GROUP BY 1""",
    "evfx",
)
def keep_pivot(spark, sf):
    wide = drivers.keep_pivot(_event_effects(spark, sf), EVENTS)
    return wide.withColumnsRenamed({"Super Bowl": "super_bowl", "Thanksgiving Eve": "thanksgiving_eve"})


@query(
    "gated_ratios",
    f"{STORE_PERIOD} Advertising_keep:i Delivery_keep:i FoodCost_keep:i adv_m1:4 deliverypct_m1:8 foodpct_m1:8",
    """SELECT s.store_number, fiscal_year, fiscal_period, coalesce(a.keep, 0) AS "Advertising_keep", coalesce(d.keep, 0) AS "Delivery_keep", coalesce(f.keep, 0) AS "FoodCost_keep",
              lag(CASE WHEN a.keep = 1 THEN adv ELSE 0 END) OVER w AS adv_m1, lag(CASE WHEN d.keep = 1 THEN dlv ELSE 0 END / nullif(sales, 0)) OVER w AS deliverypct_m1,
              lag(CASE WHEN f.keep = 1 THEN food ELSE 0 END / nullif(sales, 0)) OVER w AS foodpct_m1
       FROM salesx s LEFT JOIN advertising_fx a USING (store_number) LEFT JOIN delivery_fx d USING (store_number) LEFT JOIN food_fx f USING (store_number)
       WINDOW w AS (PARTITION BY s.store_number ORDER BY event_date)""",
    "salesx advertising_fx delivery_fx food_fx",
)
def gated_ratios(spark, sf):
    sales = staged(tb.sales_period(spark, sf, extra=True))
    flags = [drivers.keep_flags(drivers.driver_effects(sales, d), d) for d in drivers.EFFECTS]
    return gated_measures(drivers.attach_keep_flags(sales, *flags), CFG)


@query(
    "top_stores",
    "driver:s store_number:s effect:6",
    """SELECT * FROM (SELECT 'advertising' AS driver, store_number, coef * 100 AS effect FROM advertising_fx WHERE keep = 1 ORDER BY effect DESC, store_number LIMIT 15)
       UNION ALL SELECT * FROM (SELECT 'food' AS driver, store_number, coef * 5 AS effect FROM food_fx WHERE keep = 1 ORDER BY effect, store_number LIMIT 15)""",
    "advertising_fx food_fx",
)
def top_stores(spark, sf):
    """Most responsive to advertising; most sensitive to food cost."""
    sales = staged(tb.sales_period(spark, sf, extra=True))
    parts = []
    for d, ascending in (("advertising", False), ("food", True)):
        name = drivers.EFFECTS[d][0]
        top = drivers.top_stores(drivers.driver_effects(sales, d), name, 15, ascending)
        parts.append(top.select(F.lit(d).alias("driver"), "store_number", F.col(name).alias("effect")))
    return parts[0].unionByName(parts[1])


@query(
    "effect_histogram",
    "bin:i low:6 high:6 stores:b",
    """SELECT least(floor((e - lo) / ((hi - lo) / 20)), 19) AS bin, lo + least(floor((e - lo) / ((hi - lo) / 20)), 19) * (hi - lo) / 20 AS low,
              lo + (least(floor((e - lo) / ((hi - lo) / 20)), 19) + 1) * (hi - lo) / 20 AS high, count(*) AS stores
       FROM (SELECT coef * 100 AS e, min(coef * 100) OVER () AS lo, max(coef * 100) OVER () AS hi FROM advertising_fx WHERE coef IS NOT NULL) GROUP BY 1, 2, 3""",
    "advertising_fx",
)
def effect_histogram(spark, sf):
    name = drivers.EFFECTS["advertising"][0]
    return drivers.effect_histogram(staged(drivers.driver_effects(tb.sales_period(spark, sf), "advertising")), name)


# ---- rollups ---------------------------------------------------------------------------------

view("fcs", "nfc states", """
    SELECT f.*, coalesce(state, 'Unknown') AS state, CASE WHEN CAST(f.store_number AS INTEGER) % 2 = 0 THEN 'peer' ELSE 'model' END AS source
    FROM nfc f LEFT JOIN states USING (store_number)""")


def _with_state(spark, sf):
    tagged = F.when(F.col("store_number").cast("int") % 2 == 0, "peer").otherwise("model")
    return dims.attach_state(_next6(spark, sf), tb.hierarchy(spark, sf)).withColumn("source", tagged)


@query(
    "forecast_by_state",
    "State:s fiscal_year:i fiscal_period:i forecast:2 stores:b",
    'SELECT state AS "State", fiscal_year, fiscal_period, sum(forecast) AS forecast, count(DISTINCT store_number) AS stores FROM fcs GROUP BY 1, 2, 3',
    "fcs",
)
def forecast_by_state(spark, sf):
    return rollups.by_state(_with_state(spark, sf))


@query(
    "rows_by_source",
    "State:s source:s rows:b stores:b",
    'SELECT state AS "State", source, count(*) AS rows, count(DISTINCT store_number) AS stores FROM fcs GROUP BY 1, 2',
    "fcs",
)
def rows_by_source(spark, sf):
    return rollups.by_state_source(_with_state(spark, sf))


@query(
    "forecast_by_period",
    "fiscal_year:i fiscal_period:i forecast:2 stores:b",
    "SELECT fiscal_year, fiscal_period, sum(forecast) AS forecast, count(DISTINCT store_number) AS stores FROM fcs GROUP BY GROUPING SETS ((fiscal_year, fiscal_period), ())",
    "fcs",
)
def forecast_by_period(spark, sf):
    """Totals per period and, without a period, the grand total."""
    return rollups.with_grand_total(_next6(spark, sf))


@query(
    "top_state_periods",
    "State:s fiscal_year:i fiscal_period:i forecast:2 stores:b",
    """SELECT state AS "State", fiscal_year, fiscal_period, sum(forecast) AS forecast, count(DISTINCT store_number) AS stores FROM fcs GROUP BY 1, 2, 3
       ORDER BY forecast DESC, 1, 2, 3 LIMIT 15""",
    "fcs",
)
def top_state_periods(spark, sf):
    return rollups.top_state_periods(rollups.by_state(_with_state(spark, sf)))


_PERIODS = [f"2001-P{p}" for p in range(1, 14)] + [f"2002-P{p}" for p in range(1, 7)]


@query(
    "state_period_pivot",
    "State:s " + " ".join(f"{p}:2" for p in _PERIODS) + " Total:2",
    "SELECT coalesce(state, 'All States') AS \"State\", "
    + ", ".join(f"sum(CASE WHEN fiscal_year || '-P' || fiscal_period = '{p}' THEN forecast ELSE 0 END) AS \"{p}\"" for p in _PERIODS)
    + ', sum(forecast) AS "Total" FROM fcs GROUP BY GROUPING SETS ((state), ())',
    "fcs",
)
def state_period_pivot(spark, sf):
    rows = _with_state(spark, sf)
    return rollups.state_period_pivot(rows, _PERIODS)


_SCEN = [s.name for s in fc.SCENARIOS]


@query(
    "scenario_pivot",
    "store_number:s period:s baseline:3 low:3 high:3",
    "SELECT store_number, fiscal_year || '-P' || fiscal_period AS period, "
    + ", ".join(f"sum(CASE WHEN scenario = '{s}' THEN forecast END) AS {a}" for s, a in zip(_SCEN, ("baseline", "low", "high")))
    + " FROM rec_sc_r GROUP BY 1, 2",
    "rec_sc_r",
)
def scenario_pivot(spark, sf):
    from catalog.models import _cpi_rows

    feats = stored_features(spark, sf)
    grid = fc.future_grid(feats, calendar(spark), CFG)
    rows = fc.scenario_forecast(fixed_model(spark, sf, feats), grid, fc.cpi_paths(_cpi_rows(spark, sf)), CFG)
    return rollups.scenario_pivot(rows, _SCEN).withColumnsRenamed(dict(zip(_SCEN, ("baseline", "low", "high"))))


# ---- budget ----------------------------------------------------------------------------------

view("bud", "sales", "SELECT store_number, fiscal_year + 1 AS fiscal_year, fiscal_period, sales * CAST(1.03 AS DOUBLE) AS amount FROM sales WHERE fiscal_year < 2000")
# Forecasts of past and coming periods, so that some rows have a real budget, some a proxy, some none.
view("bfc", "nfc feats fx_t fx_d", """
    SELECT store_number, fiscal_year, fiscal_period, forecast FROM nfc
    UNION ALL SELECT store_number, fiscal_year, fiscal_period, sales * CAST(1.1 AS DOUBLE) FROM feats WHERE fiscal_year = 2000""")
view("gaps", "bfc bud", """
    SELECT f.store_number, f.fiscal_year, f.fiscal_period, forecast AS forecast_baseline, amount AS budget_total_net_sales, forecast - amount AS gap_value,
           CASE WHEN amount > 0 THEN (forecast - amount) / amount END AS gap_percent, 'model' AS source
    FROM bfc f LEFT JOIN bud b USING (store_number, fiscal_year, fiscal_period)""")
view("budx", "bud bfc", """
    SELECT *, 'real' AS src FROM bud UNION ALL
    SELECT store_number, fiscal_year + 1, fiscal_period, amount * CAST(1.02 AS DOUBLE), 'proxy_from_' || fiscal_year FROM bud
    WHERE fiscal_year + 1 NOT IN (SELECT fiscal_year FROM bud) AND fiscal_year + 1 IN (SELECT fiscal_year FROM bfc)""")

GAP = f"{STORE_PERIOD} forecast_baseline:2 budget_total_net_sales:6 gap_value:2 gap_percent:6"


def _budget_fc(spark, sf):
    feats = stored_features(spark, sf)
    past = feats.where("fiscal_year = 2000").select(
        "store_number", "fiscal_year", "fiscal_period", (F.col("total_net_sales") * 1.1).alias("forecast")
    )
    return staged(_next6(spark, sf, feats).drop("h").unionByName(past))


def _gaps(spark, sf):
    return budget.budget_gap(_budget_fc(spark, sf), tb.budget(spark, sf))


@query("budget_gap", f"{GAP} source:s", "SELECT * FROM gaps", "gaps")
def budget_gap(spark, sf):
    return _gaps(spark, sf)


@query(
    "budget_proxy",
    f"{GAP} budget_source:s",
    """SELECT f.store_number, f.fiscal_year, f.fiscal_period, forecast AS forecast_baseline, amount AS budget_total_net_sales, forecast - amount AS gap_value,
              (forecast - amount) / nullif(amount, 0) AS gap_percent, src AS budget_source FROM bfc f LEFT JOIN budx b USING (store_number, fiscal_year, fiscal_period)""",
    "bfc budx",
)
def budget_proxy(spark, sf):
    return budget.budget_gap(_budget_fc(spark, sf), tb.budget(spark, sf), proxies=True, growth=0.02)


@query(
    "budget_totals",
    "fiscal_year:i fiscal_period:i total_forecast:2 total_budget:2 gap_value:2 stores:b",
    """SELECT fiscal_year, fiscal_period, sum(forecast_baseline) AS total_forecast, coalesce(sum(budget_total_net_sales), 0) AS total_budget, coalesce(sum(gap_value), 0) AS gap_value,
              count(DISTINCT store_number) AS stores FROM gaps GROUP BY 1, 2""",
    "gaps",
)
def budget_totals(spark, sf):
    return budget.budget_totals(_gaps(spark, sf))


@query("top_gaps", GAP, "SELECT * FROM gaps ORDER BY fiscal_year, fiscal_period, store_number LIMIT 15", "gaps")
def top_gaps(spark, sf):
    return budget.first_gaps(_gaps(spark, sf))


@query(
    "unmatched_budgets",
    STORE_PERIOD,
    "SELECT DISTINCT store_number, fiscal_year, fiscal_period FROM gaps WHERE budget_total_net_sales IS NULL",
    "gaps",
)
def unmatched_budgets(spark, sf):
    return budget.unmatched_budgets(_gaps(spark, sf))


# ---- labor -----------------------------------------------------------------------------------

view("lday", "lines cal", """
    SELECT CAST(l_suppkey AS VARCHAR) AS hm_key, fiscal_year, fiscal_period, d, l_returnflag AS department, days, sum(l_quantity * CAST(0.1 AS DOUBLE)) AS hours
    FROM lines JOIN cal c ON d BETWEEN c.beg AND c.fin GROUP BY 1, 2, 3, 4, 5, 6""")
view("lstore", "lday", """
    SELECT hm_key, fiscal_year, fiscal_period, sum(hours) AS total_hours, count(DISTINCT d) AS coverage_days, max(days) AS days_in_period,
           least(1, count(DISTINCT d) / CAST(max(days) AS DOUBLE)) AS cov FROM lday GROUP BY 1, 2, 3""")
view("ldept", "lday", "SELECT hm_key, fiscal_year, fiscal_period, department, sum(hours) AS total_hours FROM lday GROUP BY 1, 2, 3, 4")


def labor_views(tag: str, gate: float) -> None:
    view(f"{tag}_j", "lstore sales", f"""
        SELECT *, total_hours / sales AS r FROM (
          SELECT l.hm_key, l.fiscal_year, l.fiscal_period, total_hours, cov, sales, max(cov) OVER () AS best
          FROM lstore l JOIN sales s ON s.store_number = l.hm_key AND s.fiscal_year = l.fiscal_year AND s.fiscal_period = l.fiscal_period)
        WHERE (cov >= {gate} OR best < {gate}) AND sales > 0""")
    view(f"{tag}_r", f"{tag}_j", f"SELECT hm_key, median(r) AS ratio FROM {tag}_j GROUP BY 1")
    view(f"{tag}_d", "ldept lstore", f"""
        SELECT *, dh / sh AS share FROM (
          SELECT d.hm_key, d.department, d.total_hours AS dh, l.total_hours AS sh, cov, max(cov) OVER () AS best
          FROM ldept d LEFT JOIN lstore l USING (hm_key, fiscal_year, fiscal_period))
        WHERE (cov >= {gate} OR best < {gate}) AND sh > 0 AND dh >= 0""")
    view(f"{tag}_s", f"{tag}_d lstore", f"""
        SELECT hm_key, department, CASE WHEN sum(s) OVER (PARTITION BY hm_key) > 0 THEN s / sum(s) OVER (PARTITION BY hm_key) ELSE CAST(1 AS DOUBLE) / count(*) OVER (PARTITION BY hm_key) END AS share_final
        FROM (SELECT g.hm_key, g.department, greatest(0, coalesce(a.m, c.m, 0)) AS s
              FROM (SELECT DISTINCT l.hm_key, d.department FROM lstore l, (SELECT DISTINCT department FROM {tag}_d) d) g
              LEFT JOIN (SELECT hm_key, department, median(share) AS m FROM {tag}_d GROUP BY 1, 2) a USING (hm_key, department)
              LEFT JOIN (SELECT department, median(share) AS m FROM {tag}_d GROUP BY 1) c ON c.department = g.department)""")
    view(f"{tag}_h", f"nfc {tag}_r {tag}_j", f"""
        SELECT f.store_number AS hm_key, fiscal_year, fiscal_period, forecast AS sales_forecast, forecast * greatest(0, coalesce(ratio, (SELECT median(r) FROM {tag}_j))) AS hours_forecast
        FROM nfc f LEFT JOIN {tag}_r r ON r.hm_key = f.store_number""")


labor_views("lab", 0.90)
labor_views("labg", 0.60)


def _labor(spark, sf, gate: float = labor.MIN_COVERAGE):
    sales = staged(tb.sales_period(spark, sf))
    return labor.build_labor_forecasts(
        tb.hierarchy(spark, sf), tb.labor(spark, sf), tb.fiscal_calendar(spark),
        sales, _next6(spark, sf, stored_features(spark, sf, sales)), min_coverage=gate,
    )


@query(
    "labor_coverage",
    f"{STORE_PERIOD} total_hours:4 coverage_days:b days_in_period:i coverage_pct_active:6",
    """SELECT CAST(CAST(hm_key AS BIGINT) + 1000000000000 AS VARCHAR) AS store_number, fiscal_year, fiscal_period, total_hours, coverage_days, days_in_period, cov AS coverage_pct_active FROM lstore""",
    "lstore",
)
def labor_coverage(spark, sf):
    return labor.store_hours(labor.dept_hours(tb.labor(spark, sf), tb.fiscal_calendar(spark)))


def _quarters(spark):
    """Calendar quarters as periods: 90 to 92 days."""
    return spark.range(0, 32, 1, 1).selectExpr(
        "CAST(1995 + id DIV 4 AS INT) AS Year", "CAST(id % 4 + 1 AS INT) AS Period",
        "add_months(DATE'1995-01-01', CAST(3 * id AS INT)) AS BeginningDate",
        "date_sub(add_months(DATE'1995-01-01', CAST(3 * id + 3 AS INT)), 1) AS EndingDate",
    )


@query(
    "labor_coverage_quarters",
    f"{STORE_PERIOD} total_hours:4 coverage_days:b days_in_period:i coverage_pct_active:6",
    """SELECT CAST(l_suppkey + 1000000000000 AS VARCHAR) AS store_number, year(d) AS fiscal_year, quarter(d) AS fiscal_period, sum(l_quantity * CAST(0.1 AS DOUBLE)) AS total_hours,
              count(DISTINCT d) AS coverage_days, max(n) AS days_in_period, count(DISTINCT d) / CAST(max(n) AS DOUBLE) AS coverage_pct_active
       FROM (SELECT *, date_diff('day', date_trunc('quarter', d), date_trunc('quarter', d) + INTERVAL 3 MONTH) AS n FROM lines) GROUP BY 1, 2, 3""",
    "lines",
)
def labor_coverage_quarters(spark, sf):
    """Periods longer than a block of days."""
    return labor.store_hours(labor.dept_hours(tb.labor(spark, sf), _quarters(spark)))


@query(
    "labor_ratio_keys",
    "hm_key:s ratio_store:8 ratio_chain:8",
    "SELECT hm_key, ratio AS ratio_store, (SELECT median(r) FROM lab_j) AS ratio_chain FROM lab_r",
    "lab_r lab_j",
)
def labor_ratio_keys(spark, sf):
    """Labor that carries fiscal keys and no dates: coverage is unknown and all store-periods count."""
    days = tb.daily_periods(spark).select(F.col("_day").alias("work_date"), F.col("fiscal_year").cast("string"), F.col("fiscal_period").cast("string"))
    keyed = tb.labor(spark, sf).join(F.broadcast(days), "work_date").drop("work_date")
    hours = labor.hm_totals(labor.hours_by_hm(keyed, None, dims.key_map(tb.hierarchy(spark, sf))))
    sales = tb.sales_period(spark, sf).selectExpr("store_number AS hm_key", "fiscal_year", "fiscal_period", "total_net_sales AS sales")
    per_store, chain = labor.hours_per_sales(hours, sales)
    return per_store.withColumn("ratio_chain", chain)


def _hm_hours(spark, sf):
    return labor.hours_by_hm(tb.labor(spark, sf), tb.fiscal_calendar(spark), dims.key_map(tb.hierarchy(spark, sf)))


@query(
    "labor_ratio",
    "hm_key:s ratio_store:8 ratio_chain:8",
    "SELECT hm_key, ratio AS ratio_store, (SELECT median(r) FROM lab_j) AS ratio_chain FROM lab_r",
    "lab_r lab_j",
)
def labor_ratio(spark, sf):
    """No store-period reaches 90% coverage, so all of them count."""
    hours = labor.hm_totals(_hm_hours(spark, sf))
    sales = tb.sales_period(spark, sf).selectExpr("store_number AS hm_key", "fiscal_year", "fiscal_period", "total_net_sales AS sales")
    per_store, chain = labor.hours_per_sales(hours, sales)
    return per_store.withColumn("ratio_chain", chain)


@query(
    "labor_ratio_gated",
    "hm_key:s ratio_store:8 ratio_chain:8",
    "SELECT hm_key, ratio AS ratio_store, (SELECT median(r) FROM labg_j) AS ratio_chain FROM labg_r",
    "labg_r labg_j",
)
def labor_ratio_gated(spark, sf):
    """With a lower gate only well covered store-periods count."""
    hours = labor.hm_totals(_hm_hours(spark, sf))
    sales = tb.sales_period(spark, sf).selectExpr("store_number AS hm_key", "fiscal_year", "fiscal_period", "total_net_sales AS sales")
    per_store, chain = labor.hours_per_sales(hours, sales, 0.60)
    return per_store.withColumn("ratio_chain", chain)


@query("dept_shares", "hm_key:s department:s share_final:8", "SELECT * FROM labg_s", "labg_s")
def dept_shares(spark, sf):
    return labor.department_shares(_hm_hours(spark, sf), 0.60)


HM = "hm_key:s fiscal_year:i fiscal_period:i"


@query("labor_hours", f"{HM} sales_forecast:2 hours_forecast:4", "SELECT * FROM lab_h", "lab_h")
def labor_hours(spark, sf):
    return _labor(spark, sf)[0]


@query(
    "labor_hours_dept",
    f"{HM} department:s hours_forecast_dept:4",
    "SELECT h.hm_key, fiscal_year, fiscal_period, department, hours_forecast * share_final AS hours_forecast_dept FROM lab_h h JOIN lab_s USING (hm_key)",
    "lab_h lab_s",
)
def labor_hours_dept(spark, sf):
    return _labor(spark, sf)[1]


@query(
    "labor_totals",
    "fiscal_year:i fiscal_period:i total_sales:2 total_hours:2",
    "SELECT fiscal_year, fiscal_period, sum(sales_forecast) AS total_sales, sum(hours_forecast) AS total_hours FROM lab_h GROUP BY 1, 2",
    "lab_h",
)
def labor_totals(spark, sf):
    return labor.labor_totals(_labor(spark, sf)[0])


@query(
    "labor_keys",
    f"{HM} sales_forecast:2 hours_forecast:4",
    """SELECT f.store_number AS hm_key, f.fiscal_year, f.fiscal_period, forecast AS sales_forecast, forecast * ratio AS hours_forecast
       FROM nfc f JOIN lab_r r ON r.hm_key = f.store_number WHERE f.store_number IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey < 13 AND NOT s_acctbal < 0)""",
    "nfc lab_r",
)
def labor_keys(spark, sf):
    """Only allowed stores, minus excluded ones; both lists are tables."""
    sup = tb.table(spark, sf, "supplier")
    key = F.col("s_suppkey").cast("string")
    sales = staged(tb.sales_period(spark, sf))
    return labor.build_labor_forecasts(
        tb.hierarchy(spark, sf), tb.labor(spark, sf), tb.fiscal_calendar(spark), sales, _next6(spark, sf, stored_features(spark, sf, sales)),
        allowed=sup.where("s_nationkey < 13").select(key), excluded=sup.where("s_acctbal < 0").select(key),
    )[0]


@query(
    "labor_cost",
    f"{STORE_PERIOD} State:s sales_forecast:2 labor_cost_ratio:8 pred_total_labor_cost:4",
    """SELECT store_number, fiscal_year, fiscal_period, state AS "State", forecast AS sales_forecast, coalesce(ratio, med) AS labor_cost_ratio, forecast * coalesce(ratio, med) AS pred_total_labor_cost FROM (
         SELECT f.*, ratio, median(ratio) OVER () AS med, coalesce(state, 'Unknown') AS state FROM nfc f LEFT JOIN states USING (store_number)
         LEFT JOIN (SELECT store_number, sum(labor) / sum(sales) AS ratio FROM salesx GROUP BY 1) USING (store_number))""",
    "nfc states salesx",
)
def labor_cost(spark, sf):
    costs = tb.sales_period(spark, sf, extra=True)
    return labor.build_labor_cost_forecast(_next6(spark, sf), tb.hierarchy(spark, sf), costs)


@query(
    "active_stores",
    f"{STORE_PERIOD} forecast:3",
    """SELECT store_number, fiscal_year, fiscal_period, forecast FROM nfc WHERE store_number IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey < 20)
       AND store_number NOT IN (SELECT CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0)""",
    "nfc",
)
def active_stores(spark, sf):
    known = tb.hierarchy(spark, sf).where(F.regexp_replace("State", "[^0-9]", "").cast("int") < 20)
    bad = tb.table(spark, sf, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").cast("string").alias("store_number"))
    return dims.active_stores(_next6(spark, sf), known, bad)


@query(
    "needed_budget_years",
    "fiscal_year:i store_periods:b",
    "SELECT fiscal_year, count(*) AS store_periods FROM hist WHERE fiscal_year NOT IN (SELECT fiscal_year FROM bud) GROUP BY 1",
    "hist bud",
)
def needed_budget_years(spark, sf):
    """Years with sales but no budget."""
    have = tb.budget(spark, sf).select(F.col("year").alias("fiscal_year")).distinct()
    return history(spark, sf).groupBy("fiscal_year").agg(F.count("*").alias("store_periods")).join(have, "fiscal_year", "left_anti")
