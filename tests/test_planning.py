import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillcast.config import FEATURES, SALES_LAG, ForecastConfig
from tillcast.operators import budget, dims, drivers, forecast, labor, metrics, rollups, selection
from tillcast.operators.calendar import prepare_calendar
from tillcast.operators.ridge import RidgeModel
from tillcast.sources import testbed as tb

CFG = ForecastConfig()
KEYS = "store_number string, fiscal_year int, fiscal_period int"


def model(spark):
    effects = spark.createDataFrame([("a", 10.0), ("b", 20.0)], "store_number string, effect double")
    return RidgeModel(FEATURES, 100.0, (0.5, 0.1, 0.2, 3.0, 4.0, 50.0, 60.0), 5.0, "store_number", effects)


def history(spark):
    data = [(s, dt.date(1998, 11, 1), 1998, 11, 500.0 * k, 400.0 * k, 30.0, 150.0, 0) for s, k in (("a", 1), ("b", 2))]
    return spark.createDataFrame(
        [(*r[:8], 0.0, 0.0, 0.0, r[8]) for r in data],
        f"store_number string, event_date date, fiscal_year int, fiscal_period int, total_net_sales double, {SALES_LAG} double,"
        " adv_m1 double, CPI_m1 double, p13_sin double, p13_cos double, is_5w double, `Super Bowl` int",
    )


@pytest.mark.parametrize("seed,update", [("actual", True), ("lag", True), ("lag", False)])
def test_recursion_equals_hand_loop(spark, seed, update):
    m, cal = model(spark), prepare_calendar(tb.fiscal_calendar(spark))
    grid = forecast.future_grid(history(spark), cal, CFG, 6, seed=seed)
    assert rows(grid.where("h = 3").select("fiscal_year", "fiscal_period").distinct()) == [(1999, 1)]
    assert rows(grid.where("is_5w = 1").select("h").distinct()) == [(2,)]
    got = {(r["store_number"], r["h"]): r["forecast"] for r in forecast.recursive_forecast(m, grid, CFG, update).collect()}
    want, lag = {}, {}
    for r in sorted(grid.collect(), key=lambda r: (r["store_number"], r["h"])):
        s = r["store_number"]
        prev = r[SALES_LAG] if r["h"] == 1 or not update else lag[s]
        lag[s] = m.intercept + {"a": 10.0, "b": 20.0}[s] + sum(w * (prev if f == SALES_LAG else float(r[f])) for f, w in zip(FEATURES, m.weights))
        want[(s, r["h"])] = lag[s]
    assert got == pytest.approx(want, rel=1e-12)
    step1 = grid.where("h = 1")
    one = {r["store_number"]: r["forecast"] for r in m.score(step1).collect()}
    assert one == pytest.approx({s: v for (s, h), v in want.items() if h == 1}, rel=1e-12)


def test_cpi_paths(spark):
    levels = 150 + np.cumsum(np.random.default_rng(0).normal(0.3, 0.2, 30))
    data = [("x", 2000 + i // 13, i % 13 + 1, float(v)) for i, v in enumerate(levels)] * 2
    got = {(r["scenario"], r["h"]): r for r in forecast.cpi_paths(spark.createDataFrame(data, f"{KEYS}, CPI double"), 6).collect()}
    d = np.diff(levels)
    mu, sd = d[-12:].mean(), d[-24:].std(ddof=1)
    for s, step, ads in (("Baseline_MidCPI_FlatAds", mu, 1.0), ("LowCPI_Ads-5%", max(mu - 0.5 * sd, -abs(mu)), 0.95), ("HighCPI_Ads+10%", mu + 0.5 * sd, 1.1)):
        for h in range(1, 7):
            assert got[(s, h)]["CPI"] == pytest.approx(levels[-1] + h * step)
            assert got[(s, h)]["CPI_m1"] == pytest.approx(levels[-1] + (h - 1) * step)
            assert got[(s, h)]["ad_multiplier"] == ads


def test_assignment_rule(spark):
    df = spark.createDataFrame(
        [("1", "long", 9.0, 1.0), ("2", "short", 7.0, 10.0), ("3", "short", 7.01, 10.0), ("4", "short", 7.0, None), ("5", " Short ", 1.0, 10.0), ("6", None, 1.0, 10.0)],
        "store_number string, cohort string, WAPE_model_pct double, WAPE_peer_pct double",
    )
    got = dict(rows(selection.assign_store_models(df).select("store_number", "assigned_model")))
    assert got == {"1": "pooled", "2": "pooled", "3": "peer", "4": "peer", "5": "pooled", "6": "peer"}
    with pytest.raises(KeyError):
        selection.assign_store_models(df.drop("cohort"))


def test_choose_forecast(spark):
    fc = spark.createDataFrame([("1", 2001, 1, 5.0), ("2", 2001, 1, 6.0), ("3", 2001, 1, 7.0)], f"{KEYS}, forecast double")
    peer = spark.createDataFrame([("1", 2001, 1, 50.0), ("2", 2001, 1, 60.0)], f"{KEYS}, forecast double")
    short = spark.createDataFrame([("1",), ("3",)], "store_number string")
    assert rows(selection.finalize_forecasts(fc, peer, short)) == [("1", 2001, 1, 50.0, "peer"), ("2", 2001, 1, 6.0, "model"), ("3", 2001, 1, 7.0, "model")]
    picks = spark.createDataFrame([("1", "pooled"), ("2", "peer")], "store_number string, assigned_model string")
    assert rows(selection.final_forecasts(fc, peer, picks)) == [("1", 2001, 1, 5.0, "model"), ("2", 2001, 1, 60.0, "peer"), ("3", 2001, 1, 7.0, "model")]


def test_wape_is_a_ratio_of_sums_per_group(spark):
    df = spark.createDataFrame([("x", 10.0, 9.0, 5.0), ("x", 90.0, 90.0, None), ("y", 0.0, 1.0, 1.0)], "g string, y double, a double, b double")
    got = metrics.wape_by(df, ["g"], "y", {"wa": "a", "wb": "b"})
    assert rows(got) == [("x", 0.01, 0.5), ("y", None, None)]
    assert rows(got.select(metrics.as_percent("wb"))) == [(None,), (50.0,)]
    hist = spark.createDataFrame([("1", 2001, 1, 4.0), ("1", 2001, 1, 3.0)], f"{KEYS}, actual double")
    fc = spark.createDataFrame([("1", 2001, 1, 5.0), ("1", 2001, 2, 6.0)], f"{KEYS}, forecast double")
    assert rows(metrics.join_actuals(fc, hist)) == [("1", 2001, 1, 5.0, 7.0), ("1", 2001, 2, 6.0, None)]


def test_store_error_summary_skips_undefined(spark):
    df = spark.createDataFrame([("1", 10.0, 9.0), ("2", 0.0, 1.0), ("3", 10.0, 7.0)], "store_number string, y double, f double")
    errors = metrics.store_errors(df, "y", "f")
    got = metrics.store_error_summary(errors).first()
    assert got["mean"] == pytest.approx(0.2) and got["median"] == pytest.approx(0.2)
    assert [r["store_number"] for r in metrics.worst_stores(errors, 3).collect()] == ["3", "1", "2"]


def test_rollups(spark):
    fc = spark.createDataFrame([("1", 2001, 2, 5.0, "X", "model"), ("2", 2001, 2, None, "Y", "peer"), ("1", 2001, 10, 7.0, "X", "model")], f"{KEYS}, forecast double, State string, source string")
    assert rows(rollups.by_state(fc)) == [("X", 2001, 10, 7.0, 1), ("X", 2001, 2, 5.0, 1), ("Y", 2001, 2, 0.0, 1)]
    assert rows(rollups.with_grand_total(fc)) == [(None, None, 12.0, 2), (2001, 10, 7.0, 1), (2001, 2, 5.0, 2)]
    assert rollups.period_labels(fc) == ["2001-P2", "2001-P10"]
    assert rows(rollups.state_period_pivot(fc)) == [("All States", 5.0, 7.0, 12.0), ("X", 5.0, 7.0, 12.0), ("Y", 0.0, 0.0, 0.0)]
    assert rows(rollups.by_state_source(fc)) == [("X", "model", 2, 1), ("Y", "peer", 1, 1)]
    sc = fc.withColumn("scenario", F.lit("s1"))
    assert rows(rollups.scenario_pivot(sc, ["s1", "s2"])) == [("1", "2001-P10", 7.0, None), ("1", "2001-P2", 5.0, None), ("2", "2001-P2", None, None)]


def test_budget_gap_and_proxies(spark):
    fc = spark.createDataFrame([("7", 2000, 1, 110.0), ("7", 2001, 1, 110.0), ("7", 2002, 1, 1.0), ("8", 2000, 1, 5.0)], f"{KEYS}, forecast double")
    b = spark.createDataFrame([("7.0", 2000, 1, "100"), ("8", 2000, 1, "0"), ("9", None, 1, "5")], "store_number string, year int, period_number int, total_net_sales string")
    real = budget.budget_gap(fc, b)
    assert rows(real.select("store_number", "fiscal_year", "gap_value", "gap_percent")) == [("7", 2000, 10.0, 0.1), ("7", 2001, None, None), ("7", 2002, None, None), ("8", 2000, 5.0, None)]
    assert rows(budget.unmatched_budgets(real)) == [("7", 2001, 1), ("7", 2002, 1)]
    assert rows(budget.budget_totals(real)) == [(2000, 1, 115.0, 100.0, 15.0, 2), (2001, 1, 110.0, 0.0, 0.0, 1), (2002, 1, 1.0, 0.0, 0.0, 1)]
    ext = budget.budget_gap(fc, b, proxies=True, growth=0.1)
    got = {(r["store_number"], r["fiscal_year"]): (r["budget_total_net_sales"], r["budget_source"]) for r in ext.collect()}
    assert got[("7", 2001)] == (pytest.approx(110.0), "proxy_from_2000") and got[("7", 2002)] == (None, None)
    assert got[("7", 2000)] == (100.0, "real")


def test_labor(spark):
    geo = spark.createDataFrame([("901", "1"), ("902", "2"), ("903", "3"), ("911", "1")], "Store_Number string, Heatmap_Store_Number string")
    day = lambda i: (dt.date(1995, 1, 1) + dt.timedelta(days=i)).isoformat()
    data = [("901", day(i), "A", 3.0) for i in range(26)] + [("901", day(i), "B", 1.0) for i in range(26)]
    data += [("911", day(26), "A", 4.0)]  # a second labor id of store 1
    data += [("902", day(0), "A", 0.0), ("902", day(1), "B", 0.0), ("901", "1980-01-01", "A", 50.0)]
    hours = spark.createDataFrame(data, "Store_Number string, date string, dept string, total_hours double")
    sales = spark.createDataFrame([("1", 1995, 1, 500.0), ("1", 1995, 1, 40.0), ("2", 1995, 1, 10.0)], f"{KEYS}, total_net_sales double")
    fc = spark.createDataFrame([("1", 1995, 2, 100.0), ("2", 1995, 2, 100.0), ("4", 1995, 2, 100.0)], f"{KEYS}, forecast double")
    folded = labor.dept_hours(hours, tb.fiscal_calendar(spark))
    cover = {r["store_number"]: r for r in labor.store_hours(folded).collect()}
    assert cover["901"]["coverage_days"] == 26 and cover["901"]["coverage_pct_active"] == pytest.approx(26 / 28)
    store, dept = labor.build_labor_forecasts(geo, hours, tb.fiscal_calendar(spark), sales, fc)
    # only store 1 is covered enough: 108 hours for 540 of sales; the others take the chain ratio
    assert rows(store) == [(k, 1995, 2, 100.0, pytest.approx(20.0)) for k in ("1", "2", "4")]
    got = {(r["hm_key"], r["department"]): r["hours_forecast_dept"] for r in dept.collect()}
    assert got[("1", "A")] == pytest.approx(20 * 82 / 108) and got[("1", "B")] == pytest.approx(20 * 26 / 108)
    assert got[("2", "A")] == pytest.approx(got[("1", "A")])  # no usable rows: chain shares
    assert got[("4", "Unknown")] == pytest.approx(20.0)  # no labor at all
    only = spark.createDataFrame([("1",)], "k string")
    assert rows(labor.build_labor_forecasts(geo, hours, tb.fiscal_calendar(spark), sales, fc, allowed=only)[0].select("hm_key")) == [("1",)]
    assert rows(labor.build_labor_forecasts(geo, hours, tb.fiscal_calendar(spark), sales, fc, excluded=only)[0].select("hm_key")) == [("2",), ("4",)]


def test_coverage_of_long_periods(spark):
    """A period of 90 days is two blocks of days; several ids and departments of a store share its days."""
    cal = spark.createDataFrame([(2000, 1, dt.date(2000, 1, 1), dt.date(2000, 3, 30)), (2000, 2, dt.date(2000, 3, 31), dt.date(2000, 4, 6))], "Year int, Period int, BeginningDate date, EndingDate date")
    day = lambda i: (dt.date(2000, 1, 1) + dt.timedelta(days=i)).isoformat()
    data = [("901", day(i), "A" if i % 2 else "B", 1.0) for i in range(0, 90, 2)] + [("901", day(i), "A", 1.0) for i in (0, 62, 63, 64, 65, 89)]
    data += [("911", day(i), "C", 2.0) for i in (1, 64, 67)] + [("901", day(91), "A", 5.0)]
    hours = spark.createDataFrame(data, "Store_Number string, date string, dept string, total_hours double")
    cover = {(r["store_number"], r["fiscal_period"]): r for r in labor.store_hours(labor.dept_hours(hours, cal)).collect()}
    worked = set(range(0, 90, 2)) | {0, 62, 63, 64, 65, 89}
    assert cover[("901", 1)]["coverage_days"] == len(worked) and cover[("901", 1)]["coverage_pct_active"] == pytest.approx(len(worked) / 90)
    assert cover[("901", 2)]["coverage_days"] == 1
    geo = spark.createDataFrame([("901", "1"), ("911", "1")], "Store_Number string, Heatmap_Store_Number string")
    per_dept = labor.hours_by_hm(hours, cal, dims.key_map(geo)).where("fiscal_period = 1").collect()
    assert {(r["department"], r["total_hours"]) for r in per_dept} == {("A", 6.0), ("B", 45.0), ("C", 6.0)}
    assert {(r["store_hours"], round(r["coverage_pct_active"] * 90, 6)) for r in per_dept} == {(57.0, len(worked | {1, 64, 67}))}


def test_labor_windows_hold_few_store_periods_at_a_time(spark, monkeypatch):
    """The number of parts is given; parts that follow the shuffle's bytes grow with the input."""
    monkeypatch.setattr(labor, "staged", lambda df: df)
    geo = spark.createDataFrame([("901", "1"), ("902", "2")], "Store_Number string, Heatmap_Store_Number string")
    data = [(s, f"1995-01-{d:02d}", k, 2.0) for s in ("901", "902", "1") for d in range(1, 15) for k in "AB"]
    hours = spark.createDataFrame(data, "Store_Number string, date string, dept string, total_hours double")
    depts = labor.hours_by_hm(hours, tb.fiscal_calendar(spark), dims.key_map(geo))
    assert f"{labor.PARTS}), REPARTITION_BY_NUM" in depts._jdf.queryExecution().executedPlan().toString()
    got = rows(depts.select("hm_key", "department", "total_hours", "store_hours", "coverage_pct_active"))
    assert got == [("1", "A", 56.0, 112.0, 0.5), ("1", "B", 56.0, 112.0, 0.5), ("2", "A", 28.0, 56.0, 0.5), ("2", "B", 28.0, 56.0, 0.5)]


def test_labor_with_fiscal_keys_only(spark):
    geo = spark.createDataFrame([("901", "1"), ("902", "2")], "Store_Number string, Heatmap_Store_Number string")
    data = [("901", "2000", "1", "A", 30.0), ("901", "2000", "1.0", "B", 10.0), ("902", "2000", "1", "A", 5.0), ("901", "x", "1", "A", 9.0), ("901", "1e12", "1", "A", 9.0), ("901", "2000", "1.5", "A", 9.0)]
    hours = spark.createDataFrame(data, "Store_Number string, fiscal_year string, fiscal_period string, department string, total_hours double")
    cover = labor.store_hours(labor.dept_hours(hours, None)).collect()
    assert {(r["store_number"], r["total_hours"], r["coverage_days"], r["coverage_pct_active"]) for r in cover} == {("901", 40.0, None, None), ("902", 5.0, None, None)}
    sales = spark.createDataFrame([("1", 2000, 1, 400.0), ("2", 2000, 1, 10.0)], f"{KEYS}, total_net_sales double")
    fc = spark.createDataFrame([("1", 2000, 2, 100.0), ("2", 2000, 2, 100.0)], f"{KEYS}, forecast double")
    store, dept = labor.build_labor_forecasts(geo, hours, None, sales, fc)
    assert rows(store) == [("1", 2000, 2, 100.0, pytest.approx(10.0)), ("2", 2000, 2, 100.0, pytest.approx(50.0))]
    got = {(r["hm_key"], r["department"]): r["hours_forecast_dept"] for r in dept.collect()}
    assert got[("1", "A")] == pytest.approx(7.5)
    with pytest.raises(KeyError):
        labor.dept_hours(hours.drop("fiscal_year"), None)


def test_shares_sum_to_one_even_from_nothing(spark):
    period = "hm_key string, fiscal_year int, fiscal_period int"
    data = [("1", 1, 1, "A", 6.0, 10.0), ("1", 1, 1, "B", 4.0, 10.0), ("2", 1, 1, "A", 0.0, 5.0), ("2", 1, 1, "B", 0.0, 5.0)]
    depts = spark.createDataFrame([(*r, 1.0) for r in data], f"{period}, department string, total_hours double, store_hours double, coverage_pct_active double")
    got = {(r["hm_key"], r["department"]): r["share_final"] for r in labor.department_shares(depts).collect()}
    assert got == pytest.approx({("1", "A"): 0.6, ("1", "B"): 0.4, ("2", "A"): 0.5, ("2", "B"): 0.5})


def test_labor_cost(spark):
    fc = spark.createDataFrame([("1", 2001, 1, 100.0), ("1", 2001, 2, 100.0), ("2", 2001, 1, 100.0), ("3", 2001, 1, 100.0)], f"{KEYS}, our_forecast double")
    costs = spark.createDataFrame([("1", "20", "100"), ("2", "x", "100"), ("2", "60", "100"), ("3", "5", "0")], "store_number string, total_labor_cost string, total_net_sales string")
    got = rows(labor.build_labor_cost_forecast(fc, None, costs))
    # ratios 0.2 (two rows) and 0.3; store 3 has none and takes the median over the rows: 0.2
    assert [(r[0], r[3], r[5], r[6]) for r in got] == [("1", "Unknown", 0.2, 20.0), ("1", "Unknown", 0.2, 20.0), ("2", "Unknown", 0.3, 30.0), ("3", "Unknown", 0.2, 20.0)]
    ratios = spark.createDataFrame([("1", -1.0)], "store_number string, labor_cost_ratio double")
    assert {r["labor_cost_ratio"] for r in labor.build_labor_cost_forecast(fc, ratios=ratios).collect()} == {0.0}
    with pytest.raises(ValueError):
        labor.build_labor_cost_forecast(fc)


def ols(x, y):
    n, b = len(x), np.cov(x, y, ddof=0)[0, 1] / np.var(x)
    res = y - y.mean() - b * (x - x.mean())
    se = np.sqrt(res @ res / (n - 2) / ((x - x.mean()) @ (x - x.mean())))
    return b, abs(b / se)


def test_driver_effects(spark):
    rng = np.random.default_rng(0)
    adv = rng.uniform(0, 5000, 30)
    y = np.exp(10 + 0.05 * np.r_[0, adv[:-1]] / 1000 + rng.normal(0, 0.01, 30))
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    data = [("1", d, float(s), float(a)) for d, s, a in zip(days, y, adv)]
    data += [("2", d, 10.0, 5.0) for d in days] + [("3", d, 10.0 + i, float(i)) for i, d in enumerate(days[:6])]
    df = spark.createDataFrame(data, "store_number string, event_date date, total_net_sales double, total_advertising double")
    got = {r["store_number"]: r for r in drivers.driver_effects(df, "advertising").collect()}
    b, t = ols(adv[:-1] / 1000, np.log1p(y[1:]))
    assert got["1"]["coef"] == pytest.approx(b, rel=1e-9) and got["1"]["elasticity_per_1k"] == pytest.approx(b * 100, rel=1e-9)
    assert got["1"]["keep"] == 1 and t > 10
    assert got["2"]["coef"] is None and got["2"]["keep"] == 0 and got["2"]["p_value"] is None  # driver never varies
    assert got["3"]["coef"] is None and got["3"]["fiscal_duration"] == 6  # five usable rows
    s = drivers.effect_summary(drivers.driver_effects(df, "advertising"), "elasticity_per_1k").first()
    assert (s["total_stores"], s["stores_with_effect"]) == (3, 1) and s["median_effect"] == pytest.approx(b * 100)
    assert [r[0] for r in drivers.top_stores(drivers.driver_effects(df, "advertising"), "elasticity_per_1k").collect()] == ["1"]


def test_histogram_and_keep_flags(spark):
    e = spark.createDataFrame([(str(i), float(i), 1) for i in range(11)] + [("x", None, 0)], "store_number string, e double, keep int")
    h = drivers.effect_histogram(e, "e", bins=5)
    assert [(r["bin"], r["stores"]) for r in h.orderBy("bin").collect()] == [(0, 2), (1, 2), (2, 2), (3, 2), (4, 3)]
    assert rows(drivers.effect_histogram(e.where("store_number = '3'"), "e").select("bin", "stores")) == [(10, 1)]
    base = spark.createDataFrame([("0",), ("q",)], "store_number string")
    assert rows(drivers.attach_keep_flags(base, drivers.keep_flags(e, "food"))) == [("0", 1), ("q", 0)]


def test_totals_hold_periods_that_are_not_listed(spark):
    fc = spark.createDataFrame([("A", 2000, 1, 10.0), ("A", 2000, 2, 5.0)], "State string, fiscal_year int, fiscal_period int, forecast double")
    got = {r["State"]: r for r in rollups.state_period_pivot(fc, ["2000-P1"]).collect()}
    assert (got["A"]["2000-P1"], got["A"]["Total"], got["All States"]["Total"]) == (10.0, 15.0, 15.0)
