"""Ridge, evaluation, forecasts, scenarios, peers and model choice."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from catalog.base import (
    CFG, FEATURE_SQL, calendar, features, history, period_events, query, ridge_line, ridge_views,
    solo_ridge_views, stored_features, view,
)
from tillcast.config import FEATURES, LITE_FEATURES, retrain_needed
from tillcast.operators import forecast as fc
from tillcast.operators import forest, importance, metrics, peers, ridge, selection, splits, storewise
from tillcast.plans.run import run_forecast, run_pooled_ridge
from tillcast.sources import sinks
from tillcast.sources import testbed as tb
from tillcast.sources.staging import scratch, staged

STORE_PERIOD = "store_number:s fiscal_year:i fiscal_period:i"
FSQL = dict(zip(FEATURES, FEATURE_SQL)) | {"Thanksgiving Eve": "te"}
ALPHAS = (1, 2, 5, 10, 20)


def sql_cols(names) -> list[str]:
    return [FSQL[n] for n in names]


def term_rows(spark, terms: dict[str, float]):
    """Coefficients as rows."""
    cells = F.array(*[F.struct(F.lit(k).alias("term"), F.lit(float(v)).alias("value")) for k, v in terms.items()])
    return spark.range(1).select(F.inline(cells))


# ---- sums and fits ---------------------------------------------------------------------------

@query(
    "gram_stats",
    "store_number:s n:b m0:4 m1:4 c0_0:0 c0_1:0 c1_1:0 c2_2:6",
    """SELECT store_number, count(*) AS n, avg(sales_m1) AS m0, avg(sales) AS m1, var_pop(sales_m1) * count(*) AS c0_0, covar_pop(sales_m1, sales) * count(*) AS c0_1,
              var_pop(sales) * count(*) AS c1_1, var_pop(p13_sin) * count(*) AS c2_2 FROM feats GROUP BY 1""",
    "feats",
)
def gram_stats(spark, sf):
    """Counts, means and centred products of each store."""
    feats = features(spark, sf)
    two = ridge.store_sums(feats, [FEATURES[0]], CFG)
    sine = ridge.store_sums(feats, ["p13_sin"], CFG).selectExpr("store_number", "c0_0 AS c2_2")
    return two.join(sine, "store_number")


@query(
    "ridge_one_feature",
    "intercept:4 weight:8",
    """SELECT (syy_a - w * sx_a) / n_a AS intercept, w AS weight FROM (
         SELECT *, (sxy_a - sx_a * syy_a / n_a) / (sxx_a - sx_a * sx_a / n_a) AS w FROM (
           SELECT sum(n - k * n * n) AS n_a, sum(sx - k * n * sx) AS sx_a, sum(sy - k * n * sy) AS syy_a,
                  sum(sxy - k * sx * sy) AS sxy_a, 5 + sum(sxx - k * sx * sx) AS sxx_a
           FROM (SELECT *, CASE WHEN store_number = min(store_number) OVER () THEN 0 ELSE 1 / (n + CAST(5 AS DOUBLE)) END AS k
                 FROM (SELECT store_number, CAST(count(*) AS DOUBLE) AS n, sum(sales_m1) AS sx, sum(sales) AS sy, sum(sales_m1 * sales) AS sxy, sum(sales_m1 * sales_m1) AS sxx FROM feats GROUP BY 1))))""",
    "feats",
)
def ridge_one_feature(spark, sf):
    model = ridge.fit(stored_features(spark, sf), replace(CFG, feature_list=(FEATURES[0],)))
    return spark.range(1).select(F.lit(model.intercept).alias("intercept"), F.lit(model.weights[0]).alias("weight"))


_FULL = ridge_views("full", "feats", FEATURE_SQL, 5)


@query(
    "ridge_fit",
    "term:s value:3",
    " UNION ALL ".join(
        f"SELECT '{n}' AS term, t[{i + 1}] AS value FROM full_t" for i, n in enumerate(["(intercept)", *FEATURES])
    ),
    _FULL,
)
def ridge_fit(spark, sf):
    model = ridge.fit(stored_features(spark, sf), CFG)
    return term_rows(spark, model.coefficients())


@query(
    "store_effects",
    "store_number:s effect:3",
    "SELECT store_number, effect FROM full_d",
    _FULL,
)
def store_effects(spark, sf):
    return ridge.fit(stored_features(spark, sf), CFG).effects


@query(
    "predict",
    f"{STORE_PERIOD} forecast:3",
    f"SELECT f.store_number, fiscal_year, fiscal_period, {ridge_line('full', FEATURE_SQL)} + effect AS forecast FROM feats f JOIN full_d USING (store_number), full_t",
    f"feats {_FULL}",
)
def predict(spark, sf):
    """One-step forecasts for every observed row (no horizon), through the top-level entry point."""
    out, _, _ = run_pooled_ridge(
        tb.sales_period(spark, sf), tb.fiscal_calendar(spark), replace(CFG, min_history_train=1),
        cpi=tb.cpi_wide(spark), events=period_events(spark), horizon=None,
    )
    return out


@query(
    "predict_first_store_zero",
    f"{STORE_PERIOD} forecast:3",
    f"""SELECT f.store_number, fiscal_year, fiscal_period, {ridge_line('full', FEATURE_SQL)}
               + CASE WHEN f.store_number = (SELECT min(store_number) FROM feats WHERE store_number <> '0') THEN 0 ELSE effect END AS forecast
        FROM feats f JOIN full_d USING (store_number), full_t WHERE f.store_number <> '0'""",
    f"feats {_FULL}",
)
def predict_first_store_zero(spark, sf):
    """Scoring as with re-made dummies: the smallest store of the scored frame loses its effect."""
    feats = stored_features(spark, sf)
    return ridge.fit(feats, CFG).score(feats.where("store_number <> '0'"), first_in_frame_zero=True)


view("gated", "ranked", """
    SELECT *, CASE WHEN n >= 18 AND r > n - 6 THEN 'valid' ELSE 'train' END AS split FROM ranked WHERE n >= 12""")
_LEARN = ridge_views("learn", "gated", FEATURE_SQL, 5, "split = 'train'")


@query(
    "ridge_metrics",
    "metric:s value:6",
    f"""SELECT unnest(['stores_train', 'stores_eval', 'rows_train', 'rows_eval', 'wape_holdout', 'alpha']) AS metric,
               unnest([CAST(a AS DOUBLE), CAST(b AS DOUBLE), CAST(c AS DOUBLE), CAST(d AS DOUBLE), w, CAST(5 AS DOUBLE)]) AS value FROM (
          SELECT count(DISTINCT g.store_number) AS a, count(DISTINCT CASE WHEN split = 'valid' THEN g.store_number END) AS b,
                 count(CASE WHEN split = 'train' THEN 1 END) AS c, count(CASE WHEN split = 'valid' THEN 1 END) AS d,
                 sum(CASE WHEN split = 'valid' THEN abs(sales - ({ridge_line('learn', FEATURE_SQL)} + effect)) END) / sum(CASE WHEN split = 'valid' THEN abs(sales) END) AS w
          FROM gated g JOIN learn_d USING (store_number), learn_t)""",
    f"gated {_LEARN}",
)
def ridge_metrics(spark, sf):
    model = ridge.train(stored_features(spark, sf), CFG)
    return term_rows(spark, model.metrics).withColumnRenamed("term", "metric")


# ---- candidate comparison --------------------------------------------------------------------

view("tier", "ranked", """
    SELECT *, CASE WHEN r > n - 6 AND n >= 18 THEN 'valid' WHEN r <= n - 6 AND n >= 12 THEN 'train' END AS split FROM ranked""")
view("tier18", "ranked", "SELECT *, CASE WHEN r > n - 6 THEN 'valid' ELSE 'train' END AS split FROM ranked WHERE n >= 18")


def candidate_sql(tag: str, rows: str, cands: list[tuple[str, list[str], float]]) -> tuple[str, str]:
    """(body, views): candidate, train_wape, valid_wape for each (label, columns, alpha)."""
    parts, views = [], [rows]
    for i, (label, cols, alpha) in enumerate(cands):
        name = f"{tag}{i}"
        views.append(ridge_views(name, rows, cols, alpha, "split = 'train'"))
        err = f"abs(sales - ({ridge_line(name, cols)} + coalesce(effect, 0)))"
        parts.append(f"""SELECT '{label}' AS candidate,
            sum(CASE WHEN split = 'train' THEN {err} END) / sum(CASE WHEN split = 'train' THEN abs(sales) END) AS train_wape,
            sum(CASE WHEN split = 'valid' THEN {err} END) / sum(CASE WHEN split = 'valid' THEN abs(sales) END) AS valid_wape
            FROM {rows} x LEFT JOIN {name}_d USING (store_number), {name}_t WHERE split IS NOT NULL""")
    return " UNION ALL ".join(parts), " ".join(views)


def as_sql(cands: list[ridge.Candidate]) -> list[tuple[str, list[str], float]]:
    return [(c.name, sql_cols(c.features), c.alpha) for c in cands]


GRID = [ridge.Candidate(f"alpha={a}", FEATURES, float(a)) for a in ALPHAS]
_sql, _views = candidate_sql("grid", "tier", as_sql(GRID))


@query("alpha_grid", "candidate:s train_wape:6 valid_wape:6", _sql, _views)
def alpha_grid(spark, sf):
    return ridge.evaluate_candidates(splits.split_last_k(stored_features(spark, sf), CFG), GRID, CFG)


@query(
    "best_alpha",
    "candidate:s valid_wape:6",
    f"SELECT candidate, valid_wape FROM ({_sql}) ORDER BY valid_wape, candidate LIMIT 1",
    _views,
)
def best_alpha(spark, sf):
    errors = ridge.evaluate_candidates(splits.split_last_k(stored_features(spark, sf), CFG), GRID, CFG)
    return ridge.best_candidate(errors)


DROPS = ridge.drop_one(FEATURES)
_sql, _views = candidate_sql("drops", "tier", as_sql(DROPS))


@query(
    "drop_one",
    "candidate:s valid_wape:6 delta:6",
    f"SELECT candidate, valid_wape, valid_wape - max(CASE WHEN candidate = 'all' THEN valid_wape END) OVER () AS delta FROM ({_sql})",
    _views,
)
def drop_one(spark, sf):
    return ridge.deltas(
        ridge.evaluate_candidates(splits.split_last_k(stored_features(spark, sf), CFG), DROPS, CFG), "all"
    )


LEAN = ("total_net_sales_m1", "adv_m1", "p13_sin", "p13_cos")
ADDS = [
    ridge.Candidate("base", LEAN),
    ridge.Candidate("bowl", (*LEAN, "Super Bowl")),
    ridge.Candidate("events", (*LEAN, "Super Bowl", "Thanksgiving Eve")),
    ridge.Candidate("cpi", (*LEAN, "Super Bowl", "CPI_m1")),
    ridge.Candidate("length", (*LEAN, "Super Bowl", "CPI_m1", "is_5w")),
]
_sql, _views = candidate_sql("adds", "tier18", as_sql(ADDS))


@query(
    "add_features",
    "candidate:s train_wape:6 valid_wape:6 delta:6",
    f"SELECT *, valid_wape - max(CASE WHEN candidate = 'base' THEN valid_wape END) OVER () AS delta FROM ({_sql})",
    _views,
)
def add_features(spark, sf):
    """Events, price index and period length added to the lean features; stores with 18 rows only."""
    rows = _with_thanksgiving(spark, sf)
    split = splits.split_last_k(rows, CFG, train_min=18, valid_min=18)
    return ridge.deltas(ridge.evaluate_candidates(split, ADDS, CFG), "base")


def _with_thanksgiving(spark, sf):
    from tillcast.operators.dims import attach_event_flags

    flags = period_events(spark).select("event_date", "Thanksgiving Eve")
    return staged(attach_event_flags(features(spark, sf), flags, ["event_date"]))


WEATHER = [ridge.Candidate("base", LEAN), ridge.Candidate("weather", (*LEAN, "avg_temp"))]
view("wx", "tier18 states cal", """
    SELECT s.store_number, s.split, s.sales, s.sales_m1, s.adv_m1, s.p13_sin, s.p13_cos,
           coalesce(arg_max(CAST(50 + n.n_nationkey + (k % 12 - 6) * (6 - k % 12) * 0.75 AS DOUBLE), k), 0) AS avg_temp
    FROM tier18 s JOIN states st USING (store_number) JOIN nation n ON n.n_name = st.state JOIN cal c ON c.fiscal_year = s.fiscal_year AND c.fiscal_period = s.fiscal_period
    LEFT JOIN range(0, 84) t(k) ON last_day(make_date(1995 + k // 12, k % 12 + 1, 1)) BETWEEN c.beg AND c.fin
    GROUP BY 1, 2, 3, 4, 5, 6, 7, s.event_date""")
FSQL["avg_temp"] = "avg_temp"
_sql, _views = candidate_sql("wthr", "wx", as_sql(WEATHER))


@query("weather_test", "candidate:s train_wape:6 valid_wape:6", _sql, _views)
def weather_test(spark, sf):
    from tillcast.operators import dims

    rows = dims.attach_state(features(spark, sf), tb.hierarchy(spark, sf))
    rows = staged(dims.attach_weather(rows, dims.weather_by_period(tb.weather_wide(spark, sf), calendar(spark))))
    split = splits.split_last_k(rows, CFG, train_min=18, valid_min=18)
    return ridge.evaluate_candidates(split, WEATHER, CFG)


for _h in (6, 5):
    view(f"origin{_h}", "ranked", f"""
        SELECT *, CASE WHEN r > n - {_h} AND n >= 18 THEN 'valid' WHEN r <= n - {_h} AND n >= 12 THEN 'train' END AS split FROM ranked""")
_six, _v6 = candidate_sql("oa", "origin6", [("6", FEATURE_SQL, 5)])
_five, _v5 = candidate_sql("ob", "origin5", [("5", FEATURE_SQL, 5)])


@query(
    "origin_stability",
    "holdout:i train_wape:6 valid_wape:6 gap:6",
    f"SELECT candidate AS holdout, train_wape, valid_wape, valid_wape - train_wape AS gap FROM ({_six} UNION ALL {_five})",
    f"{_v6} {_v5}",
)
def origin_stability(spark, sf):
    rows = splits.split_origins(stored_features(spark, sf), [6, 5], CFG)
    return ridge.evaluate_origins(rows, CFG)


_STD = ridge_views("std", "feats", FEATURE_SQL, 5, standardized=True)


@query(
    "std_coefs",
    "term:s value:2",
    " UNION ALL ".join(
        f"SELECT '{n}' AS term, t[{i + 2}] * (SELECT stddev_pop({c}) FROM feats) AS value FROM std_t"
        for i, (n, c) in enumerate(zip(FEATURES, FEATURE_SQL))
    ),
    f"feats {_STD}",
)
def std_coefs(spark, sf):
    return term_rows(spark, ridge.standardized_coefficients(stored_features(spark, sf), CFG))


# ---- future rows, recursion, scenarios -------------------------------------------------------

# Literal coefficients, so the recursion is checked apart from the fit.
FIXED = dict(zip(("(intercept)", *FEATURES), (1000.0, 0.3, 0.2, 50.0, 1500.0, -800.0, 20000.0, 5000.0)))


def fixed_model(spark, sf, feats):
    effects = feats.groupBy("store_number").agg((F.avg("total_net_sales") * 0.4).alias("effect"))
    return ridge.RidgeModel(FEATURES, FIXED["(intercept)"], tuple(FIXED[f] for f in FEATURES), 5.0, "store_number", effects)


view("fx_t", "", f"SELECT [{', '.join(f'CAST({v} AS DOUBLE)' for v in FIXED.values())}] AS t")
view("fx_d", "feats", "SELECT store_number, avg(sales) * CAST(0.4 AS DOUBLE) AS effect FROM feats GROUP BY 1")
view("lastrow", "feats", "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY store_number ORDER BY event_date DESC) AS b FROM feats) WHERE b = 1")
view("grid", "lastrow cal evp", """
    SELECT l.store_number, h, CAST((l.fiscal_year * 13 + l.fiscal_period - 1 + h) // 13 AS INTEGER) AS fiscal_year,
           CAST((l.fiscal_year * 13 + l.fiscal_period - 1 + h) % 13 + 1 AS INTEGER) AS fiscal_period,
           l.sales AS actual, l.sales_m1, l.adv_m1, l.cpi_m1, c.beg AS event_date, coalesce(c.is_5w, 0) AS is_5w,
           sin(2 * pi() * ((l.fiscal_year * 13 + l.fiscal_period - 1 + h) % 13 + 1) / 13) AS p13_sin,
           cos(2 * pi() * ((l.fiscal_year * 13 + l.fiscal_period - 1 + h) % 13 + 1) / 13) AS p13_cos, coalesce(e.sb, 0) AS sb
    FROM lastrow l CROSS JOIN range(1, 7) t(h)
    LEFT JOIN cal c ON c.fiscal_year * 13 + c.fiscal_period = l.fiscal_year * 13 + l.fiscal_period + h
    LEFT JOIN evp e ON e.fiscal_year = c.fiscal_year AND e.fiscal_period = c.fiscal_period""")


@query(
    "score_fixed_coefs",
    f"{STORE_PERIOD} forecast:3",
    f"SELECT f.store_number, fiscal_year, fiscal_period, {ridge_line('fx', FEATURE_SQL)} + effect AS forecast FROM feats f JOIN fx_d USING (store_number), fx_t",
    "feats fx_t fx_d",
)
def score_fixed_coefs(spark, sf):
    feats = stored_features(spark, sf)
    return fixed_model(spark, sf, feats).score(feats)


@query(
    "next_period_rows",
    f"{STORE_PERIOD} event_date:d total_net_sales_m1:4 adv_m1:4 CPI_m1:4 p13_sin:8 p13_cos:8 is_5w:1 super_bowl:1",
    """SELECT store_number, fiscal_year, fiscal_period, event_date, sales_m1 AS total_net_sales_m1, adv_m1, cpi_m1 AS "CPI_m1", p13_sin, p13_cos, is_5w, 0 AS super_bowl FROM grid WHERE h = 1""",
    "grid",
)
def next_period_rows(spark, sf):
    rows = fc.next_period_rows(features(spark, sf), calendar(spark), CFG, seed="lag")
    return rows.withColumnRenamed("Super Bowl", "super_bowl")


@query(
    "future_grid",
    f"{STORE_PERIOD} h:i total_net_sales_m1:4 adv_m1:4 CPI_m1:4 p13_sin:8 is_5w:1 super_bowl:1",
    """SELECT store_number, fiscal_year, fiscal_period, h, actual AS total_net_sales_m1, adv_m1, cpi_m1 AS "CPI_m1", p13_sin, is_5w, sb AS super_bowl FROM grid""",
    "grid",
)
def future_grid(spark, sf):
    """Six steps per store from the last actual, with known future events joined in."""
    rows = fc.future_grid(features(spark, sf), calendar(spark), CFG, events=period_events(spark))
    return rows.withColumnRenamed("Super Bowl", "super_bowl")


def recursion_sql(tag: str, model: str, seed: str, update: bool, grid: str = "grid", by: str = "") -> tuple[str, str]:
    """(body, views): forecasts of the recursion on `grid`; `by` is an extra key column."""
    base = ridge_line(model, FEATURE_SQL, ("sales_m1", "sb"))
    extra = f", g.{by}" if by else ""
    view(f"{tag}_b", f"{grid} {model}_t {model}_d", f"""
        SELECT g.store_number{extra}, h, fiscal_year, fiscal_period, {base} + coalesce(effect, 0) AS base, t[2] AS w, {seed} AS seed
        FROM {grid} g LEFT JOIN {model}_d USING (store_number), {model}_t""")
    lag = "r.forecast" if update else "b.seed"
    same = f" AND b.{by} = r.{by}" if by else ""
    cols = f"b.store_number{f', b.{by}' if by else ''}, b.h, b.fiscal_year, b.fiscal_period"
    view(f"{tag}_r", f"{tag}_b", f"""
        SELECT {cols}, base + w * seed AS forecast FROM {tag}_b b WHERE h = 1 UNION ALL
        SELECT {cols}, b.base + b.w * {lag} FROM {tag}_r r JOIN {tag}_b b ON b.store_number = r.store_number AND b.h = r.h + 1{same}""")
    return f"SELECT * FROM {tag}_r", f"{tag}_r"


for _name, _seed, _update in (("actual", "actual", True), ("stale", "lag", True), ("frozen", "lag", False)):
    _sql, _views = recursion_sql(f"rec_{_name}", "fx", "actual" if _seed == "actual" else "sales_m1", _update)

    def _recursive(spark, sf, seed=_seed, update=_update):
        feats = stored_features(spark, sf)
        grid = fc.future_grid(feats, calendar(spark), CFG, seed=seed)
        return fc.recursive_forecast(fixed_model(spark, sf, feats), grid, CFG, update)

    query(f"recursive_fixed_{_name}", f"{STORE_PERIOD} h:i forecast:3", _sql, _views)(_recursive)

_FINAL = ridge_views("final", "gated", FEATURE_SQL, 5)
_sql, _views = recursion_sql("rec_fit", "final", "actual", True)


@query("forecast_h6", f"{STORE_PERIOD} h:i forecast:3", _sql, _views)
def forecast_h6(spark, sf):
    """The whole run: features, gated fit, six recursive periods ahead."""
    out, _, _ = run_pooled_ridge(
        tb.sales_period(spark, sf), tb.fiscal_calendar(spark), CFG,
        cpi=tb.cpi_wide(spark), events=period_events(spark), horizon=6,
    )
    return out


@query(
    "model_round_trip",
    f"{STORE_PERIOD} forecast:3",
    f"SELECT f.store_number, fiscal_year, fiscal_period, {ridge_line('final', FEATURE_SQL)} + coalesce(effect, 0) AS forecast FROM feats f LEFT JOIN final_d USING (store_number), final_t",
    f"feats {_FINAL}",
)
def model_round_trip(spark, sf):
    """A model that was saved and loaded scores like the fitted one."""
    feats, path = stored_features(spark, sf), scratch(spark, "model")
    sinks.save_model(spark, ridge.train(feats, CFG), CFG, path)
    model, cfg = sinks.load_model(spark, path)
    if retrain_needed(cfg, CFG):
        raise ValueError("the saved configuration differs")
    return model.score(feats)


_LITE = ridge_views("lite", "gated", sql_cols(LITE_FEATURES), 5)


@query(
    "lite_forecast",
    f"{STORE_PERIOD} forecast:3",
    f"SELECT f.store_number, fiscal_year, fiscal_period, {ridge_line('lite', sql_cols(LITE_FEATURES))} + coalesce(effect, 0) AS forecast FROM feats f LEFT JOIN lite_d USING (store_number), lite_t",
    f"feats {_LITE}",
)
def lite_forecast(spark, sf):
    """Without events and price index the run uses the short feature list."""
    cfg = replace(CFG, feature_list=LITE_FEATURES)
    out, _, _ = run_pooled_ridge(tb.sales_period(spark, sf), tb.fiscal_calendar(spark), cfg, horizon=None)
    return out


view("cpih", "feats0", """
    SELECT *, cpi - lag(cpi) OVER (ORDER BY fiscal_year, fiscal_period) AS d, row_number() OVER (ORDER BY fiscal_year DESC, fiscal_period DESC) AS b
    FROM (SELECT fiscal_year, fiscal_period, max(cpi) AS cpi FROM feats0 WHERE cpi IS NOT NULL GROUP BY 1, 2)""")
view("cpis", "cpih", """
    SELECT avg(CASE WHEN b <= 12 THEN d END) AS mu, stddev_samp(CASE WHEN b <= 24 THEN d END) AS sigma, max(CASE WHEN b = 1 THEN cpi END) AS last_cpi FROM cpih""")
view("paths", "cpis", """
    SELECT scenario, h, last_cpi + h * step AS cpi, last_cpi + (h - 1) * step AS cpi_m1, ads FROM (
      SELECT last_cpi, unnest(['Baseline_MidCPI_FlatAds', 'LowCPI_Ads-5%', 'HighCPI_Ads+10%']) AS scenario,
             unnest([mu, greatest(mu - 0.5 * sigma, -abs(mu)), mu + 0.5 * sigma]) AS step, unnest([1.0, 0.95, 1.10]) AS ads FROM cpis), range(1, 7) t(h)""")
view("sgrid", "grid paths", """
    SELECT g.store_number, p.scenario, g.h, fiscal_year, fiscal_period, actual, g.sales_m1, CAST(g.adv_m1 * p.ads AS DOUBLE) AS adv_m1, p.cpi_m1, is_5w, p13_sin, p13_cos, 0 AS sb
    FROM grid g JOIN paths p ON p.h = g.h""")


def _cpi_rows(spark, sf):
    from tillcast.operators.dims import cpi_by_period

    cpi = cpi_by_period(tb.cpi_wide(spark), calendar(spark))
    periods = history(spark, sf).select("fiscal_year", "fiscal_period").distinct()
    return periods.join(F.broadcast(cpi), ["fiscal_year", "fiscal_period"])


@query("cpi_paths", "scenario:s h:i CPI:6 CPI_m1:6 ad_multiplier:2", 'SELECT scenario, h, cpi AS "CPI", cpi_m1 AS "CPI_m1", ads AS ad_multiplier FROM paths', "paths")
def cpi_paths(spark, sf):
    return fc.cpi_paths(_cpi_rows(spark, sf))


_sql, _views = recursion_sql("rec_sc", "fx", "actual", True, "sgrid", "scenario")


@query("scenario_forecast_fixed", f"{STORE_PERIOD} scenario:s h:i forecast:3", _sql, _views)
def scenario_forecast_fixed(spark, sf):
    feats = stored_features(spark, sf)
    grid = fc.future_grid(feats, calendar(spark), CFG)
    return fc.scenario_forecast(fixed_model(spark, sf, feats), grid, fc.cpi_paths(_cpi_rows(spark, sf)), CFG)


# The research run: penalty 20, no gate on training history, forecasts for stores with 18 rows or more.
_FREE = ridge_views("free", "ranked", FEATURE_SQL, 20, "r <= n - 6")
view("sgrid18", "sgrid ranked", "SELECT g.* FROM sgrid g SEMI JOIN (SELECT store_number FROM ranked WHERE n >= 18) k USING (store_number)")
_sql, _views = recursion_sql("rec_free", "free", "actual", True, "sgrid18", "scenario")


@query("scenario_forecast", f"{STORE_PERIOD} scenario:s h:i forecast:3", _sql, _views)
def scenario_forecast(spark, sf):
    feats = stored_features(spark, sf)
    train = splits.split_last_k(feats, CFG, train_min=0).where("split = 'train'")
    model = ridge.fit(train, replace(CFG, alpha=20.0))
    grid = fc.future_grid(feats, calendar(spark), CFG, min_rows=18)
    return fc.scenario_forecast(model, grid, fc.cpi_paths(_cpi_rows(spark, sf)), CFG)


# ---- diagnostics -----------------------------------------------------------------------------

view("vrows", "tier fx_t fx_d", f"""
    SELECT v.*, {ridge_line('fx', FEATURE_SQL)} + effect AS yhat FROM tier v JOIN fx_d USING (store_number), fx_t WHERE split = 'valid'""")
view("vreps", "vrows", "SELECT *, store_number || '|' || fiscal_year || '|' || fiscal_period AS id FROM vrows, range(1, 4) t(rep)")
view("vplace", "vreps", """
    SELECT *, row_number() OVER (PARTITION BY rep ORDER BY md5('place' || rep || '|' || id)) AS p,
           row_number() OVER (PARTITION BY rep ORDER BY md5('donor' || rep || '|' || id)) AS q FROM vreps""")


@query(
    "permutation_importance",
    "feature:s mae_increase:3 wape_increase:6",
    "SELECT feature, avg(mae) AS mae_increase, avg(wape) AS wape_increase FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS feature, a.rep, avg(abs(a.sales - a.yhat - ({FIXED[n]}) * (b.{c} - a.{c}))) - avg(abs(a.sales - a.yhat)) AS mae,
            (sum(abs(a.sales - a.yhat - ({FIXED[n]}) * (b.{c} - a.{c}))) - sum(abs(a.sales - a.yhat))) / sum(abs(a.sales)) AS wape
            FROM vplace a JOIN vplace b ON a.rep = b.rep AND a.p = b.q GROUP BY a.rep"""
        for n, c in zip(FEATURES, FEATURE_SQL)
    )
    + ") GROUP BY 1",
    "vplace",
)
def permutation_importance(spark, sf):
    feats = stored_features(spark, sf)
    valid = splits.split_last_k(feats, CFG).where("split = 'valid'")
    return importance.top_features(importance.permutation_importance(fixed_model(spark, sf, feats), valid, CFG, repeats=3))


@query("random_forest", "split:s wape:6 rows:b")
def random_forest(spark, sf):
    split = splits.split_last_k(stored_features(spark, sf), CFG)
    return forest.forest_errors(forest.fit_forest(split, CFG))


@query("random_forest_importance", "feature:s mae_increase:3")
def random_forest_importance(spark, sf):
    split = splits.split_last_k(stored_features(spark, sf), CFG)
    return forest.forest_importance(split, CFG)


_TREE_X = ", ".join([f"coalesce({c}, 0)" for c in FEATURE_SQL] + ["avg(sales) OVER (PARTITION BY store_number)"])
view("tree_x", "ranked", f"""
    SELECT row_number() OVER () AS row, sales AS y, [{_TREE_X}] AS x FROM ranked WHERE r <= n - 6 AND n >= 12""")
view("tree_c", "tree_x", f"SELECT f, quantile_cont(x[f], [{', '.join(repr(i / 8) for i in range(1, 8))}]) AS c FROM tree_x, range(1, {len(FEATURE_SQL) + 2}) t(f) GROUP BY f")
view("tree_b0", "tree_x tree_c", "SELECT row, y, f, len(list_filter(c, lambda v: v < x[f])) AS b, 1 AS node FROM tree_x, tree_c")
for _l in range(4):
    _fits = "nl >= 4 AND n - nl >= 4" if _l < 3 else "FALSE"
    view(f"tree_h{_l}", f"tree_b{_l} tree_c", f"""
        SELECT node, n, t / n AS mean, CASE WHEN gain > 0 THEN f END AS f, CASE WHEN gain > 0 THEN b END AS b, CASE WHEN gain > 0 THEN gain END AS gain, CASE WHEN gain > 0 THEN c[b + 1] END AS threshold
        FROM (SELECT *, CASE WHEN {_fits} THEN round((sl * sl / nl + (t - sl) * (t - sl) / nullif(n - nl, 0) - t * t / n) / nullif(tq - t * t / n, 0), 9) END AS gain FROM (
            SELECT *, sum(cnt) OVER w AS nl, sum(s) OVER w AS sl, sum(cnt) OVER v AS n, sum(s) OVER v AS t, sum(q) OVER v AS tq
            FROM (SELECT node, f, b, count(*) AS cnt, sum(y) AS s, sum(y * y) AS q FROM tree_b{_l} WHERE node IS NOT NULL GROUP BY 1, 2, 3)
            WINDOW w AS (PARTITION BY node, f ORDER BY b ROWS UNBOUNDED PRECEDING), v AS (PARTITION BY node, f))) JOIN tree_c USING (f)
        QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC NULLS LAST, f, b) = 1""")
    if _l < 3:
        view(f"tree_b{_l + 1}", f"tree_b{_l} tree_h{_l}", f"""
            SELECT t.row, y, t.f, t.b, CASE WHEN h.f IS NOT NULL THEN 2 * t.node + CASE WHEN o.b <= h.b THEN 0 ELSE 1 END END AS node
            FROM tree_b{_l} t LEFT JOIN tree_h{_l} h ON h.node = t.node LEFT JOIN (SELECT row, f, b FROM tree_b{_l}) o ON o.row = t.row AND o.f = h.f""")


@query(
    "tree_splits",
    "node:i n:b mean:2 feature:s threshold:4 gain:6",
    f"""SELECT node, n, mean, ([{', '.join(repr(f) for f in (*FEATURES, 'store mean'))}])[f] AS feature, threshold, gain
        FROM ({' UNION ALL '.join(f'SELECT * FROM tree_h{i}' for i in range(4))})""",
    "tree_h0 tree_h1 tree_h2 tree_h3",
)
def tree_splits(spark, sf):
    """One tree of depth 3 on all training rows of the forest's design."""
    return forest.tree_table(splits.split_last_k(stored_features(spark, sf), CFG), CFG)


_SOLO = solo_ridge_views("solo", "tier18", FEATURE_SQL, 5, "split = 'train'")
_SOLO_ERRORS = f"""SELECT store_number, sum(abs(sales - ({ridge_line('solo', FEATURE_SQL)}))) / sum(abs(sales)) AS wape,
    avg(abs(sales - ({ridge_line('solo', FEATURE_SQL)}))) AS mae, avg(sales) AS mean_actual_sales
    FROM tier18 JOIN solo_t USING (store_number) WHERE split = 'valid' GROUP BY 1"""


@query("per_store_ridge", "store_number:s wape:6 mae:2 mean_actual_sales:1", _SOLO_ERRORS, f"tier18 {_SOLO}")
def per_store_ridge(spark, sf):
    return storewise.store_ridge_errors(stored_features(spark, sf), CFG)


@query(
    "per_store_ridge_summary",
    "p10:6 median:6 p90:6 mean:6",
    f"SELECT quantile_cont(wape, 0.1) AS p10, quantile_cont(wape, 0.5) AS median, quantile_cont(wape, 0.9) AS p90, avg(wape) AS mean FROM ({_SOLO_ERRORS})",
    f"tier18 {_SOLO}",
)
def per_store_ridge_summary(spark, sf):
    return metrics.store_error_summary(staged(storewise.store_ridge_errors(stored_features(spark, sf), CFG)))


# ---- peers and choice ------------------------------------------------------------------------

_P = range(1, 5)


def _power_views(name: str, matrix: str) -> None:
    """View <name>: leading eigenvector v (first entry not negative) and eigenvalue of a 4 x 4 matrix, by squaring it 16 times."""
    cell = "list_sum(list_transform(range(1, 5), lambda c: m[a][c] * m[c][b]))"
    trace = "list_sum(list_transform(range(1, 5), lambda a: list_sum(list_transform(range(1, 5), lambda c: m[a][c] * m[a][c]))))"
    view(f"{name}_p", matrix, f"""
        SELECT 0 AS i, m FROM {matrix} UNION ALL
        SELECT i + 1, list_transform(range(1, 5), lambda a: list_transform(range(1, 5), lambda b: {cell} / {trace})) FROM {name}_p WHERE i < 16""")
    view(name, f"{name}_p", f"""
        SELECT v, list_sum(list_transform(range(1, 5), lambda a: list_sum(list_transform(range(1, 5), lambda b: v[a] * k.m[a][b] * v[b])))) AS e, k.m
        FROM (SELECT list_transform(range(1, 5), lambda a: m[a][1] / sqrt(m[1][1])) AS v FROM {name}_p WHERE i = 16), {matrix} k""")


view("prof", "hist", """
    SELECT store_number, avg(actual) AS p1, stddev_samp(actual) AS p2, stddev_samp(actual) / nullif(avg(actual), 0) AS p3, ln(1 + avg(actual)) AS p4
    FROM hist GROUP BY 1 HAVING stddev_samp(actual) / nullif(avg(actual), 0) IS NOT NULL""")
view("profz", "prof", f"SELECT store_number, [{', '.join(f'(p{i} - avg(p{i}) OVER ()) / stddev_samp(p{i}) OVER ()' for i in _P)}] AS z FROM prof")
view("corm", "profz", """
    SELECT list(r ORDER BY j) AS m FROM (SELECT j, list(v ORDER BY k) AS r FROM (
        SELECT j, k, sum(z[j] * z[k]) / (count(*) - 1) AS v FROM profz, range(1, 5) a(j), range(1, 5) b(k) GROUP BY j, k) GROUP BY j)""")
_power_views("comp1", "corm")
view("corm2", "comp1", "SELECT list_transform(range(1, 5), lambda a: list_transform(range(1, 5), lambda b: m[a][b] - e * v[a] * v[b])) AS m FROM comp1")
_power_views("comp2", "corm2")
view("scores", "profz comp1 comp2", f"""
    SELECT store_number, {' + '.join(f'z[{i}] * comp1.v[{i}]' for i in _P)} AS pc1, {' + '.join(f'z[{i}] * comp2.v[{i}]' for i in _P)} AS pc2
    FROM profz, comp1, comp2""")
view("centre0", "scores", f"""
    SELECT unnest([0, 1, 2]) AS i, unnest(quantile_cont(pc1, [{0.5 / 3!r}, {1.5 / 3!r}, {2.5 / 3!r}])) AS x, CAST(0 AS DOUBLE) AS y FROM scores""")
for _r in range(7):
    view(f"near{_r}", f"scores centre{_r}", f"""
        SELECT store_number, pc1, pc2, i FROM scores, centre{_r}
        QUALIFY row_number() OVER (PARTITION BY store_number ORDER BY (pc1 - x) * (pc1 - x) + (pc2 - y) * (pc2 - y), i) = 1""")
    if _r < 6:
        view(f"centre{_r + 1}", f"near{_r}", f"""
            SELECT c.i, coalesce(avg(pc1), any_value(x)) AS x, coalesce(avg(pc2), any_value(y)) AS y
            FROM centre{_r} c LEFT JOIN near{_r} n ON n.i = c.i GROUP BY c.i""")
view("clusters", "near6", """
    SELECT store_number, pc1, pc2, CAST(place AS INTEGER) AS cluster
    FROM near6 JOIN (SELECT i, row_number() OVER (ORDER BY x, y, i) - 1 AS place FROM centre6) USING (i)""")
view("peers", "clusters cohorts", """
    SELECT store_number, CAST(r AS INTEGER) AS peer_rank, peer FROM (
      SELECT s.store_number, l.store_number AS peer,
             row_number() OVER (PARTITION BY s.store_number ORDER BY (l.pc1 - s.pc1) * (l.pc1 - s.pc1) + (l.pc2 - s.pc2) * (l.pc2 - s.pc2), l.store_number) AS r
      FROM clusters s JOIN clusters l ON l.cluster = s.cluster JOIN cohorts cs ON cs.store_number = s.store_number AND cs.cohort = 'short'
      JOIN cohorts cl ON cl.store_number = l.store_number AND cl.cohort = 'long') WHERE r <= 3""")


def _clusters(hist):
    return peers.locked_clusters(peers.pca_scores(peers.store_profile(hist)))


@query("store_clusters", "store_number:s pc1:4 pc2:4 cluster:i", "SELECT * FROM clusters", "clusters")
def store_clusters(spark, sf):
    return _clusters(history(spark, sf))


def _peers(hist):
    """Each short store's peers: profile, components, clusters, nearest long stores of the cluster."""
    return peers.nearest_peers(_clusters(hist), splits.history_cohorts(hist, tb.SHORT_BELOW))


@query("peers_long", "store_number:s peer_rank:i peer:s", "SELECT * FROM peers", "peers")
def peers_long(spark, sf):
    return peers.peers_long(peers.peers_wide(_peers(staged(history(spark, sf)))))


@query(
    "early_mean",
    "store_number:s early_mean:2",
    """SELECT store_number, avg(actual) AS early_mean FROM (SELECT *, row_number() OVER (PARTITION BY store_number ORDER BY fiscal_year, fiscal_period) AS r FROM hist) WHERE r <= 10 GROUP BY 1""",
    "hist",
)
def early_mean(spark, sf):
    return peers.early_mean(history(spark, sf))


view("early", "hist", """SELECT store_number, avg(actual) AS m FROM (SELECT *, row_number() OVER (PARTITION BY store_number ORDER BY fiscal_year, fiscal_period) AS r FROM hist) WHERE r <= 10 GROUP BY 1""")
_nxt, _nv = recursion_sql("nxt", "final", "actual", True)
view("nfc", _nv, f"SELECT store_number, fiscal_year, fiscal_period, forecast FROM ({_nxt})")
view("scale", "peers early", """
    SELECT p.store_number, e.m / avg(pe.m) AS scale FROM peers p JOIN early pe ON pe.store_number = p.peer JOIN early e ON e.store_number = p.store_number GROUP BY 1, e.m HAVING avg(pe.m) <> 0""")
view("naxis", "nfc", "SELECT DISTINCT fiscal_year, fiscal_period FROM nfc ORDER BY fiscal_year DESC, fiscal_period DESC LIMIT 6")
view("peerfc", "nfc scale peers naxis", """
    SELECT p.store_number, f.fiscal_year, f.fiscal_period, max(scale) * avg(f.forecast) AS forecast
    FROM peers p JOIN (SELECT * FROM nfc SEMI JOIN naxis USING (fiscal_year, fiscal_period)) f ON f.store_number = p.peer JOIN scale s ON s.store_number = p.store_number GROUP BY 1, 2, 3""")


def _next6(spark, sf, feats=None):
    """Six periods ahead by the fitted model."""
    feats = stored_features(spark, sf) if feats is None else feats
    return fc.recursive_forecast(ridge.train(feats, CFG), fc.future_grid(feats, calendar(spark), CFG), CFG)


def _peer_fc(hist, rows, near=None):
    return peers.peer_scaled_forecast(hist, rows, _peers(hist) if near is None else near, splits.last_axis(rows))


@query("peer_scaled_forecast", f"{STORE_PERIOD} forecast:2 source:s", "SELECT *, 'peer' AS source FROM peerfc", "peerfc")
def peer_scaled_forecast(spark, sf):
    sales = staged(tb.sales_period(spark, sf))
    return _peer_fc(staged(history(spark, sf, sales)), staged(_next6(spark, sf, stored_features(spark, sf, sales))))


@query(
    "finalize_forecasts",
    f"{STORE_PERIOD} forecast:2 source:s",
    """SELECT f.store_number, f.fiscal_year, f.fiscal_period, coalesce(CASE WHEN cohort = 'short' THEN p.forecast END, f.forecast) AS forecast,
              CASE WHEN cohort = 'short' AND p.forecast IS NOT NULL THEN 'peer' ELSE 'model' END AS source
       FROM nfc f LEFT JOIN peerfc p USING (store_number, fiscal_year, fiscal_period) LEFT JOIN cohorts c ON c.store_number = f.store_number""",
    "nfc peerfc cohorts",
)
def finalize_forecasts(spark, sf):
    sales = staged(tb.sales_period(spark, sf))
    rows, hist = staged(_next6(spark, sf, stored_features(spark, sf, sales))), staged(history(spark, sf, sales))
    short = splits.history_cohorts(hist, tb.SHORT_BELOW).where("cohort = 'short'")
    return selection.finalize_forecasts(rows, _peer_fc(hist, rows), short)


view("offaxis", "feats axis", "SELECT f.* FROM feats f ANTI JOIN axis USING (fiscal_year, fiscal_period)")
_OOS = ridge_views("oos", "offaxis", FEATURE_SQL, 5)
view("pooled", f"feats axis {_OOS}", f"""
    SELECT f.store_number, f.fiscal_year, f.fiscal_period, {ridge_line('oos', FEATURE_SQL)} + coalesce(effect, 0) AS yhat_pooled
    FROM feats f SEMI JOIN axis USING (fiscal_year, fiscal_period) LEFT JOIN oos_d USING (store_number), oos_t""")
view("ohp", "pooled peers scale cohorts", """
    SELECT p.store_number, f.fiscal_year, f.fiscal_period, max(scale) * avg(f.yhat_pooled) AS yhat_peer
    FROM peers p JOIN pooled f ON f.store_number = p.peer JOIN scale s ON s.store_number = p.store_number GROUP BY 1, 2, 3""")
view("evalh", "hist axis pooled ohp cohorts", """
    SELECT h.store_number, h.fiscal_year, h.fiscal_period, h.fiscal_year || '-' || h.fiscal_period AS label, actual, yhat_pooled, yhat_peer, cohort, n_hist_periods,
           count(*) OVER (PARTITION BY h.store_number) AS n_eval_periods
    FROM hist h SEMI JOIN axis USING (fiscal_year, fiscal_period) LEFT JOIN pooled USING (store_number, fiscal_year, fiscal_period)
    LEFT JOIN ohp USING (store_number, fiscal_year, fiscal_period) LEFT JOIN cohorts c ON c.store_number = h.store_number""")


def _eval_hist(spark, sf):
    sales = staged(tb.sales_period(spark, sf))
    hist = staged(history(spark, sf, sales))
    return selection.backtest(stored_features(spark, sf, sales), hist, staged(_peers(hist)), CFG, short_below=tb.SHORT_BELOW)


@query(
    "oos_eval_assembly",
    f"{STORE_PERIOD} label:s actual:4 yhat_pooled:2 yhat_peer:2 cohort:s n_hist_periods:b n_eval_periods:b",
    "SELECT * FROM evalh",
    "evalh",
)
def oos_eval_assembly(spark, sf):
    return _eval_hist(spark, sf)


_W = "sum(CASE WHEN yhat_{0} IS NOT NULL THEN abs(actual - yhat_{0}) END) / nullif(sum(CASE WHEN yhat_{0} IS NOT NULL THEN abs(actual) END), 0) AS wape_{0}"


@query(
    "wape_by_group",
    "cohort:s State:s wape_pooled:6 wape_peer:6",
    f"""SELECT cohort, state AS "State", {_W.format('pooled')}, {_W.format('peer')} FROM evalh JOIN states USING (store_number) GROUP BY GROUPING SETS ((cohort), (state), ())""",
    "evalh states",
)
def wape_by_group(spark, sf):
    """Errors by cohort, by state and overall from one set of sums."""
    from tillcast.functions.stats import wape
    from tillcast.operators.dims import attach_state

    rows = attach_state(_eval_hist(spark, sf), tb.hierarchy(spark, sf)).select("cohort", "State", "actual", "yhat_pooled", "yhat_peer")
    sets = [[F.col("cohort")], [F.col("State")], []]
    return rows.groupingSets(sets, "cohort", "State").agg(
        wape("actual", "yhat_pooled").alias("wape_pooled"), wape("actual", "yhat_peer").alias("wape_peer")
    )


@query(
    "wape_percentiles",
    "p10:6 median:6 p90:6 mean:6",
    f"""SELECT quantile_cont(w, 0.1) AS p10, quantile_cont(w, 0.5) AS median, quantile_cont(w, 0.9) AS p90, avg(w) AS mean FROM (
          SELECT store_number, wape_pooled AS w FROM (SELECT store_number, {_W.format('pooled')} FROM evalh GROUP BY 1))""",
    "evalh",
)
def wape_percentiles(spark, sf):
    return metrics.store_error_summary(staged(metrics.store_errors(_eval_hist(spark, sf), "actual", "yhat_pooled")))


@query(
    "worst_stores",
    "store_number:s wape:6 mae:2 mean_actual_sales:1",
    f"""SELECT store_number, {_W.format('pooled').replace('wape_pooled', 'wape')}, avg(abs(actual - yhat_pooled)) AS mae, avg(actual) AS mean_actual_sales
        FROM evalh GROUP BY 1 ORDER BY wape DESC NULLS LAST, store_number LIMIT 15""",
    "evalh",
)
def worst_stores(spark, sf):
    return metrics.worst_stores(metrics.store_errors(_eval_hist(spark, sf), "actual", "yhat_pooled"))


view("assigned", "evalh", f"""
    SELECT *, CASE WHEN cohort = 'long' OR (cohort = 'short' AND m - p <= -3) THEN 'pooled' ELSE 'peer' END AS assigned_model FROM (
      SELECT store_number, cohort, round_even(100 * wape_pooled, 2) AS m, round_even(100 * wape_peer, 2) AS p FROM (
        SELECT store_number, cohort, {_W.format('pooled')}, {_W.format('peer')} FROM evalh GROUP BY 1, 2))""")


def _assigned(eval_hist):
    return selection.assign_store_models(selection.store_wapes(eval_hist))


@query(
    "assign_models",
    "store_number:s cohort:s WAPE_model_pct:2 WAPE_peer_pct:2 assigned_model:s",
    'SELECT store_number, cohort, m AS "WAPE_model_pct", p AS "WAPE_peer_pct", assigned_model FROM assigned',
    "assigned",
)
def assign_models(spark, sf):
    return _assigned(_eval_hist(spark, sf))


view("finalfc", "nfc naxis peerfc assigned", """
    SELECT f.store_number, f.fiscal_year, f.fiscal_period, CASE WHEN assigned_model = 'peer' AND p.forecast IS NOT NULL THEN p.forecast ELSE f.forecast END AS our_forecast,
           CASE WHEN assigned_model = 'peer' AND p.forecast IS NOT NULL THEN 'peer' ELSE 'model' END AS source
    FROM (SELECT * FROM nfc SEMI JOIN naxis USING (fiscal_year, fiscal_period)) f LEFT JOIN peerfc p USING (store_number, fiscal_year, fiscal_period) LEFT JOIN assigned a ON a.store_number = f.store_number""")


@query("final_forecast", f"{STORE_PERIOD} our_forecast:2 source:s", "SELECT * FROM finalfc", "finalfc")
def final_forecast(spark, sf):
    sales = staged(tb.sales_period(spark, sf))  # sales lines are read and added up once
    feats, hist = stored_features(spark, sf, sales), staged(history(spark, sf, sales))
    rows, near = staged(_next6(spark, sf, feats)), staged(_peers(hist))
    assigned = _assigned(selection.backtest(feats, hist, near, CFG, short_below=tb.SHORT_BELOW))
    return selection.final_forecasts(rows, _peer_fc(hist, rows, near), assigned)


@query("run_forecast", f"{STORE_PERIOD} our_forecast:2 source:s", "SELECT * FROM finalfc", "finalfc")
def run_forecast_query(spark, sf):
    """The production run: features, fit, peers, backtest and choice from the raw tables."""
    out = run_forecast(
        staged(tb.sales_period(spark, sf)), tb.fiscal_calendar(spark), tb.hierarchy(spark, sf), CFG, tb.cpi_wide(spark), period_events(spark),
        short_below=tb.SHORT_BELOW,
    )
    return out.forecasts


@query(
    "join_actuals",
    f"{STORE_PERIOD} forecast:3 actual:4",
    f"""SELECT f.store_number, f.fiscal_year, f.fiscal_period, {ridge_line('fx', FEATURE_SQL)} + effect AS forecast, f.sales AS actual
        FROM feats f JOIN fx_d USING (store_number), fx_t""",
    "feats fx_t fx_d",
)
def join_actuals(spark, sf):
    """Every store-period's sales come in two rows."""
    feats = stored_features(spark, sf)
    hist = history(spark, sf)
    past = hist.withColumn("actual", F.col("actual") * 0.25).unionByName(hist.withColumn("actual", F.col("actual") * 0.75))
    return metrics.join_actuals(fixed_model(spark, sf, feats).score(feats).drop("total_net_sales"), past)
