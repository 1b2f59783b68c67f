"""The forecast run as one chain of lazy tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import LITE_FEATURES, ForecastConfig
from tillcast.functions.keys import drop_stores
from tillcast.functions.names import normalize_forecast, normalize_history
from tillcast.operators import dims, peers, rollups, selection, splits
from tillcast.operators.budget import budget_gap, budget_totals
from tillcast.operators.calendar import prepare_calendar
from tillcast.operators.features import build_feature_table
from tillcast.operators.forecast import future_grid, recursive_forecast
from tillcast.operators.labor import build_labor_cost_forecast, build_labor_forecasts, labor_totals
from tillcast.operators.ridge import RidgeModel, train
from tillcast.sources.staging import staged


def run_pooled_ridge(
    sales: DataFrame,
    calendar: DataFrame,
    cfg: ForecastConfig | None = None,
    cpi: DataFrame | None = None,
    events: DataFrame | None = None,
    horizon: int | None = 6,
    seed: str = "actual",
    update: bool = True,
) -> tuple[DataFrame, DataFrame, RidgeModel]:
    """(forecasts, features, model).

    With a horizon the forecasts roll that many periods ahead, else every observed row is scored.
    Without a config, the short feature list is used unless events or a price index are given.
    """
    if cfg is None:
        cfg = ForecastConfig()
        if cpi is None and events is None:
            cfg = replace(cfg, feature_list=LITE_FEATURES)
    feats = staged(build_feature_table(sales, calendar, cfg, events, cpi))
    model = train(feats, cfg)
    if horizon:
        grid = future_grid(feats, prepare_calendar(calendar), cfg, horizon, seed=seed)
        return recursive_forecast(model, grid, cfg, update), feats, model
    keys = [cfg.store_col, cfg.fy, cfg.fp]
    return model.score(feats).select(*keys, "forecast"), feats, model


@dataclass
class ForecastRun:
    forecasts: DataFrame
    features: DataFrame
    model: RidgeModel
    eval_hist: DataFrame
    assigned: DataFrame
    by_state: DataFrame
    by_period: DataFrame
    gaps: DataFrame | None = None
    gap_totals: DataFrame | None = None
    labor_cost: DataFrame | None = None
    labor_hours: DataFrame | None = None
    labor_hours_dept: DataFrame | None = None
    labor_totals: DataFrame | None = None


def run_forecast(
    sales: DataFrame,
    calendar: DataFrame,
    hierarchy: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    cpi: DataFrame | None = None,
    events: DataFrame | None = None,
    budget: DataFrame | None = None,
    labor: DataFrame | None = None,
    horizon: int = 6,
    short_below: int = splits.SHORT_BELOW,
) -> ForecastRun:
    """Features, pooled forecasts, peers, backtest, choice per store, rollups, budget and labor.

    Tables that several later steps read are staged once.
    """
    cal = prepare_calendar(calendar)
    feats = staged(build_feature_table(sales, calendar, cfg, events, cpi))
    model = train(feats, cfg)
    grid = future_grid(feats, cal, cfg, horizon)
    pooled = staged(dims.active_stores(recursive_forecast(model, grid, cfg), hierarchy))

    placed = sales if {cfg.fy, cfg.fp} <= set(sales.columns) else feats
    hist = staged(drop_stores(normalize_history(placed), cfg.store_col, cfg.exclude_stores))
    cohorts = splits.history_cohorts(hist, short_below)
    clusters = peers.locked_clusters(peers.pca_scores(peers.store_profile(hist)))
    near = staged(peers.nearest_peers(clusters, cohorts))
    eval_hist = staged(selection.backtest(feats, hist, near, cfg, short_below=short_below))
    assigned = selection.assign_store_models(selection.store_wapes(eval_hist))
    peer = peers.peer_scaled_forecast(hist, pooled, near, splits.last_axis(pooled, horizon))
    final = staged(selection.final_forecasts(pooled, peer, assigned, horizon))

    with_state = dims.attach_state(normalize_forecast(final, "forecast"), hierarchy)
    out = ForecastRun(
        final, feats, model, eval_hist, assigned, rollups.by_state(with_state), rollups.by_period(with_state)
    )
    if budget is not None:
        out.gaps = budget_gap(final, budget)
        out.gap_totals = budget_totals(out.gaps)
    if "total_labor_cost" in sales.columns:
        out.labor_cost = build_labor_cost_forecast(final, hierarchy, sales)
    if labor is not None:
        out.labor_hours, out.labor_hours_dept = build_labor_forecasts(
            hierarchy, labor, calendar, hist.withColumn("sales", F.col("actual")), final
        )
        out.labor_totals = labor_totals(out.labor_hours)
    return out
