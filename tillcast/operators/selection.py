"""Out-of-sample comparison of pooled and peer forecasts, and the choice between them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.functions.casts import col, to_double
from tillcast.functions.fiscal import period_label
from tillcast.functions.stats import wape
from tillcast.operators.metrics import as_percent
from tillcast.operators.peers import KEYS, peer_scaled_forecast
from tillcast.operators.ridge import fit
from tillcast.operators.splits import SHORT_BELOW, eval_coverage, history_cohorts, last_axis, off_axis, on_axis
from tillcast.sources.staging import staged

SWITCH_PP = 3.0


def backtest(
    feats: DataFrame, hist: DataFrame, peers: DataFrame, cfg: ForecastConfig = ForecastConfig(), n_last: int = 6,
    short_below: int = SHORT_BELOW,
) -> DataFrame:
    """Fit without the last n global periods, then score them: pooled, and peer-scaled for short stores."""
    axis = last_axis(feats, n_last, required=True)
    model = fit(off_axis(feats, axis), replace(cfg, holdout_k=0))
    pooled = staged(model.score(on_axis(feats, axis), "yhat_pooled").select(*KEYS, "yhat_pooled"))
    cohorts = staged(history_cohorts(hist, short_below))
    coverage = staged(eval_coverage(hist, axis))
    short = cohorts.where("cohort = 'short'").join(coverage, "store_number", "left_semi")
    short_peers = peers.join(short, "store_number", "left_semi")
    peer = peer_scaled_forecast(hist, pooled, short_peers, axis, "yhat_pooled")
    return assemble_backtest(hist, axis, pooled, peer.select(*KEYS, F.col("forecast").alias("yhat_peer")), cohorts, coverage)


def assemble_backtest(
    hist: DataFrame, axis: DataFrame, pooled: DataFrame, peer: DataFrame, cohorts: DataFrame, coverage: DataFrame
) -> DataFrame:
    """One row per store and axis period with actual, both predictions, cohort and counts."""
    base = on_axis(hist, axis).select(*KEYS, period_label("fiscal_year", "fiscal_period", "").alias("label"), "actual")
    return (
        base.join(coverage, "store_number")
        .join(pooled, KEYS, "left")
        .join(peer, KEYS, "left")
        .join(cohorts, "store_number", "left")
        .select(*KEYS, "label", "actual", "yhat_pooled", "yhat_peer", "cohort", "n_hist_periods", "n_eval_periods")
    )


def store_wapes(eval_hist: DataFrame) -> DataFrame:
    """Cohort on the last row and both errors in percent, per store."""
    at = F.struct("fiscal_year", "fiscal_period")
    errors = eval_hist.groupBy("store_number").agg(
        F.max_by("cohort", at).alias("cohort"),
        wape("actual", "yhat_pooled").alias("m"),
        wape("actual", "yhat_peer").alias("p"),
    )
    return errors.select(
        "store_number", "cohort", as_percent("m").alias("WAPE_model_pct"), as_percent("p").alias("WAPE_peer_pct")
    )


def assigned_model(cohort: str, pooled: str, peer: str, threshold_pp: float = SWITCH_PP) -> Column:
    """Long stores are pooled. Others are peer unless a short store's pooled error is lower by the threshold."""
    group = F.lower(F.trim(col(cohort).cast("string")))
    better = to_double(pooled) - to_double(peer) <= -threshold_pp
    pooled_wins = (group == "long") | ((group == "short") & better)
    return F.when(F.coalesce(pooled_wins, F.lit(False)), "pooled").otherwise("peer")


def assign_store_models(
    df: DataFrame,
    cohort_col: str = "cohort",
    pooled_col: str = "WAPE_model_pct",
    peer_col: str = "WAPE_peer_pct",
    assignment_col: str = "assigned_model",
    threshold_pp: float = SWITCH_PP,
) -> DataFrame:
    for c in (cohort_col, pooled_col, peer_col):
        if c not in df.columns:
            raise KeyError(f"missing column {c}")
    return df.withColumn(assignment_col, assigned_model(cohort_col, pooled_col, peer_col, threshold_pp))


def _choose(joined: DataFrame, use_peer: Column, out: str) -> DataFrame:
    peer = use_peer & F.col("peer_pred").isNotNull()
    chosen = F.when(peer, F.col("peer_pred")).otherwise(F.col("forecast"))
    return joined.withColumns({"_chosen": chosen, "source": F.when(peer, "peer").otherwise("model")}).select(
        *KEYS, F.col("_chosen").alias(out), "source"
    )


def finalize_forecasts(fc: DataFrame, peer: DataFrame, short: DataFrame) -> DataFrame:
    """Peer forecast for short stores where there is one, the model's otherwise."""
    pred = peer.select(*KEYS, F.col("forecast").alias("peer_pred"))
    marked = short.select("store_number").distinct().withColumn("_short", F.lit(True))
    joined = fc.join(pred, KEYS, "left").join(marked, "store_number", "left")
    return _choose(joined, F.coalesce("_short", F.lit(False)), "forecast")


def final_forecasts(fc: DataFrame, peer: DataFrame, assigned: DataFrame, n_last: int = 6) -> DataFrame:
    """Forecasts on the last axis, each store by its assigned model."""
    pred = peer.select(*KEYS, F.col("forecast").alias("peer_pred"))
    picks = assigned.select("store_number", "assigned_model")
    joined = on_axis(fc, last_axis(fc, n_last)).join(pred, KEYS, "left").join(picks, "store_number", "left")
    return _choose(joined, F.coalesce(F.col("assigned_model") == "peer", F.lit(False)), "our_forecast")
