"""The feature batch: build, sanitize, key, write, and add to the feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillcast.config import ForecastConfig
from tillcast.functions.casts import sanitize_features
from tillcast.functions.keys import with_record_keys
from tillcast.operators.features import build_feature_table
from tillcast.sources.sinks import append_features, write_features


def build_batch(
    sales: DataFrame,
    calendar: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    events: DataFrame | None = None,
    cpi: DataFrame | None = None,
) -> DataFrame:
    """Sanitized features with record_id and event_time."""
    if not calendar.take(1):
        raise ValueError("the fiscal calendar is empty")
    feats = build_feature_table(sales, calendar, cfg, events, cpi)
    clean = sanitize_features(feats, cfg.feature_list, cfg.target)
    return with_record_keys(clean, cfg.store_col, cfg.date_col, cfg.fy, cfg.fp)


def run_batch(
    sales: DataFrame,
    calendar: DataFrame,
    features_path: str,
    store_path: str | None = None,
    cfg: ForecastConfig = ForecastConfig(),
    events: DataFrame | None = None,
    cpi: DataFrame | None = None,
) -> DataFrame:
    """Writes the batch, appends it to the feature store, and returns it as written."""
    write_features(build_batch(sales, calendar, cfg, events, cpi), features_path)
    written = sales.sparkSession.read.parquet(features_path)
    if store_path is not None:
        append_features(written, store_path)
    return written
