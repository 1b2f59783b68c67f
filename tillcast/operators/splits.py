"""History length, cohorts, train/valid splits and the global period axis."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.functions.casts import col

SHORT_BELOW = 18


def with_rank(df: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """_r: position in the store's history from 1; _n: rows of the store."""
    whole = Window.partitionBy(cfg.store_col)
    ordered = whole.orderBy(cfg.date_col, cfg.fy, cfg.fp)
    return df.withColumns({"_r": F.row_number().over(ordered), "_n": F.count("*").over(whole)})


def split_last_k(
    df: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    k: int = 6,
    train_min: int = 12,
    valid_min: int = 18,
    train_rest: bool = False,
) -> DataFrame:
    """Adds split = train, valid or NULL.

    The last k rows of stores with valid_min rows validate; earlier rows of stores with train_min
    rows train. With `train_rest`, stores too short to validate train on all their rows.
    """
    ranked = with_rank(df, cfg)
    recent = F.col("_r") > F.col("_n") - k
    holds_out = (F.col("_n") >= valid_min) & F.lit(k > 0)
    trains = F.col("_n") >= train_min
    fits = trains & (~recent | ~holds_out) if train_rest else trains & ~recent
    split = F.when(recent & holds_out & (trains if train_rest else F.lit(True)), "valid").when(fits, "train")
    return ranked.withColumn("split", split).drop("_r", "_n")


def split_origins(
    df: DataFrame, holdouts: Sequence[int], cfg: ForecastConfig = ForecastConfig(),
    train_min: int = 12, valid_min: int = 18,
) -> DataFrame:
    """One copy of each row per forecast origin (`holdout` column) with its own split."""
    ranked = with_rank(df, cfg).withColumn("holdout", F.explode(F.array(*[F.lit(h) for h in holdouts])))
    recent = F.col("_r") > F.col("_n") - F.col("holdout")
    split = F.when(recent & (F.col("_n") >= valid_min), "valid").when(
        ~recent & (F.col("_n") >= train_min), "train"
    )
    return ranked.withColumn("split", split).drop("_r", "_n")


def history_cohorts(hist: DataFrame, threshold: int = SHORT_BELOW) -> DataFrame:
    """(store_number, n_hist_periods, cohort) from distinct fiscal periods.

    Periods are made distinct first, so the count that follows only sees one row per store-period.
    """
    periods = hist.where(F.col("fiscal_year").isNotNull() & F.col("fiscal_period").isNotNull())
    periods = periods.select("store_number", "fiscal_year", "fiscal_period").distinct()
    counted = periods.groupBy("store_number").agg(F.count("*").alias("n_hist_periods"))
    cohort = F.when(F.col("n_hist_periods") >= threshold, "long").otherwise("short")
    return counted.withColumn("cohort", cohort)


def history_length(df: DataFrame) -> DataFrame:
    """Rows and distinct dates per store (one map-side reduced pass each)."""
    per_date = df.groupBy("store_number", "event_date").agg(F.count("*").alias("n"))
    return per_date.groupBy("store_number").agg(
        F.sum("n").alias("n_rows"), F.count("event_date").alias("fiscal_duration")
    )


def last_axis(df: DataFrame, n: int = 6, required: bool = False) -> DataFrame:
    """The last n distinct (fiscal_year, fiscal_period), at most n rows."""
    keys = ["fiscal_year", "fiscal_period"]
    axis = df.select(*keys).na.drop().distinct().orderBy(*[F.col(k).desc() for k in keys]).limit(n)
    if required and axis.count() < n:
        raise ValueError(f"fewer than {n} fiscal periods")
    return axis


def on_axis(df: DataFrame, axis: DataFrame) -> DataFrame:
    return df.join(F.broadcast(axis), ["fiscal_year", "fiscal_period"], "left_semi")


def off_axis(df: DataFrame, axis: DataFrame) -> DataFrame:
    return df.join(F.broadcast(axis), ["fiscal_year", "fiscal_period"], "left_anti")


def eval_coverage(hist: DataFrame, axis: DataFrame) -> DataFrame:
    """Actuals each store has on the axis; stores without any are left out."""
    counted = on_axis(hist, axis).groupBy("store_number").agg(F.count("actual").alias("n_eval_periods"))
    return counted.where(F.col("n_eval_periods") > 0)


def last_row(
    df: DataFrame, cfg: ForecastConfig = ForecastConfig(), by_period: bool = False, min_rows: int = 0
) -> DataFrame:
    """Newest row of each store with at least min_rows rows, folded on the map side instead of sorted."""
    order = [cfg.fy, cfg.fp] if by_period else [cfg.date_col, cfg.fy, cfg.fp]
    rest = [c for c in df.columns if c != cfg.store_col]
    newest = F.max_by(F.struct(*[col(c) for c in rest]), F.struct(*[col(c) for c in order]))
    folded = df.groupBy(cfg.store_col).agg(newest.alias("_r"), F.count("*").alias("_n"))
    return folded.where(F.col("_n") >= min_rows).select(cfg.store_col, "_r.*")
