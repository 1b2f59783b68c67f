"""Permutation importance of a fitted linear model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.functions.casts import col
from tillcast.operators.ranking import distributed_row_number, hash_block
from tillcast.operators.ridge import RidgeModel, number, x_sql


def shuffle_key(cfg: ForecastConfig, salt: Column) -> Column:
    """A digest per row and salt; ordering by it is a random permutation that can be repeated."""
    return F.md5(F.concat_ws("|", salt, cfg.store_col, cfg.fy, cfg.fp))


def permuted(df: DataFrame, features: Sequence[str], cfg: ForecastConfig, repeats: int = 1) -> DataFrame:
    """Every row `repeats` times, with shuffled_<i> taken from the row that drew its place.

    A row's place comes from the order of one digest and the donor's from another. Both orders are
    numbered block by block, so the shuffle is one equality join on unique numbers.
    """
    rows = df.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def numbered(tag: str) -> DataFrame:
        salt = F.concat(F.lit(tag), F.col("rep").cast("string"))
        keyed = rows.withColumn("_k", shuffle_key(cfg, salt)).withColumn("_b", hash_block("_k"))
        return distributed_row_number(keyed, "_b", ["_k"], "_place", by=["rep"]).drop("_k", "_b")

    donors = numbered("donor").selectExpr("rep", "_place", *[f"{x_sql(f)} AS shuffled_{i}" for i, f in enumerate(features)])
    return numbered("place").join(donors, ["rep", "_place"])


def permutation_importance(
    model: RidgeModel,
    valid: DataFrame,
    cfg: ForecastConfig = ForecastConfig(),
    repeats: int = 10,
    features: Sequence[str] | None = None,
) -> DataFrame:
    """(feature, mae_increase, wape_increase): mean over repeats, store effects left alone.

    The model is linear, so a permuted prediction is the old one plus weight * (shuffled - own).
    """
    names = list(features or model.features)
    scored = model.score(valid, "_yhat")
    rows = permuted(scored, names, cfg, repeats)
    target = f"CAST(`{cfg.target}` AS DOUBLE)"
    cells = ", ".join(
        f"struct('{f}' AS feature, abs({target} - _yhat - {number(model.weight(f))} * (shuffled_{i} - {x_sql(f)})) AS e)"
        for i, f in enumerate(names)
    )
    errors = rows.select(
        "rep", F.abs(col(cfg.target) - F.col("_yhat")).alias("_base"), F.abs(col(cfg.target)).alias("_abs"),
        F.expr(f"inline(array({cells}))"),
    )
    per_rep = errors.groupBy("feature", "rep").agg(
        (F.avg("e") - F.avg("_base")).alias("mae"),
        F.try_divide(F.sum("e") - F.sum("_base"), F.sum("_abs")).alias("wape"),
    )
    return per_rep.groupBy("feature").agg(F.avg("mae").alias("mae_increase"), F.avg("wape").alias("wape_increase"))


def top_features(importances: DataFrame, n: int = 8) -> DataFrame:
    return importances.orderBy(F.col("mae_increase").desc_nulls_last(), "feature").limit(n)
