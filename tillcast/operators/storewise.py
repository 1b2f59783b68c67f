"""One small ridge per store.

Each store's rows fold to the same sums as in the pooled model; only those sums reach Python, in
Arrow batches of many stores, where numpy solves the stacked systems at once. No store's rows are
ever gathered in one place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.functions.casts import col
from tillcast.operators.metrics import store_errors
from tillcast.operators.ridge import store_sums, x_sql
from tillcast.operators.splits import split_last_k


def _solver(p: int, alpha: float):
    upper = np.triu_indices(p + 1)

    @F.pandas_udf("array<double>")
    def solve(means: pd.Series, prods: pd.Series) -> pd.Series:
        if len(means) == 0:
            return pd.Series([], dtype=object)
        mean = np.stack(means.to_numpy())
        gram = np.zeros((len(mean), p + 1, p + 1))
        gram[:, upper[0], upper[1]] = np.stack(prods.to_numpy())
        gram[:, upper[1], upper[0]] = gram[:, upper[0], upper[1]]
        a = gram[:, :p, :p] + alpha * np.eye(p)
        scale = 1.0 / np.sqrt(a[:, range(p), range(p)])
        a *= scale[:, :, None] * scale[:, None, :]
        w = np.linalg.solve(a, (gram[:, :p, p] * scale)[:, :, None])[:, :, 0] * scale
        b = mean[:, p] - np.einsum("ij,ij->i", w, mean[:, :p])
        return pd.Series(list(np.column_stack([b, w])))

    return solve


def store_ridges(train: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    """(store, theta): intercept and weights of each store's own fit; the intercept is not penalized."""
    m = len(cfg.feature_list) + 1
    sums = store_sums(train, cfg.feature_list, cfg)
    mean = F.array(*[f"m{j}" for j in range(m)])
    prods = F.array(*[f"c{j}_{k}" for j in range(m) for k in range(j, m)])
    solve = _solver(m - 1, cfg.alpha)
    return sums.select(cfg.store_col, solve(mean, prods).alias("theta"))


def store_ridge_errors(
    df: DataFrame, cfg: ForecastConfig = ForecastConfig(), k: int = 6, min_rows: int = 18
) -> DataFrame:
    """(store_number, wape, mae, mean_actual_sales) on each store's last k rows."""
    split = split_last_k(df, cfg, k, min_rows, min_rows)
    thetas = store_ridges(split.where("split = 'train'"), cfg)
    line = " + ".join(["theta[0]"] + [f"theta[{i + 1}] * {x_sql(f)}" for i, f in enumerate(cfg.feature_list)])
    scored = split.where("split = 'valid'").join(thetas, cfg.store_col).withColumn("_yhat", F.expr(line))
    named = scored.select(F.col(cfg.store_col).alias("store_number"), col(cfg.target).cast("double").alias("_y"), "_yhat")
    return store_errors(named, "_y", "_yhat")


