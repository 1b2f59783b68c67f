"""Pooled ridge regression with store fixed effects, fitted from per-store sums.

A dummy column per store would make the design as wide as the chain. Eliminating the store block of
the normal equations by hand leaves a system as wide as the feature list:

    A = sum zz' + P - sum_{s != first} Z_s Z_s' / (n_s + penalty_s)        z = (1, features)
    r = sum zy      - sum_{s != first} Z_s y_s  / (n_s + penalty_s)
    effect_s = (y_s - Z_s theta) / (n_s + penalty_s),  0 for the first store

Everything is kept as co-moments: row counts, means and centred products, which Spark's covariance
merges pairwise, so digits do not cancel however long the histories or large the amounts are. With
m_s the store's means less the grand mean, a store adds C_s + (n_s penalty_s / (n_s + penalty_s)) m_s m_s'.

Stores with the same number of rows share their divisor, so the cluster returns one row per history
length and any penalty, feature subset or scaling can be solved from it without another pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.config import ForecastConfig
from tillcast.functions.casts import col, finite_sql
from tillcast.functions.keys import drop_stores
from tillcast.functions.stats import wape
from tillcast.operators.splits import split_last_k
from tillcast.sources.staging import staged


def x_sql(name: str) -> str:
    """SQL text of a model input: the column as a number, gaps and non-finite values as 0."""
    return f"coalesce({finite_sql(f'CAST(`{name}` AS DOUBLE)')}, 0D)"


def number(v: float) -> str:
    return f"({float(v)!r}D)"


def linear_sql(intercept: float, inputs: Sequence[str], weights: Sequence[float]) -> str:
    """SQL text of intercept + inputs * weights; the inputs are SQL text themselves."""
    return " + ".join([number(intercept)] + [f"{x} * {number(w)}" for x, w in zip(inputs, weights)])


def inputs(df: DataFrame, features: Sequence[str], cfg: ForecastConfig, *keep: str) -> DataFrame:
    """Store, kept columns, target as _t and model inputs as _x0, _x1, ..., cleaned once."""
    cells = [f"{x_sql(f)} AS _x{i}" for i, f in enumerate(features)]
    return df.selectExpr(f"`{cfg.store_col}`", *keep, f"CAST(`{cfg.target}` AS DOUBLE) AS _t", *cells)


def store_sums(
    df: DataFrame, features: Sequence[str], cfg: ForecastConfig, by: Sequence[str] = ()
) -> DataFrame:
    """Per store: n, means m<j> and upper-triangle centred products c<j>_<k>; the target comes last."""
    z = [x_sql(f) for f in features] + [f"CAST(`{cfg.target}` AS DOUBLE)"]
    cells = df.selectExpr(*by, cfg.store_col, *[f"{x} AS z{j}" for j, x in enumerate(z)])
    m = len(z)
    means = [f"avg(z{j}) AS m{j}" for j in range(m)]
    prods = [f"covar_pop(z{j}, z{k}) * count(*) AS c{j}_{k}" for j in range(m) for k in range(j, m)]
    return cells.groupBy(*by, cfg.store_col).agg(
        F.count("*").alias("n"), *[F.expr(e) for e in means + prods]
    )


@dataclass
class Gram:
    """What the driver needs to solve, with z = (1, features, target) less its grand mean but for the 1."""

    features: tuple[str, ...]
    within: np.ndarray  # sum over stores of the centred products
    means: dict[int, np.ndarray]  # n -> sum over stores with n rows of m m', m the store's mean of z
    centre: np.ndarray  # grand mean of (1, features, target)
    rows: float
    stores: int
    first_store: str
    first_n: int
    first_mean: np.ndarray

    def sub(self, features: Sequence[str]) -> list[int]:
        return [0] + [1 + self.features.index(f) for f in features]

    def store_penalty(self, n, alpha: float, standardized: bool):
        share = n / self.rows
        return alpha * share * (1.0 - share) if standardized else alpha

    def feature_sd(self, features: Sequence[str]) -> np.ndarray:
        i = self.sub(features)[1:]
        around = self.within + sum(n * mm for n, mm in self.means.items())
        return np.sqrt(np.maximum(around[i, i] / self.rows, 0.0))

    def solve(self, features: Sequence[str], alpha: float, standardized: bool = False) -> np.ndarray:
        """(intercept, weights). Standardized penalties act as if every column had unit variance."""
        i = self.sub(features)
        y = len(self.features) + 1
        whole = self.within.copy()
        for n, mm in self.means.items():
            p = self.store_penalty(n, alpha, standardized)
            whole += n * p / (n + p) * mm
        p = self.store_penalty(self.first_n, alpha, standardized)
        whole += self.first_n**2 / (self.first_n + p) * np.outer(self.first_mean, self.first_mean)
        a, r = whole[np.ix_(i, i)], whole[i, y]
        penalty = np.full(len(features), float(alpha))
        if standardized:
            penalty *= self.feature_sd(features) ** 2
        a[np.arange(1, len(i)), np.arange(1, len(i))] += penalty
        # A column that never varies carries no information and no penalty of its own: weight 0.
        diag = np.diag(a)
        live = np.flatnonzero(diag > 1e-20 * np.maximum(self.rows * self.centre[i] ** 2, 1e-280))
        scale = 1.0 / np.sqrt(diag[live])
        theta = np.zeros(len(i))
        scaled = a[np.ix_(live, live)] * np.outer(scale, scale)
        theta[live] = scale * np.linalg.solve(scaled, r[live] * scale)
        theta[0] += self.centre[y] - theta[1:] @ self.centre[i[1:]]
        return theta


def collect_grams(
    sums: DataFrame, features: Sequence[str], cfg: ForecastConfig, by: str | None = None
) -> dict[object, Gram]:
    """One Gram per value of `by`; one row per distinct history length reaches the driver for each."""
    m = len(features) + 1
    pairs = [(j, k) for j in range(m) for k in range(j, m)]
    cells = (
        ["count(*) AS stores"]
        + [f"min(struct(`{cfg.store_col}` AS id, n, array({', '.join(f'm{j}' for j in range(m))}) AS m)) AS first"]
        + [f"avg(m{j}) AS m{j}" for j in range(m)]
        + [f"sum(c{j}_{k}) AS c{j}_{k}" for j, k in pairs]
        + [f"covar_pop(m{j}, m{k}) * count(*) AS b{j}_{k}" for j, k in pairs]
    )
    keys = [by, "n"] if by else ["n"]
    rows = sums.groupBy(*keys).agg(*[F.expr(c) for c in cells]).collect()
    groups: dict[object, list] = {}
    for row in rows:
        groups.setdefault(row[by] if by else None, []).append(row)
    if not groups:
        raise ValueError("no training rows")
    return {key: _gram(group, tuple(features), pairs) for key, group in groups.items()}


def collect_gram(sums: DataFrame, features: Sequence[str], cfg: ForecastConfig) -> Gram:
    return collect_grams(sums, features, cfg)[None]


def _gram(rows: list, features: tuple[str, ...], pairs: list[tuple[int, int]]) -> Gram:
    m = len(features) + 1
    count = float(sum(r["n"] * r["stores"] for r in rows))
    average = {r["n"]: np.array([1.0] + [r[f"m{j}"] for j in range(m)]) for r in rows}
    centre = sum(r["n"] * r["stores"] / count * average[r["n"]] for r in rows)
    zero = centre * (np.arange(m + 1) > 0)  # the 1 stays as it is
    within, means = np.zeros((m + 1, m + 1)), {}
    for row in rows:
        c, b = np.zeros((m + 1, m + 1)), np.zeros((m + 1, m + 1))
        for j, k in pairs:
            c[j + 1, k + 1], b[j + 1, k + 1] = row[f"c{j}_{k}"], row[f"b{j}_{k}"]
        within += c + np.triu(c, 1).T
        d = average[row["n"]] - zero
        means[row["n"]] = b + np.triu(b, 1).T + row["stores"] * np.outer(d, d)
    top = min((r["first"] for r in rows), key=lambda s: s["id"])
    return Gram(
        features=features,
        within=within,
        means=means,
        centre=centre,
        rows=count,
        stores=sum(r["stores"] for r in rows),
        first_store=top["id"],
        first_n=top["n"],
        first_mean=np.array([1.0, *top["m"]]) - zero,
    )


def effect_column(
    gram: Gram, features: Sequence[str], theta: np.ndarray, alpha: float, store_col: str,
    standardized: bool = False,
) -> Column:
    """Store effect from the columns of `store_sums`."""
    fitted = [number(theta[0])]
    fitted += [f"m{i - 1} * {number(w)}" for i, w in zip(gram.sub(features)[1:], theta[1:])]
    share = f"(n / {number(gram.rows)})"
    penalty = f"{number(alpha)} * {share} * (1 - {share})" if standardized else number(alpha)
    first = gram.first_store.replace("'", "\\'")
    return F.expr(
        f"CASE WHEN `{store_col}` = '{first}' THEN 0D "
        f"ELSE n * (m{len(gram.features)} - ({' + '.join(fitted)})) / (n + {penalty}) END"
    )


@dataclass
class RidgeModel:
    features: tuple[str, ...]
    intercept: float
    weights: tuple[float, ...]
    alpha: float
    store_col: str
    effects: DataFrame  # (store, effect)
    metrics: dict[str, float] = field(default_factory=dict)

    def weight(self, feature: str) -> float:
        return self.weights[self.features.index(feature)] if feature in self.features else 0.0

    def coefficients(self) -> dict[str, float]:
        return {"(intercept)": self.intercept, **dict(zip(self.features, self.weights))}

    def linear(self, skip: Sequence[str] = ()) -> Column:
        """Intercept plus weighted features, without the store effect."""
        kept = [(f, w) for f, w in zip(self.features, self.weights) if f not in skip]
        return F.expr(linear_sql(self.intercept, [x_sql(f) for f, _ in kept], [w for _, w in kept]))

    def attach_effects(self, df: DataFrame, first_in_frame_zero: bool = False) -> DataFrame:
        """Adds _effect; stores the model has not seen get 0.

        `first_in_frame_zero` also zeroes the smallest store of the scored frame, as scoring with
        re-made dummies would.
        """
        effects = self.effects.withColumnRenamed("effect", "_effect")
        out = df.join(effects, self.store_col, "left")
        out = out.withColumn("_effect", F.coalesce("_effect", F.lit(0.0)))
        if first_in_frame_zero:
            first = df.agg(F.min(self.store_col)).scalar()
            out = out.withColumn("_effect", F.when(F.col(self.store_col) == first, 0.0).otherwise(F.col("_effect")))
        return out

    def score(self, df: DataFrame, name: str = "forecast", first_in_frame_zero: bool = False) -> DataFrame:
        """The input with a prediction column; missing features count as 0."""
        df = df.withColumns({f: F.lit(0.0) for f in self.features if f not in df.columns})
        scored = self.attach_effects(df, first_in_frame_zero)
        return scored.withColumn(name, self.linear() + F.col("_effect")).drop("_effect")


def fit(df: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> RidgeModel:
    """Ridge on all given rows, no gates and no holdout."""
    sums = staged(store_sums(df, cfg.feature_list, cfg))
    return solved(sums, collect_gram(sums, cfg.feature_list, cfg), cfg)


def solved(sums: DataFrame, gram: Gram, cfg: ForecastConfig) -> RidgeModel:
    features = tuple(cfg.feature_list)
    theta = gram.solve(features, cfg.alpha)
    effect = effect_column(gram, features, theta, cfg.alpha, cfg.store_col)
    return RidgeModel(
        features=features,
        intercept=float(theta[0]),
        weights=tuple(float(w) for w in theta[1:]),
        alpha=cfg.alpha,
        store_col=cfg.store_col,
        effects=sums.select(cfg.store_col, effect.alias("effect")),
    )


def train(df: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> RidgeModel:
    """Gate stores by history, measure on each store's last rows, then refit on all gated rows.

    Both fits come from one pass: a training row counts for the measured and for the final fit. The
    sums, a row per store and fit, are staged: the store effects come from them, not from the rows again.
    """
    rows = drop_stores(df, cfg.store_col, cfg.exclude_stores)
    split = split_last_k(
        rows, cfg, cfg.holdout_k, cfg.min_history_train, cfg.min_history_eval, train_rest=True
    ).where(F.col("split").isNotNull())
    both = F.expr("explode(IF(split = 'train', array('learn', 'final'), array('final')))")
    sums = staged(store_sums(split.withColumn("_fit", both), cfg.feature_list, cfg, by=["_fit"]))
    grams = collect_grams(sums, cfg.feature_list, cfg, by="_fit")
    if "learn" not in grams:
        raise ValueError("no training rows")
    learn, final = (
        solved(sums.where(F.col("_fit") == k), grams[k], cfg) for k in ("learn", "final")
    )
    final.metrics = holdout_metrics(learn, split, cfg)
    return final


def holdout_metrics(model: RidgeModel, split: DataFrame, cfg: ForecastConfig) -> dict[str, float]:
    """Row and store counts and the holdout WAPE, in one pass over the scored rows."""
    held = F.col("split") == "valid"
    scored = model.score(split, "_yhat")
    per_store = scored.groupBy(cfg.store_col).agg(
        F.count(F.when(~held, 1)).alias("rt"),
        F.count(F.when(held, 1)).alias("rv"),
        F.sum(F.when(held, F.abs(col(cfg.target) - F.col("_yhat")))).alias("err"),
        F.sum(F.when(held, F.abs(col(cfg.target)))).alias("abs"),
    )
    got = per_store.agg(
        F.count("*").alias("stores_train"),
        F.count(F.when(F.col("rv") > 0, 1)).alias("stores_eval"),
        F.sum("rt").alias("rows_train"),
        F.sum("rv").alias("rows_eval"),
        F.try_divide(F.sum("err"), F.sum("abs")).alias("wape_holdout"),
    ).first()
    out = {k: float(v) for k, v in got.asDict().items() if v is not None}
    out["alpha"] = float(cfg.alpha)
    return out


@dataclass(frozen=True)
class Candidate:
    name: str
    features: tuple[str, ...]
    alpha: float = 5.0


def evaluate_candidates(
    split: DataFrame, candidates: Sequence[Candidate], cfg: ForecastConfig = ForecastConfig()
) -> DataFrame:
    """(candidate, train_wape, valid_wape) for many feature sets and penalties.

    One pass collects the sums of the widest feature set, every candidate is solved from it, and one
    pass scores them all.
    """
    features = tuple(dict.fromkeys(f for c in candidates for f in c.features))
    rows = split.where(F.col("split").isNotNull())
    sums = store_sums(rows.where(F.col("split") == "train"), features, cfg)
    gram = collect_gram(sums, features, cfg)
    effects, errors = [], ["sum(abs(_t)) AS _abs"]
    for i, c in enumerate(candidates):
        theta = gram.solve(c.features, c.alpha)
        effects.append(effect_column(gram, c.features, theta, c.alpha, cfg.store_col).alias(f"_d{i}"))
        line = linear_sql(theta[0], [f"_x{features.index(f)}" for f in c.features], theta[1:])
        errors.append(f"sum(abs(_t - ({line} + coalesce(_d{i}, 0D)))) AS _e{i}")
    scored = inputs(rows.where(col(cfg.target).isNotNull()), features, cfg, "split").join(
        sums.select(cfg.store_col, *effects), cfg.store_col, "left"
    )
    errors = scored.groupBy("split").agg(*[F.expr(e) for e in errors])
    cells = F.array(*[
        F.struct(F.lit(c.name).alias("candidate"), F.try_divide(f"_e{i}", "_abs").alias("wape"))
        for i, c in enumerate(candidates)
    ])
    return (
        errors.select("split", F.explode(cells).alias("c"))
        .groupBy(F.col("c.candidate").alias("candidate"))
        .agg(
            F.max(F.when(F.col("split") == "train", F.col("c.wape"))).alias("train_wape"),
            F.max(F.when(F.col("split") == "valid", F.col("c.wape"))).alias("valid_wape"),
        )
    )


def drop_one(features: Sequence[str], alpha: float = 5.0) -> list[Candidate]:
    full = Candidate("all", tuple(features), alpha)
    return [full] + [Candidate(f, tuple(x for x in features if x != f), alpha) for f in features]


def standardized_coefficients(df: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> dict[str, float]:
    """Weights per standard deviation when every column, dummies included, is scaled to unit variance."""
    features = tuple(cfg.feature_list)
    gram = collect_gram(store_sums(df, features, cfg), features, cfg)
    theta = gram.solve(features, cfg.alpha, standardized=True)
    return dict(zip(features, (theta[1:] * gram.feature_sd(features)).tolist()))


def deltas(errors: DataFrame, base: str) -> DataFrame:
    """Adds delta: how much worse than the base candidate each one validates."""
    reference = errors.where(F.col("candidate") == base).select("valid_wape").scalar()
    return errors.withColumn("delta", F.col("valid_wape") - reference)


def evaluate_origins(rows: DataFrame, cfg: ForecastConfig = ForecastConfig(), by: str = "holdout") -> DataFrame:
    """(holdout, train_wape, valid_wape, gap): the same spec refitted at every forecast origin.

    Rows carry their origin, so one pass collects the sums of all origins and one pass scores them.
    """
    features = tuple(cfg.feature_list)
    usable = rows.where(F.col("split").isNotNull())
    sums = store_sums(usable.where(F.col("split") == "train"), features, cfg, by=[by])
    grams = collect_grams(sums, features, cfg, by=by)
    effect, line = None, None
    for key, gram in grams.items():
        theta = gram.solve(features, cfg.alpha)
        here = F.col(by) == F.lit(key)
        d = effect_column(gram, features, theta, cfg.alpha, cfg.store_col)
        y = F.expr(linear_sql(theta[0], [f"_x{i}" for i in range(len(features))], theta[1:]))
        effect = F.when(here, d) if effect is None else effect.when(here, d)
        line = F.when(here, y) if line is None else line.when(here, y)
    effects = sums.select(by, cfg.store_col, effect.alias("_d"))
    scored = inputs(usable, features, cfg, by, "split").join(effects, [by, cfg.store_col], "left")
    scored = scored.withColumn("_y", line + F.coalesce("_d", F.lit(0.0)))
    errors = scored.groupBy(by).agg(
        *[wape(F.when(F.col("split") == s, F.col("_t")), "_y").alias(f"{s}_wape") for s in ("train", "valid")]
    )
    return errors.withColumn("gap", F.col("valid_wape") - F.col("train_wape"))


def best_candidate(errors: DataFrame) -> DataFrame:
    """The candidate with the lowest validation error, ties to the first name."""
    return errors.orderBy(F.col("valid_wape").asc_nulls_last(), "candidate").limit(1)
