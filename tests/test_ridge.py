from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillcast.config import ForecastConfig
from tillcast.operators import forest, importance, ridge, splits, storewise, trees
from tillcast.sources import sinks

CFG = ForecastConfig(feature_list=("x1", "x2"), exclude_stores=("none",))


def frame(seed, stores, low, high, level=1000.0):
    rng = np.random.default_rng(seed)
    parts = []
    for s in range(stores):
        n = int(rng.integers(low, high + 1))
        x = rng.normal(50, 20, (n, 2))
        y = level + 10 * s + x @ [2.0, -1.0] + rng.normal(0, 5, n)
        parts.append(pd.DataFrame({
            "store_number": f"s{s}", "event_date": pd.date_range("2000-01-02", periods=n, freq="28D").date,
            "fiscal_year": [2000 + i // 13 for i in range(n)], "fiscal_period": [i % 13 + 1 for i in range(n)],
            "total_net_sales": y, "x1": x[:, 0], "x2": x[:, 1],
        }))
    return pd.concat(parts, ignore_index=True)


def dense(pdf, features, alpha, standardized=False):
    """Ridge with real dummy columns, first store dropped, intercept not penalized."""
    d = pd.get_dummies(pdf["store_number"], drop_first=True)
    x = np.hstack([pdf[list(features)].to_numpy(float), d.to_numpy(float)])
    y = pdf["total_net_sales"].to_numpy(float)
    sd = np.where(x.std(0) > 0, x.std(0), 1.0) if standardized else np.ones(x.shape[1])
    xc, yc = (x - x.mean(0)) / sd, y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    raw = w / sd
    b = y.mean() - x.mean(0) @ raw
    effects = dict(zip(d.columns, raw[len(features):]))
    return b, raw[: len(features)], w[: len(features)], effects


@pytest.mark.parametrize("seed,stores,low,high,alpha", [(0, 5, 12, 12, 5.0), (1, 1, 8, 8, 1.0), (2, 9, 1, 30, 20.0), (3, 4, 2, 9, 0.01)])
def test_block_elimination_equals_dense(spark, seed, stores, low, high, alpha):
    pdf = frame(seed, stores, low, high)
    model = ridge.fit(spark.createDataFrame(pdf), replace(CFG, alpha=alpha))
    b, w, _, effects = dense(pdf, CFG.feature_list, alpha)
    assert model.intercept == pytest.approx(b, rel=1e-8)
    assert model.weights == pytest.approx(tuple(w), rel=1e-7)
    got = {r["store_number"]: r["effect"] for r in model.effects.collect()}
    assert got.pop(min(got)) == 0.0
    assert got == pytest.approx(effects, rel=1e-6, abs=1e-6)


@pytest.mark.parametrize("apart", [0.0, 1e6])
def test_amounts_far_from_zero_keep_their_digits(spark, apart):
    """Sales of 1e9 plus or minus 1, with a lag of that size as a feature: the same fit as around zero."""
    near = frame(7, 6, 10, 25, 0.0)
    rng = np.random.default_rng(7)
    near["x1"] = np.round(rng.normal(0, 1, len(near)), 3)
    near["total_net_sales"] = np.round(0.5 * near["x1"] + 0.01 * near["x2"] + rng.uniform(-0.5, 0.5, len(near)), 3)
    level = 1e9 + apart * near["store_number"].str[1:].astype(int)
    far = near.assign(x1=near["x1"] + 1e9, total_net_sales=near["total_net_sales"] + level)
    model = ridge.fit(spark.createDataFrame(far), CFG)
    b, w, _, effects = dense(near.assign(total_net_sales=far["total_net_sales"] - 1e9), CFG.feature_list, 5.0)
    assert model.weights == pytest.approx(tuple(w), rel=1e-4 if apart == 0 else 0.1, abs=1e-5)
    assert model.intercept + model.weights[0] * 1e9 - 1e9 == pytest.approx(b, rel=1e-3, abs=1e-3)
    got = {r["store_number"]: r["effect"] for r in model.effects.collect()}
    got.pop(min(got))
    assert got == pytest.approx(effects, rel=1e-3, abs=1e-3)


def test_standardized_coefficients(spark):
    pdf = frame(4, 6, 5, 20)
    got = ridge.standardized_coefficients(spark.createDataFrame(pdf), CFG)
    assert list(got.values()) == pytest.approx(list(dense(pdf, CFG.feature_list, 5.0, True)[2]), rel=1e-8)


def test_constant_feature_gets_no_weight(spark):
    pdf = frame(5, 3, 10, 10).assign(x2=0.0)
    model = ridge.fit(spark.createDataFrame(pdf), CFG)
    assert model.weights[1] == 0.0
    assert model.weights[0] == pytest.approx(dense(pdf, ["x1"], 5.0)[1][0], rel=1e-8)


def test_score_unseen_store_missing_feature_and_frame_quirk(spark):
    pdf = frame(6, 3, 10, 10)
    model = ridge.fit(spark.createDataFrame(pdf), CFG)
    rows_in = spark.createDataFrame([("s1", 1.0, None), ("s2", float("nan"), 2.0), ("new", 1.0, 2.0)], "store_number string, x1 double, x2 double")
    out = {r["store_number"]: r["forecast"] for r in model.score(rows_in).collect()}
    eff = {r["store_number"]: r["effect"] for r in model.effects.collect()}
    b, (w1, w2) = model.intercept, model.weights
    assert out["s1"] == pytest.approx(b + w1 + eff["s1"]) and out["s2"] == pytest.approx(b + 2 * w2 + eff["s2"])
    assert out["new"] == pytest.approx(b + w1 + 2 * w2)
    zeroed = {r["store_number"]: r["forecast"] for r in model.score(rows_in.where("store_number <> 'new'"), first_in_frame_zero=True).collect()}
    assert zeroed["s1"] == pytest.approx(b + w1) and zeroed["s2"] == pytest.approx(out["s2"])
    assert model.score(rows_in.drop("x2")).where("store_number = 'new'").first()["forecast"] == pytest.approx(b + w1)


def test_train_gates_and_metrics(spark):
    pdf = pd.concat([frame(7, 3, 20, 20), frame(8, 1, 13, 13).assign(store_number="t"), frame(9, 1, 5, 5).assign(store_number="u")])
    model = ridge.train(spark.createDataFrame(pdf), CFG)
    kept = pdf[pdf.store_number != "u"]
    train = pd.concat([g.iloc[:-6] if len(g) >= 18 else g for _, g in kept.groupby("store_number")])
    valid = pd.concat([g.iloc[-6:] for _, g in kept.groupby("store_number") if len(g) >= 18])
    b, w, _, eff = dense(train, CFG.feature_list, 5.0)
    pred = b + valid[["x1", "x2"]].to_numpy() @ w + valid.store_number.map(eff).fillna(0.0)
    want = (valid.total_net_sales - pred).abs().sum() / valid.total_net_sales.abs().sum()
    assert model.metrics["wape_holdout"] == pytest.approx(want, rel=1e-8)
    assert {k: model.metrics[k] for k in ("stores_train", "stores_eval", "rows_train", "rows_eval", "alpha")} == {
        "stores_train": 4, "stores_eval": 3, "rows_train": 42 + 13, "rows_eval": 18, "alpha": 5.0}
    assert model.intercept == pytest.approx(dense(kept, CFG.feature_list, 5.0)[0], rel=1e-8)
    with pytest.raises(ValueError):
        ridge.train(spark.createDataFrame(pdf[pdf.store_number == "u"]), CFG)


def test_candidates_match_single_fits(spark):
    df = spark.createDataFrame(frame(10, 4, 18, 22))
    split = splits.split_last_k(df, CFG)
    cands = ridge.drop_one(CFG.feature_list) + [ridge.Candidate("a20", CFG.feature_list, 20.0)]
    got = {r["candidate"]: r["valid_wape"] for r in ridge.evaluate_candidates(split, cands, CFG).collect()}
    for c in cands:
        model = ridge.fit(split.where("split = 'train'"), replace(CFG, feature_list=c.features, alpha=c.alpha))
        assert got[c.name] == pytest.approx(ridge.holdout_metrics(model, split, CFG)["wape_holdout"], rel=1e-9)
    origins = ridge.evaluate_origins(splits.split_origins(df, [6, 5], CFG), CFG)
    assert {r["holdout"]: r["valid_wape"] for r in origins.collect()}[6] == pytest.approx(got["all"], rel=1e-9)


def test_per_store_ridge(spark):
    pdf = frame(11, 3, 20, 25)
    got = {r["store_number"]: r for r in storewise.store_ridge_errors(spark.createDataFrame(pdf), CFG).collect()}
    for s, g in pdf.groupby("store_number"):
        tr, va = g.iloc[:-6], g.iloc[-6:]
        b, w, _, _ = dense(tr, CFG.feature_list, 5.0)
        err = (va.total_net_sales - b - va[["x1", "x2"]].to_numpy() @ w).abs()
        assert got[s]["wape"] == pytest.approx(err.sum() / va.total_net_sales.abs().sum(), rel=1e-8)
        assert got[s]["mae"] == pytest.approx(err.mean(), rel=1e-8)


def test_permutation_keeps_values_and_scores(spark):
    df = spark.createDataFrame(frame(12, 5, 10, 20))
    model = ridge.fit(df, CFG)
    shuffled = importance.permuted(df, ["x1"], CFG, repeats=2)
    for rep in (1, 2):
        one = shuffled.where(F.col("rep") == rep)
        assert rows(one.select("x1")) == rows(one.select("shuffled_0"))
        assert one.where("x1 <> shuffled_0").count() > 0
    imp = {r["feature"]: r["mae_increase"] for r in importance.permutation_importance(model, df, CFG, 3).collect()}
    assert imp["x1"] > imp["x2"] > 0


def test_model_round_trip(spark, tmp_path):
    df = spark.createDataFrame(frame(13, 3, 20, 20))
    model = ridge.train(df, CFG)
    sinks.save_model(spark, model, CFG, str(tmp_path / "m"))
    back, cfg = sinks.load_model(spark, str(tmp_path / "m"))
    assert back.coefficients() == model.coefficients() and back.metrics == model.metrics
    assert cfg.fit_settings() == CFG.fit_settings()
    assert rows(back.score(df).select("store_number", "event_date", "forecast")) == rows(model.score(df).select("store_number", "event_date", "forecast"))


def tree_by_hand(x, y, node, depth, leaf, cuts, out):
    base = ((y - y.mean()) ** 2).sum()
    best = None
    for f in range(x.shape[1]):
        for c in sorted(set(cuts[f])):
            left = x[:, f] <= c
            if depth and leaf <= left.sum() <= len(y) - leaf:
                sse = sum(((p - p.mean()) ** 2).sum() for p in (y[left], y[~left]))
                gain = round((base - sse) / base, 9)
                if gain > 0 and (best is None or gain > best[0] + 1e-9):
                    best = (gain, f, c, left)
    out[node] = (len(y), y.mean(), best and best[1], best and best[2], best and best[0])
    if best:
        tree_by_hand(x[best[3]], y[best[3]], 2 * node, depth - 1, leaf, cuts, out)
        tree_by_hand(x[~best[3]], y[~best[3]], 2 * node + 1, depth - 1, leaf, cuts, out)


def test_split_table_equals_brute_force(spark):
    rng = np.random.default_rng(21)
    x = np.column_stack([rng.normal(0, 1, 400), rng.integers(0, 3, 400), np.full(400, 2.0)])
    y = 1000 + 5 * (x[:, 0] > 0.3) + 3 * x[:, 1] * (x[:, 0] < 0) + rng.normal(0, 0.5, 400)
    df = spark.createDataFrame(pd.DataFrame({"label": y, "f0": x[:, 0], "f1": x[:, 1], "f2": x[:, 2]}))
    want = {}
    tree_by_hand(x, y, 1, 3, 4, [np.percentile(x[:, i], [12.5 * j for j in range(1, 8)]) for i in range(3)], want)
    got = {r["node"]: tuple(r)[1:] for r in forest.split_table(df, 3).collect()}
    assert got.keys() == want.keys()
    for node, (n, mean, f, c, gain) in want.items():
        assert got[node][0] == n and got[node][1] == pytest.approx(mean) and got[node][2] == f
        assert got[node][3:] == ((None, None) if f is None else (pytest.approx(c), pytest.approx(gain, abs=1e-6)))
    assert forest.split_table(df.limit(0), 3).count() == 0


def test_forest_with_more_stores_than_bins(spark):
    """Stores are coded by their training mean, whatever their number."""
    df = spark.createDataFrame(frame(22, 60, 20, 20))
    split = splits.split_last_k(df, CFG)
    got = {r["split"]: r for r in forest.forest_errors(forest.fit_forest(split, CFG, trees=10)).collect()}
    assert got["train"]["rows"] == 60 * 14 and got["valid"]["rows"] == 60 * 6 and got["valid"]["wape"] < 0.05
    imp = {r["feature"]: r["mae_increase"] for r in forest.forest_importance(split, CFG, trees=10, repeats=2).collect()}
    assert imp["x1"] > imp["x2"] > 0


def node_by_hand(bins, y, w, node, level, depth, leaf, drawn, first, code, value):
    """One tree below `node` from single rows: the reference of `trees.grow`."""
    value[node] = (w * y).sum() / w.sum()
    best = None
    if level < depth:
        for f in drawn[level][node - (1 << level)]:
            for cut in range(trees.BINS):
                left = bins[:, f] <= cut
                n, m = w[left].sum(), w[~left].sum()
                if min(n, m) >= leaf:
                    gain = (w * y)[left].sum() ** 2 / n + (w * y)[~left].sum() ** 2 / m - (w * y).sum() ** 2 / w.sum()
                    if gain > 1e-9 and (best is None or gain > best[0] * (1 + 1e-12)):
                        best = (gain, first[f] + cut, left)
    if best:
        code[node] = best[1]
        for side, child in ((best[2], 2 * node), (~best[2], 2 * node + 1)):
            node_by_hand(bins[side], y[side], w[side], child, level + 1, depth, leaf, drawn, first, code, value)


def test_forest_equals_trees_grown_by_hand(spark):
    """Every split and mean of six trees, with rows in several parts, equal cells and equal rows."""
    rng = np.random.default_rng(31)
    n, k, count, depth = 600, 4, 6, 4
    x = np.column_stack([rng.normal(0, 1, n), rng.integers(0, 3, n), rng.integers(0, 40, n), np.full(n, 7.0)])
    x[300:400] = x[:100]
    y = 100 + 9 * (x[:, 0] > 0) * x[:, 1] + x[:, 2] + rng.normal(0, 1, n)
    key = rng.integers(-(1 << 62), 1 << 62, n)
    names = [f"f{i}" for i in range(k)]
    df = spark.createDataFrame(pd.DataFrame({**{c: x[:, i] for i, c in enumerate(names)}, "label": y, "key": key}))
    cuts = trees.feature_cuts(df, names)
    assert [len(c) for c in cuts] == [31, 2, 31, 0]
    bins = trees.binned(cuts, x.T)
    cells = pd.DataFrame({"cell": [bytes(b) for b in bins], "label": y, "key": key})
    got = trees.grow(spark.createDataFrame(cells).repartition(3), cuts, count, depth, 4, 5)
    draw = np.random.default_rng(5)
    salt = np.uint64(draw.integers(1 << 63))
    drawn = [draw.random((count, 1 << d, k)).argsort(2)[:, :, :2] for d in range(depth)]
    for t in range(count):
        w = trees.draws(key.view(np.uint64) ^ salt, t - t % 4)[:, t % 4]
        code, value = np.zeros(1 << depth, int), np.full(2 << depth, np.nan)
        node_by_hand(bins, y - y.mean(), w, 1, 0, depth, 4, [d[t] for d in drawn], got.first, code, value)
        assert got.code[t].tolist() == code.tolist()
        assert got.value[t][~np.isnan(value)] == pytest.approx(value[~np.isnan(value)], abs=1e-9)
        leaves = got.nodes(t, got.above(bins), np.arange(n), n, depth)
        assert (code[leaves // 2] == 0).sum() == (leaves[code[leaves // 2] == 0] % 2 == 0).sum()
    with pytest.raises(ValueError):
        trees.grow(spark.createDataFrame(cells).limit(0), cuts, count, depth, 4, 5)


def test_draws_are_those_of_a_poisson_of_mean_one():
    w = np.concatenate([trees.draws(np.arange(200_000, dtype=np.uint64) * np.uint64(3), t) for t in (0, 4)], 1)
    assert w.mean() == pytest.approx(1, abs=0.01) and w.var() == pytest.approx(1, abs=0.01)
    assert np.abs(np.corrcoef(w.T) - np.eye(8)).max() < 0.01


def test_forest_does_not_depend_on_how_rows_are_dealt(spark):
    """Draws go by store and period, not by the place of a row in its partition; rows with equal keys draw apart."""
    df = spark.createDataFrame(frame(23, 30, 20, 20))
    split = splits.split_last_k(df.union(df.where("store_number = 's1'")), CFG)
    one, many = (
        {tuple(r)[:-1]: r[-1] for r in forest.fit_forest(d, CFG, trees=10).select("_store", "fiscal_year", "fiscal_period", "split", "label", "prediction").collect()}
        for d in (split.coalesce(1), split.repartition(7))
    )
    assert one.keys() == many.keys()
    assert [many[r] for r in one] == pytest.approx(list(one.values()), rel=1e-9)
    model, cells = forest.fit_model(split, CFG, trees=10)
    assert cells.select("key").distinct().count() == cells.count() == 31 * 20


def test_forest_importance_equals_scoring_every_swapped_row(spark):
    split = splits.split_last_k(spark.createDataFrame(frame(24, 12, 20, 20)), CFG)
    got = {r["feature"]: r["mae_increase"] for r in forest.forest_importance(split, CFG, trees=10, repeats=3).collect()}
    model, cells = forest.fit_model(split, CFG, trees=10)
    valid = cells.where("split = 'valid'").withColumnsRenamed({"_store": "store_number", "_fy": "fiscal_year", "_fp": "fiscal_period"})
    mixed = importance.permuted(valid, ["f0", "f1"], CFG, 3).toPandas()
    assert len(mixed) == 3 * 72
    known = model.known.value

    def error(columns):
        return np.abs(mixed["label"] - known.predict(trees.binned(known.cuts, [mixed[c] for c in columns]))).mean()

    base = error(["f0", "f1", "f2"])
    assert got["x1"] == pytest.approx(error(["shuffled_0", "f1", "f2"]) - base, rel=1e-9)
    assert got["x2"] == pytest.approx(error(["f0", "shuffled_1", "f2"]) - base, rel=1e-9)


def test_store_effects_do_not_add_up_the_rows_again(spark):
    """Effects are read from the staged sums of the fit."""
    pdf = frame(4, 6, 20, 30)
    df = spark.createDataFrame(pdf)
    for model in (ridge.train(df, CFG), ridge.fit(df, CFG)):
        assert "Aggregate" not in model.effects._jdf.queryExecution().optimizedPlan().toString()
        assert model.effects.count() == 6
