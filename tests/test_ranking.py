import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tillcast.operators import peers, ranking


@pytest.mark.parametrize("accuracy,small", [(100, 300), (10_000, 100), (10_000, 10_000)])
def test_exact_percentiles_with_any_sketch(spark, accuracy, small):
    """A coarse sketch misses its ranks by far; rounds of narrowing still end at the exact values."""
    rng = np.random.default_rng(accuracy)
    vals = np.concatenate([rng.normal(0, 1e6, 4000), np.full(3000, 7.0), rng.integers(0, 9, 2001).astype(float)])
    pdf = pd.DataFrame({"g": rng.integers(0, 3, len(vals)), "v": vals})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(0, None), (None, 2.0), (None, 4.0), (9, 5.0)], "g long, v double")).repartition(5)
    probs = {"p10": 0.1, "m": 0.5, "p90": 0.9, "lo": 0.0, "hi": 1.0}
    got = ranking.exact_percentiles(df, "v", probs, (), accuracy, small).first()
    assert list(got) == pytest.approx(list(np.percentile([*vals, 2.0, 4.0, 5.0], [10, 50, 90, 0, 100])), rel=1e-12)
    per = {r["g"]: r for r in ranking.exact_percentiles(df, "v", {"m": 0.5, "q": 0.25}, ["g"], accuracy, small).collect()}
    for g, part in pdf.groupby("g"):
        assert per[g]["m"] == pytest.approx(np.median(part.v), rel=1e-12)
        assert per[g]["q"] == pytest.approx(np.percentile(part.v, 25), rel=1e-12)
    assert (per[None]["m"], per[None]["q"], per[9]["m"], len(per)) == (3.0, 2.5, 5.0, 5)


def test_percentiles_of_large_even_group(spark):
    """Two ranks on both sides of a cut, a value that half of all rows share, and a value on either end."""
    vals = [1.0] * 30_000 + [2.0] * 30_000 + [float(i) for i in range(-500, 0)] + [float(i) for i in range(10, 510)]
    df = spark.createDataFrame(pd.DataFrame({"v": vals})).repartition(4)
    got = ranking.exact_percentiles(df, "v", {"m": 0.5, "p1": 0.01}, (), 100, 50).first()
    assert list(got) == pytest.approx(list(np.percentile(vals, [50, 1])))


@pytest.mark.parametrize("few", [0, 4096])
def test_percentiles_of_few_hot_groups(spark, few):
    """Rows are neither gathered by group nor sorted with the ranks of their bracket, for few and for many brackets."""
    pdf = pd.DataFrame({"g": ["a"] * 3000 + ["b"] * 9, "v": [float(i * i % 3001) for i in range(3000)] + [2.0] * 9})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(None, 4.0), (None, 6.0)], "g string, v double"))
    got = ranking.exact_percentiles(df, "v", {"m": 0.5, "p9": 0.9}, ["g"], 100, 50, few)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert ("_part" in plan) == (few == 0) and ("SortMergeJoin" in plan) == (few == 0)
    per = {r["g"]: (r["m"], r["p9"]) for r in got.collect()}
    assert per == {"a": pytest.approx(tuple(np.percentile(pdf.v[:3000], [50, 90]))), "b": (2.0, 2.0), None: (5.0, pytest.approx(5.8))}


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([], "v double")
    assert ranking.exact_median(empty, "v").collect() == []


def test_distributed_row_number(spark):
    df = spark.range(5000).withColumn("k", F.md5(F.col("id").cast("string"))).withColumn("b", ranking.hash_block("k", 2))
    got = ranking.distributed_row_number(df, "b", ["k"], "rn").orderBy("k").collect()
    assert [r["rn"] for r in got] == list(range(1, 5001))


def brute(clusters, cohorts, k=3):
    long = {s for s, c in cohorts.items() if c == "long"}
    out = []
    for s, (x, y, g) in clusters.items():
        if cohorts[s] == "short":
            near = sorted(((clusters[p][0] - x) ** 2 + (clusters[p][1] - y) ** 2, p) for p in long if clusters[p][2] == g)[:k]
            out += [(s, i + 1, p) for i, (_, p) in enumerate(near)]
    return sorted(out)


def peers_of(spark, clusters, cohorts):
    cl = spark.createDataFrame([(s, *v) for s, v in clusters.items()], "store_number string, pc1 double, pc2 double, cluster int")
    return peers.nearest_peers(cl, spark.createDataFrame(list(cohorts.items()), "store_number string, cohort string"))


@pytest.mark.parametrize("seed,leaf", [(0, 8), (1, 1)])
def test_nearest_peers_equals_brute_force(spark, seed, leaf, monkeypatch):
    """Piles on one place, a lattice with many equal distances, a dense clump, a far store, a small cluster."""
    monkeypatch.setattr(peers, "LEAF", leaf)
    rng = np.random.default_rng(seed)
    clusters, cohorts = {}, {}
    for i in range(500):
        if i % 4 == 0:
            x, y = 0.5, -0.25
        elif i % 4 == 1:
            x, y = float(rng.integers(0, 8)) / 4, float(rng.integers(0, 8)) / 4
        elif i % 4 == 2:
            x, y = float(rng.normal(5, 3)), float(rng.normal(0, 1))
        else:
            x, y = 2 + float(rng.normal(0, 1e-6)), 1 + float(rng.normal(0, 1e-6))
        clusters[f"s{i:03d}"] = (x, y, int(rng.integers(0, 2)) if i < 490 else 2)
        cohorts[f"s{i:03d}"] = "short" if rng.random() < 0.4 else "long"
    clusters["far"], cohorts["far"] = (1e9, -1e9, 0), "long"
    clusters["lone"], cohorts["lone"] = (0.0, 0.0, 7), "short"
    got = rows(peers_of(spark, clusters, cohorts))
    assert got == brute(clusters, cohorts)


def test_nearest_peers_of_equal_stores(spark):
    """A cluster of 5,000 equal stores: every short one gets the first three long ids."""
    clusters = {f"s{i:04d}": (1.5, 2.5, 0) for i in range(5000)}
    cohorts = {s: "short" if i % 3 == 0 else "long" for i, s in enumerate(sorted(clusters))}
    got = peers_of(spark, clusters, cohorts).groupBy("peer_rank", "peer").count().collect()
    assert sorted((r["peer_rank"], r["peer"], r["count"]) for r in got) == [(i + 1, f"s000{j}", 1667) for i, j in enumerate((1, 2, 4))]


def test_peers_of_nothing(spark):
    cl = spark.createDataFrame([("a", 1.0, None, 0), ("b", 1.0, 1.0, 0)], "store_number string, pc1 double, pc2 double, cluster int")
    co = spark.createDataFrame([("a", "short"), ("b", "long")], "store_number string, cohort string")
    assert peers.nearest_peers(cl, co).collect() == []
    assert peers.nearest_peers(cl.limit(0), co).collect() == []


def test_components_match_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(100, 30, (60, 1)) * [1, 0.2, 0, 0] + rng.normal(0, 5, (60, 4))
    df = spark.createDataFrame([(f"s{i}", *map(float, v)) for i, v in enumerate(x)], ["store_number", *peers.PROFILE])
    got = {r["store_number"]: (r["pc1"], r["pc2"]) for r in peers.pca_scores(df).collect()}
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    values, vectors = np.linalg.eigh(np.corrcoef(x.T))
    loads = vectors[:, ::-1][:, :2]
    want = z @ (loads * np.where(loads[0] < 0, -1, 1))
    for i in range(60):
        assert got[f"s{i}"] == pytest.approx(tuple(want[i]), rel=1e-9, abs=1e-9)
    flat = df.withColumn(peers.PROFILE[1], F.lit(3.0))
    assert peers.pca_scores(flat).where("isnan(pc1) OR pc1 IS NULL").count() == 0


def test_clusters_are_ordered_and_complete(spark):
    rng = np.random.default_rng(3)
    data = [(f"s{i}", float(m + rng.normal(0, 5))) for i, m in enumerate([100] * 20 + [500] * 20 + [900] * 20) for _ in range(15)]
    prof = peers.store_profile(spark.createDataFrame(data, "store_number string, total_net_sales double"))
    out = peers.locked_clusters(peers.pca_scores(prof))
    assert out.count() == 60
    centers = {r["cluster"]: r["x"] for r in out.groupBy("cluster").agg(F.avg("pc1").alias("x")).collect()}
    assert sorted(centers) == [0, 1, 2] and centers[0] < centers[1] < centers[2]


def test_peer_scaled_forecast(spark):
    hist = [("short", 2000, p, 10.0) for p in range(1, 4)] + [("a", 2000, p, 20.0 if p <= 10 else 999.0) for p in range(1, 13)]
    hist += [("b", 2000, p, 30.0) for p in range(1, 12)] + [("z", 2000, 1, 0.0), ("nohist", 2000, 1, None)]
    h = spark.createDataFrame(hist, "store_number string, fiscal_year int, fiscal_period int, actual double")
    fc = spark.createDataFrame([("a", 2001, 1, 100.0), ("b", 2001, 1, 200.0), ("a", 2001, 2, None), ("b", 2001, 2, 50.0), ("z", 2001, 1, 5.0)], "store_number string, fiscal_year int, fiscal_period int, forecast double")
    axis = fc.select("fiscal_year", "fiscal_period").distinct()
    wide = spark.createDataFrame([("short", "a", " b ", "nan"), ("nohist", "a", "", None), ("zeros", "z", None, None)], "store_number string, peer1 string, peer2 string, peer3 string")
    long = peers.peers_long(wide)
    assert rows(long) == [("nohist", 1, "a"), ("short", 1, "a"), ("short", 2, "b"), ("zeros", 1, "z")]
    got = rows(peers.peer_scaled_forecast(h, fc, long, axis))
    assert got == [("short", 2001, 1, pytest.approx(10 / 25 * 150), "peer"), ("short", 2001, 2, pytest.approx(10 / 25 * 50), "peer")]
    assert rows(peers.peers_wide(long).where("store_number = 'short'")) == [("short", "a", "b", None)]
