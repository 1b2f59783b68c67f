"""Store profiles, clusters, peers and peer-scaled forecasts for stores with little history."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.casts import finite_sql, to_double
from tillcast.operators.ranking import exact_percentiles
from tillcast.operators.splits import on_axis
from tillcast.sources.staging import staged

PROFILE = ("avg_net_sales", "std_net_sales", "cv_net_sales", "log_avg_net_sales")
KEYS = ["store_number", "fiscal_year", "fiscal_period"]
LEVELS = 16  # of the tree over the plane; each halves a cell's side twice
BITS = 2 * LEVELS
STAGED_LEVELS = 4  # steps down the tree that are planned together
LEAF = 8  # places of a cell that are measured one by one


def store_profile(df: DataFrame) -> DataFrame:
    """Mean, spread, row count, variation, log mean and most frequent state of each store."""
    prof = (
        df.withColumns({"store_number": F.trim(F.col("store_number").cast("string")), "_s": to_double("total_net_sales")})
        .groupBy("store_number")
        .agg(
            F.avg("_s").alias("avg_net_sales"),
            F.stddev_samp("_s").alias("std_net_sales"),
            F.count("*").alias("n_periods"),
            *([F.mode("State", deterministic=True).alias("State")] if "State" in df.columns else []),
        )
    )
    cv = finite_sql("try_divide(std_net_sales, avg_net_sales)")
    return prof.withColumns({"cv_net_sales": F.expr(cv), "log_avg_net_sales": F.log1p("avg_net_sales")})


def pca_scores(profile: DataFrame, k: int = 2) -> DataFrame:
    """(store_number, pc1..pck) of the standardized profile.

    One aggregate gives means, deviations and correlations; the eigenvectors of that 4 x 4 matrix are
    the components. A component's sign is arbitrary, so each is turned to grow with mean sales. A
    column without spread adds nothing.
    """
    known = staged(profile.na.drop(subset=list(PROFILE)))
    n = len(PROFILE)
    pairs = [(i, j) for i in range(n) for j in range(i)]
    stats = known.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(PROFILE)],
        *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(PROFILE)],
        *[F.covar_samp(PROFILE[i], PROFILE[j]).alias(f"c{i}_{j}") for i, j in pairs],
    ).first()
    spread = [stats[f"s{i}"] or 0.0 for i in range(n)]
    matrix = np.diag([float(s > 0) for s in spread])
    for i, j in pairs:
        if spread[i] > 0 and spread[j] > 0:
            matrix[i, j] = matrix[j, i] = stats[f"c{i}_{j}"] / (spread[i] * spread[j])
    values, vectors = np.linalg.eigh(matrix)
    loads = vectors[:, np.argsort(-values, kind="stable")[:k]].T
    loads = loads * np.where(loads[:, :1] < 0, -1.0, 1.0)
    z = [(F.col(c) - F.lit(stats[f"m{i}"])) / F.lit(spread[i]) if spread[i] > 0 else F.lit(0.0) for i, c in enumerate(PROFILE)]
    scores = [sum((z[i] * F.lit(float(w[i])) for i in range(1, n)), z[0] * F.lit(float(w[0]))) for w in loads]
    return staged(known.select("store_number", *[x.alias(f"pc{i + 1}") for i, x in enumerate(scores)]))


def locked_clusters(scores: DataFrame, k: int = 3, rounds: int = 6) -> DataFrame:
    """(store_number, pc1.., cluster): nearest-centre labels, numbered by the centres' coordinates.

    Centres start on the first component at its quantiles (i + 1/2) / k, at 0 on the others, and move
    to the means of their stores for `rounds` rounds or until they rest; a centre without stores
    stays. A round is one aggregate with k rows. Equal distances go to the earlier centre.
    """
    pcs = [c for c in scores.columns if c.startswith("pc")]
    first = exact_percentiles(scores, pcs[0], {f"q{i}": (i + 0.5) / k for i in range(k)}).first()
    if first is None:
        return scores.withColumn("cluster", F.lit(0))
    centres = [[first[f"q{i}"]] + [0.0] * (len(pcs) - 1) for i in range(k)]

    def nearest(at: list[list[float]]) -> Column:
        """The number of the nearest centre; as a constant array, so every round runs the same compiled code."""
        known = F.array(*[F.array(*[F.lit(float(x)) for x in centre]) for centre in at])

        def placed(centre: Column, i: Column) -> Column:
            return F.struct(sum((F.pow(F.col(c) - centre[j], 2) for j, c in enumerate(pcs)), F.lit(0.0)).alias("d"), i.alias("i"))

        return F.array_min(F.transform(known, placed))["i"]

    for _ in range(rounds):
        means = scores.groupBy(nearest(centres).alias("i")).agg(*[F.avg(c).alias(c) for c in pcs]).collect()
        moved = {r["i"]: [r[c] for c in pcs] for r in means}
        after = [moved.get(i, centre) for i, centre in enumerate(centres)]
        if after == centres:
            break
        centres = after
    order = sorted(range(k), key=lambda i: (centres[i], i))
    label = F.array(*[F.lit(order.index(i)) for i in range(k)])
    return scores.select("store_number", *pcs, F.get(label, nearest(centres)).alias("cluster"))


def _cells(points: DataFrame) -> DataFrame:
    """The cells of a tree over the points of each cluster: each level cuts a cell in 4 x 4.

    (cluster, level, cx, cy, n, box, leaf): stores and bounding box of every cell whose parent holds
    more than `LEAF` places. Level 0 is one cell for the whole cluster.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level")
    box = [f(c).alias(f"{f.__name__}_{c}") for c in ("x", "y") for f in (F.min, F.max)]
    at = F.col("level")
    each = points.select("cluster", "x", "y", "ix", "iy", F.size("ids").alias("n"), level)
    shift = F.expr(f"{BITS} - 2 * level")
    cells = each.groupBy("cluster", "level", F.call_function("shiftright", "ix", shift).alias("cx"), F.call_function("shiftright", "iy", shift).alias("cy")).agg(
        F.sum("n").alias("n"), F.count("*").alias("places"), *box
    )
    cells = cells.withColumns({"leaf": (F.col("places") <= LEAF) | (at == LEVELS), "px": F.shiftright("cx", 2), "py": F.shiftright("cy", 2)})
    siblings = F.sum("places").over(Window.partitionBy("cluster", "level", "px", "py"))  # the places of the parent
    return cells.withColumn("_parent", siblings).where((at == 0) | (F.col("_parent") > LEAF)).drop("_parent")


def _closest(spots: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """(cluster, x, y, near): for each spot the k stores (d, peer) nearest in its cluster's points.

    Spots walk down the tree level by level. The cells a spot still holds bound the distance of its
    k-th neighbour from above by their farthest corners; cells whose nearest edge lies beyond go, the
    others give way to their children. So few cells follow a spot down, wherever the stores pile up,
    and only the points of its last cells are measured.
    """
    tree = staged(_cells(points))
    deepest = tree.where("NOT leaf").agg(F.max("level")).first()[0]
    cell = "struct(level, cx, cy, n, min_x, max_x, min_y, max_y, leaf) AS c"
    spot = ["cluster", "x", "y"]
    edge = " + ".join(f"pow(greatest(c.min_{v} - {v}, {v} - c.max_{v}, 0D), 2)" for v in "xy")
    corner = " + ".join(f"pow(greatest(abs({v} - c.min_{v}), abs(c.max_{v} - {v})), 2)" for v in "xy")
    upto = "PARTITION BY cluster, x, y ORDER BY high, c.level, c.cx, c.cy ROWS UNBOUNDED PRECEDING"

    def pruned(held: DataFrame) -> DataFrame:
        far = held.selectExpr(*spot, "c", f"{edge} AS low", f"{corner} AS high")
        far = far.selectExpr(*spot, "c", "low", f"IF(sum(c.n) OVER ({upto}) >= {k}, high, NULL) AS enough")
        far = far.selectExpr(*spot, "c", "low", "min(enough) OVER (PARTITION BY cluster, x, y) AS bound")
        return far.where("bound IS NULL OR low <= bound").select(*spot, "c")

    held = spots.join(tree.where("level = 0").selectExpr("cluster", cell), "cluster")
    for level in range(0 if deepest is None else deepest + 1):
        children = tree.where(F.col("level") == level + 1).selectExpr("cluster", "px", "py", cell).withColumnRenamed("c", "child")
        own = held.selectExpr(*spot, "c", "IF(c.leaf, NULL, c.cx) AS px", "IF(c.leaf, NULL, c.cy) AS py")
        held = pruned(own.join(children, ["cluster", "px", "py"], "left").selectExpr(*spot, "coalesce(child, c) AS c"))
        if level % STAGED_LEVELS == STAGED_LEVELS - 1:
            held = staged(held)
    held = held.selectExpr(*spot, "c.level AS level", "c.cx AS cx", "c.cy AS cy")
    leaves = tree.where("leaf").select("cluster", "level", "cx", "cy")
    shift = F.expr(f"{BITS} - 2 * level")
    in_leaf = points.select("cluster", "ids", F.col("x").alias("px"), F.col("y").alias("py"), "ix", "iy", F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level"))
    in_leaf = in_leaf.withColumns({"cx": F.call_function("shiftright", "ix", shift), "cy": F.call_function("shiftright", "iy", shift)}).join(leaves, ["cluster", "level", "cx", "cy"])
    met = held.join(in_leaf.select("cluster", "level", "cx", "cy", "px", "py", "ids"), ["cluster", "level", "cx", "cy"])
    d = (F.col("px") - F.col("x")) * (F.col("px") - F.col("x")) + (F.col("py") - F.col("y")) * (F.col("py") - F.col("y"))
    each = met.select(*spot, d.alias("d"), F.explode("ids").alias("peer"))
    best = Window.partitionBy(*spot).orderBy("d", "peer")
    return each.withColumn("peer_rank", F.row_number().over(best)).where(F.col("peer_rank") <= k)


def nearest_peers(clusters: DataFrame, cohorts: DataFrame, max_peers: int = 3) -> DataFrame:
    """(store_number, peer_rank, peer): for each short-history store the long-history stores of its
    cluster that are closest in the plane of the first two components; equal distances go to the
    smaller id.

    A cluster can hold a third of all stores, so pairs are never enumerated: long stores lie in the
    cells of a tree, and short stores only meet the points of the few cells that can hold one of
    their peers. At one place only the first `max_peers` ids can win, so heaps of identical stores
    are cut to those, and short stores at one place look once. Stores without scores have no peers.
    """
    y = "pc2" if "pc2" in clusters.columns else None
    placed = clusters.select("store_number", "cluster", F.col("pc1").alias("x"), (F.col(y) if y else F.lit(0.0)).alias("y"))
    placed = staged(placed.join(cohorts.select("store_number", "cohort"), "store_number").na.drop(subset=["cluster", "x", "y"]))
    at = Window.partitionBy("cluster", "x", "y").orderBy("store_number")
    longs = placed.where("cohort = 'long'").withColumn("_i", F.row_number().over(at)).where(F.col("_i") <= max_peers)
    points = longs.groupBy("cluster", "x", "y").agg(F.collect_list("store_number").alias("ids"))
    box = points.groupBy("cluster").agg(
        F.min("x").alias("x0"), F.min("y").alias("y0"), F.greatest(F.max("x") - F.min("x"), F.max("y") - F.min("y")).alias("side")
    )
    step = lambda c: F.coalesce(
        F.least(F.floor((F.col(c) - F.col(f"{c}0")) / F.nullif(F.col("side"), F.lit(0.0)) * float(1 << BITS)), F.lit((1 << BITS) - 1)), F.lit(0)
    ).cast("long")
    points = staged(points.join(box, "cluster").select("cluster", "x", "y", "ids", step("x").alias("ix"), step("y").alias("iy")))
    shorts = staged(placed.where("cohort = 'short'").select("store_number", "cluster", "x", "y"))
    near = _closest(shorts.select("cluster", "x", "y").distinct(), points, max_peers)
    return shorts.join(near, ["cluster", "x", "y"]).select("store_number", "peer_rank", "peer")


def peers_wide(peers: DataFrame, max_peers: int = 3) -> DataFrame:
    """(store_number, peer1, peer2, ...)."""
    cols = [F.max(F.when(F.col("peer_rank") == i, F.col("peer"))).alias(f"peer{i}") for i in range(1, max_peers + 1)]
    return peers.groupBy("store_number").agg(*cols)


def peers_long(wide: DataFrame) -> DataFrame:
    """Wide peers to rows; blank and 'nan' entries mean no peer."""
    names = [c for c in wide.columns if c.startswith("peer")]
    long = wide.select(
        F.trim(F.col("store_number").cast("string")).alias("store_number"),
        *[F.trim(F.col(c).cast("string")).alias(c) for c in names],
    ).unpivot(["store_number"], names, "_n", "peer")
    rank = F.regexp_replace("_n", "[^0-9]", "").cast("int").alias("peer_rank")
    usable = F.col("peer").isNotNull() & (F.col("peer") != "") & (F.lower("peer") != "nan")
    return long.where(usable).select("store_number", rank, "peer")


def early_mean(hist: DataFrame, first: int = 10) -> DataFrame:
    """(store_number, early_mean): average of a store's first non-null actuals in period order."""
    order = Window.partitionBy("store_number").orderBy("fiscal_year", "fiscal_period", "actual")
    known = hist.na.drop(subset=["fiscal_year", "fiscal_period", "actual"])
    top = known.withColumn("_i", F.row_number().over(order)).where(F.col("_i") <= first)
    return top.groupBy("store_number").agg(F.avg("actual").alias("early_mean"))


def peer_scaled_forecast(
    hist: DataFrame, fc: DataFrame, peers: DataFrame, axis: DataFrame, name: str = "forecast"
) -> DataFrame:
    """Peers' mean forecast on the axis, scaled by own early mean over the peers' early mean.

    Stores without history, without a peer history, or with a zero divisor get no rows.
    """
    early = staged(early_mean(hist))
    scale = (
        peers.join(early.toDF("peer", "_pm"), "peer")
        .groupBy("store_number")
        .agg(F.avg("_pm").alias("_peers"))
        .join(early, "store_number")
        .where(F.col("_peers") != 0)
        .select("store_number", (F.col("early_mean") / F.col("_peers")).alias("_scale"))
    )
    on = on_axis(fc, axis).select(F.col("store_number").alias("peer"), "fiscal_year", "fiscal_period", F.col(name).alias("_f"))
    mean = (
        peers.join(on.where(F.col("_f").isNotNull()), "peer")
        .groupBy(*KEYS)
        .agg(F.avg("_f").alias("_f"))
    )
    return mean.join(scale, "store_number").select(
        *KEYS, (F.col("_scale") * F.col("_f")).alias("forecast"), F.lit("peer").alias("source")
    )
