"""Random forest on the ridge's design and split, as a comparison."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StructField, StructType

from tillcast.config import ForecastConfig
from tillcast.functions.casts import col
from tillcast.functions.stats import wape
from tillcast.operators.importance import permuted
from tillcast.operators.ranking import exact_percentiles
from tillcast.operators.ridge import x_sql
from tillcast.operators.trees import PART, PIECE, Trees, as_cells, binned, feature_cuts, from_cells, grow
from tillcast.sources.staging import staged


def _design(split: DataFrame, cfg: ForecastConfig) -> DataFrame:
    """Features as numbers f0, f1, ...; the last is the store's mean in training, else the mean of all.

    So a store is one number however many there are, and a store without training rows has one too.
    """
    rows = split.where(F.col("split").isNotNull()).selectExpr(
        f"`{cfg.store_col}` AS _store", cfg.fy, cfg.fp, "split", f"CAST(`{cfg.target}` AS DOUBLE) AS label",
        *[f"{x_sql(f)} AS f{i}" for i, f in enumerate(cfg.feature_list)],
    )
    train = rows.where("split = 'train'")
    mean = train.groupBy("_store").agg(F.avg("label").alias("_code"))
    code = F.coalesce("_code", train.agg(F.avg("label")).scalar())
    return rows.join(mean, "_store", "left").withColumn(f"f{len(cfg.feature_list)}", code).drop("_code")


def _scored_in_pieces(batches, size: int = PIECE):
    """Batches of about `size` rows."""
    held, n = [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, size):
            held.append(batch.slice(i, size))
            n += held[-1].num_rows
            if n >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class ForestModel:
    """A fitted forest."""

    def __init__(self, spark, trees: Trees):
        self.known = spark.sparkContext.broadcast(trees)
        self.cuts = trees.cuts

    def transform(self, rows: DataFrame) -> DataFrame:
        """`rows`, which have the column `cell`, with their prediction."""
        known, k, names = self.known, len(self.cuts), [*rows.columns, "prediction"]

        def scored(batches):
            for batch in _scored_in_pieces(batches):
                found = known.value.predict(from_cells(batch["cell"], k))
                yield pa.record_batch([*batch.columns, pa.array(found, pa.float64())], names=names)

        return rows.mapInArrow(scored, StructType([*rows.schema, StructField("prediction", DoubleType())]))


def _celled(rows: DataFrame, cuts: list[np.ndarray], parts: int) -> DataFrame:
    """`rows` with the bins of their features as `cell`, in order of cells and dealt evenly.

    `key` is a digest of the row's store and period, and of its number among rows that share them.
    """
    names = [f"f{i}" for i in range(len(cuts))]
    same = Window.partitionBy("_store", "_fy", "_fp").orderBy("label", *names)
    keyed = rows.withColumn("key", F.xxhash64("_store", "_fy", "_fp", F.row_number().over(same)))

    def with_cell(batches):
        for batch in batches:
            bins = binned(cuts, [batch[n].to_numpy(zero_copy_only=False) for n in names])
            yield pa.record_batch([*batch.columns, as_cells(bins)], names=[*batch.schema.names, "cell"])

    celled = keyed.mapInArrow(with_cell, StructType([*keyed.schema, StructField("cell", BinaryType())]))
    return celled.repartitionByRange(parts, "cell", "key").sortWithinPartitions("cell", "key")


def fit_model(
    split: DataFrame, cfg: ForecastConfig = ForecastConfig(), trees: int = 400, depth: int = 8, leaf: int = 4, seed: int = 0
) -> tuple[ForestModel, DataFrame]:
    """(fitted forest, its input rows)."""
    spark, k = split.sparkSession, len(cfg.feature_list) + 1
    names = [f"f{i}" for i in range(k)]
    number = lambda c: F.coalesce(F.when(F.isnan(c), None).otherwise(F.col(c)), F.raise_error(F.lit(f"{c} of a forest's row is null or NaN")).cast("double"))
    design = _design(split, cfg).withColumnsRenamed({cfg.fy: "_fy", cfg.fp: "_fp"})
    label = F.when((F.col("split") == "valid") | ~F.isnan(F.coalesce("label", F.lit(float("nan")))), F.col("label"))
    label = label.otherwise(F.raise_error(F.lit("label of a forest's training row is null or NaN")).cast("double"))
    rows = staged(design.withColumns({"label": label, **{n: number(n) for n in names}}))
    cuts = feature_cuts(rows.where("split = 'train'"), names)
    parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // PART))
    rows = staged(_celled(rows, cuts, parts))
    return ForestModel(spark, grow(rows.where("split = 'train'"), cuts, trees, depth, leaf, seed)), rows


def split_table(rows: DataFrame, k: int, depth: int = 3, leaf: int = 4, bins: int = 8) -> DataFrame:
    """One regression tree on all `rows` (label, f0 .. f<k-1>): node, n, mean, feature, threshold, gain.

    Features are cut at their exact quantiles. A level is one aggregate of counts and sums by node,
    feature and bin; from these every split's drop in squared error is known, so no rows are sorted
    or gathered. The best split of a node has the largest share of the node's squared error (nine
    decimals), then the first feature and bin; both sides keep `leaf` rows. Children of node i are 2i
    (values up to the threshold) and 2i + 1. The tables that levels share have a row per node.
    """
    rows = staged(rows.where(F.col("label").isNotNull()).select("label", F.array(*[f"f{i}" for i in range(k)]).alias("x")))
    cells = rows.select(F.posexplode("x").alias("feature", "v"))
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    cuts = {r["feature"]: [r[q] for q in probs] for r in exact_percentiles(cells, "v", probs, ["feature"]).collect()}
    if not cuts:
        return rows.sparkSession.createDataFrame([], "node int, n long, mean double, feature int, threshold double, gain double")
    bin_of = lambda i: F.size(F.filter(F.array(*[F.lit(c) for c in cuts[i]]), lambda c: c < F.col("x")[i]))
    placed = staged(rows.select("label", F.array(*[bin_of(i) for i in range(k)]).alias("bins"), F.lit(1).alias("node")))
    threshold = F.array(*[F.array(*[F.lit(c) for c in cuts[i]]) for i in range(k)])
    out = None
    for level in range(depth + 1):
        cells = placed.where("node IS NOT NULL").select("node", "label", F.posexplode("bins").alias("feature", "bin"))
        sums = cells.groupBy("node", "feature", "bin").agg(F.count("*").alias("c"), F.sum("label").alias("s"), F.sum(F.col("label") * F.col("label")).alias("q"))
        of_feature = Window.partitionBy("node", "feature")
        upto = of_feature.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        left = {"nl": F.sum("c").over(upto), "sl": F.sum("s").over(upto)}
        total = {"n": F.sum("c").over(of_feature), "t": F.sum("s").over(of_feature), "tq": F.sum("q").over(of_feature)}
        seen = sums.withColumns({**left, **total})
        inner = F.col("sl") * F.col("sl") / F.col("nl") + F.try_divide((F.col("t") - F.col("sl")) * (F.col("t") - F.col("sl")), F.col("n") - F.col("nl"))
        parent = F.col("t") * F.col("t") / F.col("n")
        fits = (F.col("nl") >= leaf) & (F.col("n") - F.col("nl") >= leaf) & F.lit(level < depth)
        seen = seen.withColumn("gain", F.when(fits, F.round(F.try_divide(inner - parent, F.col("tq") - parent), 9)))
        order = [F.col("gain").desc_nulls_last(), F.col("feature"), F.col("bin")]
        best = seen.withColumn("_i", F.row_number().over(Window.partitionBy("node").orderBy(*order))).where("_i = 1")
        splits = F.col("gain") > 0
        best = staged(best.select(
            "node", "n", (F.col("t") / F.col("n")).alias("mean"), F.when(splits, F.col("feature")).alias("feature"),
            F.when(splits, F.col("bin")).alias("bin"), F.when(splits, threshold[F.col("feature")][F.col("bin")]).alias("threshold"), F.when(splits, F.col("gain")).alias("gain"),
        ))
        out = best if out is None else out.unionByName(best)
        ways = F.broadcast(best.where("feature IS NOT NULL").select("node", "feature", "bin"))
        child = F.col("node") * 2 + F.when(F.get("bins", F.col("feature")) <= F.col("bin"), 0).otherwise(1)
        placed = placed.join(ways, "node", "left").select("label", "bins", F.when(F.col("feature").isNotNull(), child).alias("node"))
    return out.select("node", "n", "mean", "feature", "threshold", "gain")


def tree_table(split: DataFrame, cfg: ForecastConfig = ForecastConfig(), **how) -> DataFrame:
    """`split_table` of the forest's training rows; features by name, `store mean` the last."""
    names = [*cfg.feature_list, "store mean"]
    table = split_table(_design(split, cfg).where("split = 'train'"), len(names), **how)
    return table.withColumn("feature", F.get(F.array(*[F.lit(n) for n in names]), F.col("feature")))


def fit_forest(split: DataFrame, cfg: ForecastConfig = ForecastConfig(), trees: int = 400, **how) -> DataFrame:
    """Scored rows (_store, split, label, features, prediction)."""
    model, rows = fit_model(split, cfg, trees, **how)
    features = F.array(*[f"f{i}" for i in range(len(model.cuts))]).alias("features")
    return model.transform(rows.select("_store", F.col("_fy").alias(cfg.fy), F.col("_fp").alias(cfg.fp), "split", "label", features, "cell")).drop("cell")


def forest_errors(scored: DataFrame) -> DataFrame:
    return scored.groupBy("split").agg(wape("label", "prediction").alias("wape"), F.count(col("label")).alias("rows"))


def forest_importance(
    split: DataFrame, cfg: ForecastConfig = ForecastConfig(), trees: int = 400, repeats: int = 8, **how
) -> DataFrame:
    """(feature, mae_increase) on the validation rows.

    Columns are shuffled by the same block-numbered join as for the linear model. A shuffled row is
    scored once per feature, with that feature's value swapped; rows of one cell come together, so equal
    swaps are scored once.
    """
    model, rows = fit_model(split, cfg, trees, **how)
    keys = {"_store": cfg.store_col, "_fy": cfg.fy, "_fp": cfg.fp}
    valid = rows.where("split = 'valid'").withColumnsRenamed(keys)
    k, known = len(cfg.feature_list), model.known
    cells = [f"f{i}" for i in range(k)]
    shuffled = [f"shuffled_{i}" for i in range(k)]
    parts = max(split.sparkSession.sparkContext.defaultParallelism, -(-valid.count() * repeats // PART))
    mixed = permuted(valid.select(*keys.values(), "label", "cell", *cells), cells, cfg, repeats).select("label", "cell", *shuffled)
    mixed = mixed.repartitionByRange(parts, "cell", *shuffled)

    def errors(batches):
        n, e = np.zeros((2, k))
        for batch in _scored_in_pieces(batches):
            own = from_cells(batch["cell"], k + 1)
            other = binned(known.value.cuts, [batch[c].to_numpy(zero_copy_only=False) for c in shuffled])
            swapped = np.repeat(own[None], k, 0)
            for i in range(k):
                swapped[i, :, i] = other[:, i]
            label = batch["label"].to_numpy(zero_copy_only=False)
            off = np.abs(label - known.value.predict(swapped.reshape(-1, k + 1)).reshape(k, -1))
            has = ~batch["label"].is_null().to_numpy(zero_copy_only=False)
            n, e = n + has.sum(), e + off[:, has].sum(1)
        yield pa.record_batch([pa.array(np.arange(k), pa.int32()), pa.array(n, pa.float64()), pa.array(e, pa.float64())], names=["_swap", "n", "e"])

    base = model.transform(valid.select("label", "cell")).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).scalar()
    names = F.array(*[F.lit(f) for f in cfg.feature_list])
    sums = mixed.mapInArrow(errors, "_swap int, n double, e double").groupBy("_swap").agg(F.sum("e").alias("e"), F.sum("n").alias("n")).where("n > 0")
    return sums.select(F.get(names, F.col("_swap")).alias("feature"), (F.col("e") / F.col("n") - base).alias("mae_increase"))
