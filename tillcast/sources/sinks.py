"""Outputs: feature files, feature store, CSV reports, model tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.config import ForecastConfig
from tillcast.operators.ridge import RidgeModel
from tillcast.sources.staging import staged


def write_features(df: DataFrame, path: str, partition_by: str = "fiscal_year") -> None:
    """Overwrites a Parquet folder, one sub-folder per fiscal year.

    The rebalance hint gathers a year's rows into few files, while a year that holds much of the data
    is still split over many tasks.
    """
    spread = df.hint("rebalance", partition_by)
    spread.write.mode("overwrite").partitionBy(partition_by).parquet(path)


def append_features(df: DataFrame, path: str) -> None:
    """Adds one batch to the offline feature table."""
    df.hint("rebalance", "fiscal_year").write.mode("append").partitionBy("fiscal_year").parquet(path)


def upsert_features(df: DataFrame, path: str, key: str = "record_id", order: str = "event_time", partition_by: str = "fiscal_year") -> None:
    """Brings a batch into the feature table: the newest row of every key, each key once.

    Only the partitions that the batch touches are read and replaced, so the work grows with them and
    not with the table, and the same batch once more leaves the table as it is. Of rows equally new,
    the batch's wins. The key decides the partition (a record's fiscal year is part of its id). The
    merged rows are staged before old files go, so a job that fails can run again.
    """
    spark = df.sparkSession
    batch = staged(latest_per_key(df, key, [order]).withColumn("_new", F.lit(1)))
    touched = [r[0] for r in batch.select(partition_by).distinct().collect()]  # fiscal years
    if not touched:
        return
    merged = batch
    if not _nothing_at(spark, path):
        old = spark.read.schema(df.schema).parquet(path).where(F.col(partition_by).isin(touched))
        merged = batch.unionByName(old.withColumn("_new", F.lit(0)))
    newest = staged(latest_per_key(merged, key, [order, "_new"]).select(*df.columns))
    spread = newest.hint("rebalance", partition_by)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def _nothing_at(spark: SparkSession, path: str) -> bool:
    try:
        return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).isEmpty()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return True
        raise


def latest_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row of every key: what an online feature store serves.

    max_by folds on the map side, so a key with very many versions never fills one task.
    """
    rest = [c for c in df.columns if c != key]
    newest = F.max_by(
        F.struct(*[F.col(f"`{c}`") for c in rest]), F.struct(*[F.col(f"`{c}`") for c in order])
    )
    return df.groupBy(key).agg(newest.alias("_r")).select(key, "_r.*")


def feature_definitions(df: DataFrame, record_id: str, event_time: str) -> list[tuple[str, str]]:
    """(feature name, feature type) of every column, from the schema alone."""

    def kind(field: T.StructField) -> str:
        if field.name == record_id:
            return "String"
        if field.name == event_time:
            return "Fractional"
        if isinstance(field.dataType, T.IntegralType):
            return "Integral"
        if isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
            return "Fractional"
        return "String"

    return [(f.name, kind(f)) for f in df.schema.fields]


def write_report(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """CSV with one header row. Sorting happens here and only here."""
    out = df.orderBy(*order) if order else df
    out.write.mode("overwrite").option("header", True).csv(path)


_SCALARS = {"target": "string", "store_col": "string", "alpha": "double", "min_history_train": "int", "min_history_eval": "int", "holdout_k": "int", "super_bowl_col": "string"}
_LISTS = ("feature_list", "time_cols", "exclude_stores")


def config_table(spark: SparkSession, cfg: ForecastConfig) -> DataFrame:
    """A configuration as a table of one typed row."""
    cells = [F.lit(getattr(cfg, n)).cast(t).alias(n) for n, t in _SCALARS.items()]
    lists = [F.array(*[F.lit(str(v)) for v in getattr(cfg, n)]).cast("array<string>").alias(n) for n in _LISTS]
    return spark.range(1).select(*cells, *lists)


def config_of(table: DataFrame) -> ForecastConfig:
    row = table.first()
    return ForecastConfig(**{n: row[n] for n in _SCALARS}, **{n: tuple(row[n]) for n in _LISTS})


def save_model(spark: SparkSession, model: RidgeModel, cfg: ForecastConfig, path: str) -> None:
    """Coefficients, store effects, metrics and config as four small tables."""
    terms = list(model.coefficients().items())
    spark.createDataFrame(terms, "term string, value double").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{path}/coefficients")
    model.effects.write.mode("overwrite").parquet(f"{path}/store_effects")
    spark.createDataFrame(
        list(model.metrics.items()), "metric string, value double"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")
    config_table(spark, cfg).write.mode("overwrite").parquet(f"{path}/config")


def load_model(spark: SparkSession, path: str) -> tuple[RidgeModel, ForecastConfig]:
    cfg = config_of(spark.read.parquet(f"{path}/config"))
    terms = {r["term"]: r["value"] for r in spark.read.parquet(f"{path}/coefficients").collect()}
    metrics = {r["metric"]: r["value"] for r in spark.read.parquet(f"{path}/metrics").collect()}
    model = RidgeModel(
        features=tuple(cfg.feature_list),
        intercept=terms["(intercept)"],
        weights=tuple(terms[f] for f in cfg.feature_list),
        alpha=cfg.alpha,
        store_col=cfg.store_col,
        effects=spark.read.parquet(f"{path}/store_effects"),
        metrics=metrics,
    )
    return model, cfg
