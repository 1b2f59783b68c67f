"""Table and file inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillcast.functions.names import store_column

_READERS = {"csv": "csv", "parquet": "parquet"}


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table; filters and column choice written later still reach its scan."""
    return spark.read.table(name)


def read_any(
    spark: SparkSession, source: DataFrame | str, schema: T.StructType | str | None = None
) -> DataFrame:
    """A DataFrame as it is, or a CSV/Parquet path. Spreadsheets have to be converted first."""
    if isinstance(source, DataFrame):
        return source
    ext = source.rstrip("/").rsplit(".", 1)[-1].lower()
    if ext in ("xls", "xlsx"):
        raise ValueError(f"convert {source} to CSV or Parquet before the job")
    if ext not in _READERS:
        raise ValueError(f"unsupported file type: {source}")
    reader = spark.read.format(_READERS[ext])
    if ext == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source)


def read_first_table(
    spark: SparkSession, path: str | None, schema: T.StructType | str | None = None
) -> DataFrame:
    """First CSV or Parquet file of a folder by name, or the file itself; no path gives no rows.

    The folder is listed through the binaryFile source with only the path selected, so it works on
    any file system Spark reads and no file content is loaded.
    """
    if path is None:
        return spark.createDataFrame([], schema or T.StructType())
    if path.rstrip("/").rsplit(".", 1)[-1].lower() in (*_READERS, "xls", "xlsx"):
        return read_any(spark, path, schema)
    first = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.{csv,CSV,parquet,PARQUET,xls,XLS,xlsx,XLSX}")
        .load(path)
        .agg(F.min("path").alias("path"))
        .first()["path"]
    )
    if first is None:
        raise ValueError(f"no table file in {path}")
    return read_any(spark, first, schema)


def promote_header(df: DataFrame, order_col: str) -> DataFrame:
    """Column names taken from the first data row by `order_col`; that row leaves the data.

    Only that one row is fetched, because names belong to the plan and not to the data.
    """
    top = df.orderBy(order_col).limit(1).first()
    body = df.where(F.col(order_col) != F.lit(top[order_col])).drop(order_col)
    return body.toDF(*[str(top[c]).strip() for c in df.columns if c != order_col])


def read_features(spark: SparkSession, source: DataFrame | str) -> DataFrame:
    """Engineered features with the store column, whatever it is called, as store_number."""
    df = read_any(spark, source)
    return df.withColumnRenamed(store_column(df), "store_number")
