"""Data-quality counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.casts import col


def column_health(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, rows, nulls, low, high) in one pass; low and high are text."""
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.count("*").alias("rows"),
            F.count(F.when(col(c).isNull(), 1)).alias("nulls"),
            F.min(col(c)).cast("string").alias("low"), F.max(col(c)).cast("string").alias("high"),
        )
        for c in cols
    ])
    return df.agg(cells.alias("c")).select(F.inline("c"))


def periods_per_year(df: DataFrame, value: str | None = None) -> DataFrame:
    """Distinct fiscal periods per year and, with `value`, how many of them have one."""
    have = F.max(F.when(col(value).isNotNull(), 1).otherwise(0)) if value else F.lit(1)
    periods = df.groupBy("fiscal_year", "fiscal_period").agg(have.alias("_v"))
    known = periods.where(F.col("fiscal_year").isNotNull() & F.col("fiscal_period").isNotNull())
    return known.groupBy("fiscal_year").agg(F.count("*").alias("periods"), F.sum("_v").cast("bigint").alias("with_value"))


def unmapped(df: DataFrame, key: str) -> DataFrame:
    """Rows without a fiscal period, counted per key."""
    return df.where(F.col("fiscal_period").isNull()).groupBy(key).agg(F.count("*").alias("rows"))


def assert_complete(df: DataFrame, column: str) -> DataFrame:
    """The same rows; the job fails if the column is ever NULL."""
    checked = F.when(col(column).isNotNull(), col(column)).otherwise(
        F.raise_error(F.lit(f"{column} is missing")).cast(df.schema[column].dataType)
    )
    return df.withColumn(column, checked)
