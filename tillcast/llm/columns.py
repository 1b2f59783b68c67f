"""Rows of a caller's table carried as one struct, so that its column names cannot meet those of an operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as Spark reads it back, also with dots and quotes in it."""
    return "`" + name.replace("`", "``") + "`"


def whole(df: DataFrame) -> Column:
    """All columns of `df` as the struct `row`."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row")


def unfolded(df: DataFrame, **changed: Column) -> list[Column]:
    """The columns of `df` out of its struct `row`, some of them replaced."""
    return [changed.get(c, F.col("row")[c]).alias(c) for c in df.columns]
