"""Store ids, record keys and exclusion rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.config import bare_id
from tillcast.functions.casts import col


def store_id(c: str | Column) -> Column:
    """Trimmed id; a number that arrived as text with a '.0' tail loses the tail."""
    return F.regexp_replace(F.trim(col(c).cast("string")), r"^(\d+)\.0+$", "$1")


def digits_key(c: str | Column) -> Column:
    """Digits of an id after every '.0' is taken out; NULL gives the empty string."""
    text = F.replace(F.trim(col(c).cast("string")), F.lit(".0"), F.lit(""))
    return F.coalesce(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))


def unpadded(c: str | Column) -> Column:
    """Trimmed id without leading zeros."""
    return F.ltrim(F.trim(col(c).cast("string")), F.lit("0"))


def drop_stores(df: DataFrame, key: str, ids: Iterable[object]) -> DataFrame:
    """Rows whose unpadded id is not listed. The list is configuration, so it stays a literal."""
    listed = sorted(set(map(bare_id, ids)))
    if not listed:
        return df
    return df.where(F.coalesce(~unpadded(key).isin(listed), F.lit(True)))


def drop_store_range(df: DataFrame, key: str, first: int, last: int) -> DataFrame:
    """Same rule for a numeric id range; ids that are not numbers stay."""
    number = col(key).try_cast("double")
    return df.where(F.coalesce(~number.between(first, last), F.lit(True)))


def drop_stores_by_digits(df: DataFrame, key: str, ids: DataFrame, id_col: str) -> DataFrame:
    """Anti join on digits without leading zeros, for lists that are tables."""
    bare = F.ltrim(digits_key(key), F.lit("0"))
    listed = ids.select(F.ltrim(digits_key(id_col), F.lit("0")).alias("_drop")).distinct()
    return df.join(listed, bare == F.col("_drop"), "left_anti")


def record_id(store: str | Column, fy: str | Column, fp: str | Column) -> Column:
    """store_YYYY_PP."""
    return F.concat_ws(
        "_",
        F.trim(col(store).cast("string")),
        F.lpad(col(fy).cast("string"), 4, "0"),
        F.lpad(col(fp).cast("string"), 2, "0"),
    )


def event_time(day: str | Column) -> Column:
    """Seconds since 1970-01-01 UTC at the start of the day."""
    return (F.unix_date(col(day)).cast("bigint") * 86400).alias("event_time")


def with_record_keys(df: DataFrame, store: str, day: str, fy: str, fp: str) -> DataFrame:
    """Adds record_id and event_time; rows that cannot carry both are dropped first."""
    keyed = df.where(col(day).isNotNull() & col(fy).isNotNull() & col(fp).isNotNull())
    return keyed.withColumns({"record_id": record_id(store, fy, fp), "event_time": event_time(day)})
