"""Tolerant casts, clips and guarded ratios.

Missing is always NULL. Spark orders NaN above every number and aggregates do not skip it, so
non-finite values are turned into NULL where they could appear.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def finite_sql(x: str) -> str:
    """SQL text: x, or NULL where it is NaN or infinite (NaN compares above every number)."""
    return f"CASE WHEN abs({x}) < double('Infinity') THEN {x} END"


def to_double(c: str) -> Column:
    """Numeric value or NULL; text that does not parse becomes NULL instead of failing the job."""
    return F.expr(finite_sql(f"try_cast(`{c}` AS DOUBLE)"))


def to_int(c: str) -> Column:
    return F.expr(f"try_cast(try_cast(`{c}` AS DOUBLE) AS INT)")


def to_key(c: str) -> Column:
    """Whole number or NULL: text, fractions and what an integer cannot hold are no keys."""
    x = f"try_cast(`{c}` AS DOUBLE)"
    return F.expr(f"CASE WHEN rint({x}) = {x} THEN try_cast({x} AS INT) END")


def to_day(c: str) -> Column:
    """Date without its time of day, or NULL."""
    return F.expr(f"to_date(try_cast(`{c}` AS TIMESTAMP))")


def clip(c: str | Column, low: float | None = None, high: float | None = None) -> Column:
    """Clip that keeps NULL (greatest and least alone would skip it)."""
    x = col(c)
    out = x
    if low is not None:
        out = F.greatest(out, F.lit(low))
    if high is not None:
        out = F.least(out, F.lit(high))
    return F.when(x.isNotNull(), out)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num/den, NULL where the denominator is 0."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def gate(flag: str | Column, value: str | Column) -> Column:
    """The value where the flag is 1, else 0."""
    return F.when(col(flag) == 1, col(value)).otherwise(F.lit(0.0))


def flag01(c: str) -> Column:
    """0/1 integer: bad text and NULL count as 0, other numbers are cut off at 0 and 1."""
    return F.expr(f"least(1, greatest(0, coalesce(try_cast(try_cast(`{c}` AS DOUBLE) AS INT), 0)))")


def sum0(c: str | Column) -> Column:
    """Sum that is 0 for a group without any value."""
    return F.coalesce(F.sum(col(c)), F.lit(0.0))


def require(df: DataFrame, names: Sequence[str], what: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise KeyError(f"{what} is missing columns {missing}; it has {df.columns}")
    return df


def sanitize_features(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Ids trimmed, features numeric with gaps as 0, rows without a target dropped."""
    changed = {f: F.coalesce(to_double(f), F.lit(0.0)) for f in features}
    changed[target] = to_double(target)
    changed["store_number"] = F.trim(F.col("store_number").cast("string"))
    return df.withColumns(changed).where(col(target).isNotNull())
