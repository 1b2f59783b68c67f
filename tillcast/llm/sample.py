"""Bounded samples of labelled rows, the same at every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 4
TEST_FOLD = 2


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4, is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == TEST_FOLD, F.lit(False))


def labelled_ids(labels: DataFrame, label: str, per_class: int, training_only: bool) -> DataFrame:
    """(doc_id, y): for each label value, the `per_class` ids that come first by hash.

    Repeated labels of an id count as their maximum; null ids and labels are left out.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("y"))
    if training_only:
        one = one.where(~held_out())
    first = F.xxhash64(F.col("doc_id"), F.lit(17))
    parts = [one.where(F.col("y") == y).orderBy(first, "doc_id").limit(per_class) for y in (0, 1)]
    return parts[0].unionByName(parts[1])
