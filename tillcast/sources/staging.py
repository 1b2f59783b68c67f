"""Intermediate tables that several later steps read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.storagelevel import StorageLevel


def shared_dir(spark: SparkSession) -> str | None:
    """The folder named by `spark.checkpoint.dir`, which all executors and the driver see."""
    return spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; below the warehouse, which is shared too, where there is none."""
    return f"{shared_dir(spark) or spark.conf.get('spark.sql.warehouse.dir')}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is executed here go as soon as it has ended; nothing else reads those of a write."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def staged(df: DataFrame, root: str | None = None) -> DataFrame:
    """The same rows, read back from a table in `root` or else in the shared folder.

    Steps that follow prune its columns and start from files, so a lost executor costs one read and
    not the whole lineage. Without any folder the rows are persisted, on every master alike: what is
    lost with an executor is computed again.
    """
    root = root or shared_dir(df.sparkSession)
    if root is None:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    path = f"{root}/stage-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
