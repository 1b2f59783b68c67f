"""Connected components of a table of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.sources.staging import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that each linked node reaches. Nulls and self-links are ignored.

    Every round takes the smallest label around each node and then that label's own label, so the
    number of rounds grows with the logarithm of the longest chain in usual inputs. Each round is a
    table in the shared folder; nothing but the count of changed labels reaches the driver.
    """
    x = links.select(F.col(a).alias("node"), F.col(b).alias("other")).where("node IS NOT NULL AND other IS NOT NULL AND node <> other")
    both = staged(x.union(x.select("other", "node")).distinct())
    labels = staged(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        at = labels.select(F.col("node").alias("other"), F.col("component").alias("c"))
        near = both.join(at, "other").groupBy("node").agg(F.min("c").alias("m"))
        lower = labels.join(near, "node").select("node", F.least("component", "m").alias("component"), F.col("component").alias("old"))
        target = labels.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = lower.join(target, "component").select("node", F.least("component", "up").alias("component"), "old")
        after = staged(jumped)
        if after.where("component <> old").limit(1).count() == 0:
            return after.select("node", "component")
        labels = after.select("node", "component")
