"""Row numbers and exact percentiles without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.functions.casts import col
from tillcast.sources.staging import staged

SMALL = 10_000  # rows of a bracket that are ranked together
GRID = 200  # quantiles that propose the cuts of a larger one
FEW = 4096  # brackets that travel to the rows; of more, each meets its rows in SPREAD parts
SPREAD = 16


def hash_block(digest: str, blocks_hex: int = 3) -> Column:
    """Block number from the leading hex digits of a digest: 16 ** blocks_hex even blocks."""
    return F.conv(F.substring(digest, 1, blocks_hex), 16, 10).cast("int")


def quantile_block(df: DataFrame, value: str, by: Sequence[str], blocks: int) -> DataFrame:
    """Adds _block, which grows with `value` and holds about 1/blocks of each group's rows.

    For few groups (cluster numbers, scenarios): their cut points are broadcast.
    """
    cuts = [i / blocks for i in range(1, blocks)]
    bounds = df.groupBy(*by).agg(F.percentile_approx(value, cuts, 20 * blocks).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    return df.join(F.broadcast(bounds), list(by)).withColumn("_block", below).drop("_cuts")


def block_offsets(df: DataFrame, by: Sequence[str], block: str, counted: Column) -> DataFrame:
    """Counts of all earlier blocks of the group. Only block totals meet in the window."""
    totals = df.groupBy(*by, block).agg(F.sum(counted).alias("_c"))
    earlier = (
        Window.partitionBy(*(by or [F.lit(1)])).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    )
    return totals.select(*by, block, F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_offset"))


def distributed_row_number(
    df: DataFrame, block: str, order: Sequence[str], name: str, by: Sequence[str] = ()
) -> DataFrame:
    """row_number over (by, block, order) where `block` grows with the order.

    Numbers are local to a block plus the block's offset, so no task sees more than one block. The
    offsets, one row per block, are broadcast: the caller chooses how many blocks there are.
    """
    local = F.row_number().over(Window.partitionBy(*by, block).orderBy(*order))
    offsets = block_offsets(df, by, block, F.lit(1))
    joined = df.withColumn(name, local).join(F.broadcast(offsets), [*by, block])
    return joined.withColumn(name, F.col(name) + F.col("_offset")).drop("_offset")


def exact_percentiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    accuracy: int = 10_000,
    small: int = SMALL,
    few: int = FEW,
) -> DataFrame:
    """Linear-interpolated percentiles for groups of any size, one column per name in `probs`.

    The built-in exact percentile keeps every distinct value of a group in one buffer. Here each
    wanted rank has a bracket of values, at first the whole group. Brackets of more than `small` rows
    are narrowed: a mergeable sketch proposes two cuts around the rank, the rows below, between and
    above them are counted, and the part that holds the rank is the next bracket. The sketch decides
    how fast brackets shrink, never where a rank lies; a cut pair that spans the bracket becomes its
    middle, so that every round takes a good part away. Only the rows of small brackets are ranked, equal values
    as one row. A group whose key is null is a group of its own.

    Groups may be few and hold all rows between them, so rows are never gathered by group: up to `few`
    brackets are broadcast, and more are joined in parts by value. Rows carry the ends of their bracket
    and nothing else; what is known of a bracket comes back to it after each aggregate.
    """
    key = F.struct(*by) if by else F.lit(0)
    rows = df.where(col(value).isNotNull()).select(key.alias("_g"), col(value).cast("double").alias("_v"))

    def within(near: DataFrame, many: bool) -> DataFrame:
        """Rows with the bracket they lie in."""
        if many:
            parts = near.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
            met = rows.withColumn("_part", F.pmod(F.xxhash64("_v"), F.lit(SPREAD)).cast("int")).join(parts.hint("merge"), ["_g", "_part"])
        else:
            met = rows.join(F.broadcast(near), "_g")
        return met.where(F.col("_v").between(F.col("lo"), F.col("hi")))

    def wanted(p: float) -> Column:
        return F.lit(p) * (F.col("n") - 1)

    ranks = F.array_distinct(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(upper).alias("upper"), (F.ceil(wanted(p)) if upper else F.floor(wanted(p))).alias("r"))
        for name, p in probs.items() for upper in (False, True)
    ]))
    brackets = rows.groupBy("_g").agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"), F.count("*").alias("n"))
    brackets = staged(brackets.select("_g", "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("m"), "n", ranks.alias("ranks")))
    large = (F.col("m") > small) & (F.col("lo") < F.col("hi"))
    while wide := brackets.where(large).count():
        narrowed = _narrowed(brackets.where(large), lambda near: within(near, wide > few), accuracy)
        parts = brackets.where(~large).unionByName(narrowed)
        same = parts.groupBy("_g", "lo", "hi", "below", "m", "n")  # ranks that came by different ways
        brackets = staged(same.agg(F.flatten(F.collect_list("ranks")).alias("ranks")))

    of_bracket = ["_g", "lo", "hi"]
    folded = within(brackets.select(*of_bracket), brackets.count() > few).groupBy(*of_bracket, "_v").agg(F.count("*").alias("c"))
    folded = folded.join(brackets.select(*of_bracket, "below", "n", "ranks"), of_bracket)
    upto = Window.partitionBy(*of_bracket).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.col("below") + F.sum("c").over(upto)
    placed = folded.withColumn("end", end).withColumn("start", F.col("end") - F.col("c"))
    here = F.filter("ranks", lambda w: (w["r"] >= F.col("start")) & (w["r"] < F.col("end")))
    found = placed.select("_g", "n", "_v", F.explode(here).alias("w"))

    def at(name: str, upper: bool) -> Column:
        return F.max(F.when((F.col("w.name") == name) & (F.col("w.upper") == upper), F.col("_v")))

    def between(name: str, p: float) -> Column:
        low, share = at(name, False), wanted(p) - F.floor(wanted(p))
        return (low + (at(name, True) - low) * share).alias(name)

    per_group = found.groupBy("_g", "n").agg(*[between(name, p) for name, p in probs.items()])
    return per_group.select(*(["_g.*"] if by else []), *probs)


def _narrowed(brackets: DataFrame, within, accuracy: int) -> DataFrame:
    """For every rank the part of its bracket that holds it."""
    of_bracket = ["_g", "lo", "hi"]
    grid = [i / GRID for i in range(GRID + 1)]
    sketched = within(brackets.select(*of_bracket)).groupBy(*of_bracket).agg(F.percentile_approx("_v", grid, max(accuracy, 100)).alias("q"))
    each = brackets.join(sketched, of_bracket).withColumn("w", F.explode("ranks"))
    i = F.least(F.floor((F.col("w.r") - F.col("below") + 0.5) / F.col("m") * GRID), F.lit(GRID - 1)).cast("int")
    cell = lambda j: F.get("q", F.greatest(F.lit(0), F.least(F.lit(GRID), j)))
    spans = (cell(i - 1) <= F.col("q")[0]) & (cell(i + 2) >= F.col("q")[GRID])
    middle = F.col("q")[GRID // 2]
    cut = each.withColumns({"c1": F.when(spans, middle).otherwise(cell(i - 1)), "c2": F.when(spans, middle).otherwise(cell(i + 2))})
    pairs = cut.groupBy(*of_bracket, "below", "m", "n", "c1", "c2").agg(F.collect_list("w").alias("ranks"))
    pairs = staged(pairs)
    v, c1, c2 = F.col("_v"), F.col("c1"), F.col("c2")
    counted = within(pairs.select(*of_bracket, "c1", "c2")).groupBy(*of_bracket, "c1", "c2").agg(
        F.count(F.when(v < c1, 1)).alias("lt"), F.count(F.when(v <= c2, 1)).alias("le"),
        F.max(F.when(v < c1, v)).alias("max_lt"), F.min(F.when(v > c2, v)).alias("min_gt"),
    )
    counted = counted.join(pairs, [*of_bracket, "c1", "c2"])
    k = F.col("w.r") - F.col("below")
    part = F.when(k < F.col("lt"), F.struct("lo", F.col("max_lt").alias("hi"), "below", F.col("lt").alias("m"))).when(
        k < F.col("le"),
        F.struct(c1.alias("lo"), c2.alias("hi"), (F.col("below") + F.col("lt")).alias("below"), (F.col("le") - F.col("lt")).alias("m")),
    ).otherwise(F.struct(F.col("min_gt").alias("lo"), "hi", (F.col("below") + F.col("le")).alias("below"), (F.col("m") - F.col("le")).alias("m")))
    moved = counted.withColumn("w", F.explode("ranks")).select("_g", "n", "w", part.alias("part"))
    return moved.select("_g", "part.*", "n", F.array("w").alias("ranks"))


def exact_median(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "median") -> DataFrame:
    return exact_percentiles(df, value, {name: 0.5}, by)
