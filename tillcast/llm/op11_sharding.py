"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard draws a number for a key, and the key goes to the shard with the smallest draw, where a
draw is -ln(u) / weight and u mixes two words of the key's md5 with the shard's number. So key and
shards alone decide; a shard gets its weight's part of the keys, and one more shard takes keys only
into itself. Nothing is shuffled to find shards.

Places within a shard (`slotted`) need an order. Equal rows fold to one with a count before they
travel; the rest is ordered by a digest of the row and cut by its leading bits into blocks of about
`BLOCK_ROWS`, which are numbered on their own and then moved by the rows of earlier blocks. So no
task holds a shard, and copies of one row hold one place in their block however many there are.

Defined cases: a null key is the key '' and its rows lie in one shard; a null text has no bytes, size
16 and checksum 0; repeated rows each have a slot of their own, in one shard; no rows give no rows;
columns of the input with the names of new ones are replaced; weights must be positive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.llm.registry import query, table
from tillcast.sources.staging import staged

SHARDS = 40
MASK = (1 << 32) - 1
MULTIPLIER = 0x45D9F3B  # times 32 bits stays within a long
STRIDE = 0x9E3779B9  # between the salts of neighbouring shards
BLOCK_ROWS = 4096
ROW_BYTES = 16  # what a record takes besides its text


def _number(hexed: Column, first: int = 1) -> Column:
    """32 bits of a digest as a long."""
    return F.conv(F.substring(hexed, first, 8), 16, 10).cast("long")


def _mixed(numbers: Column) -> Column:
    """Each 32-bit number with every input bit spread over all bits."""
    for _ in range(2):
        numbers = F.transform(numbers, lambda x: (x.bitwiseXOR(F.shiftright(x, 16)) * MULTIPLIER).bitwiseAND(MASK))
    return F.transform(numbers, lambda x: x.bitwiseXOR(F.shiftright(x, 16)))


def draws(key: Column, weights: Sequence[float]) -> Column:
    """One (draw, shard) per shard, in the order of the shards."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    n = len(weights)
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    salts = F.array(*[F.lit(s * STRIDE & MASK).cast("long") for s in range(n)])
    salted = F.zip_with(F.array_repeat(_number(digest), n), salts, lambda x, c: (x + c).bitwiseAND(MASK))
    mixed = _mixed(F.zip_with(_mixed(salted), F.array_repeat(_number(digest, 9), n), lambda x, y: x.bitwiseXOR(y)))
    drawn = F.zip_with(mixed, F.array(*[F.lit(float(w)) for w in weights]), lambda x, w: -F.log((x + 0.5) / 2.0**32) / w)
    return F.transform(drawn, lambda d, s: F.struct(d.alias("draw"), s.alias("shard")))


def sharded(rows: DataFrame, key: str, weights: Sequence[float], more: Sequence[float] = ()) -> DataFrame:
    """`rows` with shard, and grown_shard: where they would lie with shards of the weights `more` besides."""
    kept = [c for c in rows.columns if c not in ("shard", "grown_shard")]
    drawn = rows.select(F.struct(*kept).alias("row"), draws(F.col(key), [*weights, *more]).alias("drawn"))
    first = F.array_min(F.slice("drawn", 1, len(weights)))["shard"]
    return drawn.select("row.*", first.alias("shard"), F.array_min("drawn")["shard"].alias("grown_shard"))


def slotted(rows: DataFrame, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`rows` with slot: 0, 1, ... within each shard, by a digest of the `order` columns and then by these.

    `order` names the columns that tell rows apart; rows that differ elsewhere only are in any order.
    """
    kept = [c for c in rows.columns if c != "slot"]
    same = F.concat_ws(":", *[F.coalesce(F.col(f"row.{c}").cast("string"), F.lit("")) for c in order])
    folded = staged(
        rows.groupBy(F.struct(*kept).alias("row")).agg(F.count("*").alias("n"))
        .select("row", F.col("row.shard").alias("at"), "n", _number(F.md5(same.cast("binary")), 1).alias("h"))
    )
    largest = folded.groupBy("at").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 1
    bits = min(32, max(0, math.ceil(math.log2(largest / block_rows))))
    cut = folded.withColumn("block", F.shiftright("h", 32 - bits))
    earlier = Window.partitionBy("at").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy("at", "block").agg(F.sum("n").alias("c"))
    moved = totals.select("at", "block", F.coalesce(F.sum("c").over(earlier), F.lit(0)).alias("moved"))
    inside = Window.partitionBy("at", "block").orderBy("h", *[f"row.{c}" for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn("before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(moved, ["at", "block"])
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy")
    return placed.select("row", "moved", "before", copy).select("row.*", (F.col("moved") + F.col("before") + F.col("copy")).alias("slot"))


def measured(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )


_SQL = r"""
WITH RECURSIVE steps AS (
    SELECT range AS b, range AS c, 0 AS k FROM range(256)
    UNION ALL
    SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(CAST(c AS BIGINT) ORDER BY b) AS t FROM steps WHERE k = 8),
d AS (
    SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, coalesce(text, '') AS text FROM documents),
m AS (
    SELECT r, doc_id, CAST(octet_length(encode(text)) + 16 AS BIGINT) AS size,
           xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
                           lambda a, b: xor(a >> 8, crc.t[CAST(xor(a, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS BIGINT)) AS text_crc32
    FROM d, crc),
k AS (
    SELECT r, s, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS k1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS k2
    FROM (SELECT r, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM d), (SELECT range AS s FROM range(41))),
m0 AS (SELECT r, s, k2, (k1 + (s * 2654435769 & 4294967295)) & 4294967295 AS x FROM k),
m1 AS (SELECT r, s, k2, xor(x, x >> 16) * 73244475 & 4294967295 AS x FROM m0),
m2 AS (SELECT r, s, k2, xor(x, x >> 16) * 73244475 & 4294967295 AS x FROM m1),
m3 AS (SELECT r, s, xor(xor(x, x >> 16), k2) AS x FROM m2),
m4 AS (SELECT r, s, xor(x, x >> 16) * 73244475 & 4294967295 AS x FROM m3),
m5 AS (SELECT r, s, xor(x, x >> 16) * 73244475 & 4294967295 AS x FROM m4),
draw AS (SELECT r, s, -ln((xor(x, x >> 16) + 0.5) / 4294967296.0) AS x FROM m5),
best AS (SELECT r, s AS shard FROM draw WHERE s < 40 QUALIFY row_number() OVER (PARTITION BY r ORDER BY x, s) = 1),
grown AS (SELECT r, s AS grown_shard FROM draw QUALIFY row_number() OVER (PARTITION BY r ORDER BY x, s) = 1)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(row_number() OVER (PARTITION BY shard ORDER BY CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size || ':' || text_crc32), 1, 8) AS BIGINT),
                               doc_id NULLS FIRST, size, text_crc32) - 1 AS BIGINT) AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM m JOIN best USING (r) JOIN grown USING (r)
"""


@query("op11_sharding", _SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    documents = measured(table(spark, sf, "documents"))
    dealt = slotted(sharded(documents, "doc_id", [1.0] * SHARDS, [1.0]), documents.columns)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
