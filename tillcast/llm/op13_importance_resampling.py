"""Importance resampling towards a target distribution, over features hashed by crc32.

Features are runs of `NGRAM` consecutive words or fewer, joined by one space; a feature's bucket is
the crc32 of its bytes modulo `BUCKETS`. The checksum is linear: without its constants it is the XOR
of what each byte contributes at its distance from the end. A table holds these contributions for 256
bytes and `REACH` distances, so the features of a batch are one lookup per byte and one
`bitwise_xor.reduceat`, then a constant for each length. Longer features fold blockwise: the register
of the bytes so far moves on by `REACH` bytes, four lookups, and takes the next block's XOR.

All documents and all target texts are counted into buckets. A bucket's gain is the logarithm of its
smoothed share in the target over its share in the documents, in thousandths; a document's weight is
the mean gain of its features. A Gumbel variable that its id fixes turns "the highest scores" into a
draw without replacement in proportion to the exponentials of the weights. Ranks come from counts
by score and places within one score, so no task sorts the corpus.

Defined cases: null, empty and wordless texts have no features, weight 0 and no part in the draw; a
null doc_id hashes as '' and comes before all others at equal scores; repeated rows count as often as
they occur and take consecutive ranks; an empty target leaves smoothed shares; no rows give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.llm.batches import ALNUM, LOWER, pieces, spans
from tillcast.llm.corpus_sums import corpus_sum
from tillcast.llm.registry import query, table
from tillcast.sources.staging import staged

NGRAM = 1
BUCKETS = 10_000
REACH = 64  # bytes from the end that the position table covers
LEAST_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
POLYNOMIAL = 0xEDB88320
SCORES_A_BAND = 256


class PositionTable:
    """crc32 of many spans of one byte array at a time."""

    def __init__(self, reach: int = REACH):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1).astype(np.uint32)
        self.reach = reach
        self.at = np.empty((reach, 256), np.uint32)  # a byte's contribution with so many bytes behind it
        self.at[0] = step
        for d in range(1, reach):
            before = self.at[d - 1]
            self.at[d] = (before >> 8) ^ step[before & 0xFF]
        self.flat = self.at.ravel()
        # register bytes act like data bytes that lie `reach` bytes before the end of the next block
        self.move = [self.at[reach - 1 - k] if reach > k else None for k in range(4)]

    def moved(self, register: np.ndarray) -> np.ndarray:
        """The register after `reach` more bytes of zero."""
        out = np.zeros_like(register)
        for k in range(4):
            out ^= self.move[k][(register >> np.uint32(8 * k)) & np.uint32(0xFF)]
        return out

    def linear(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """XOR of the contributions of each span's bytes; spans are not empty and may overlap."""
        sizes = ends - starts
        if len(sizes) == 0:
            return np.zeros(0, np.uint32)
        if int(sizes.max()) <= self.reach:
            return self._short(data, starts, sizes)
        blocks = -(-sizes // self.reach)
        head = sizes - (blocks - 1) * self.reach
        out = self._short(data, starts, head)
        at, left = starts + head, blocks - 1
        live = np.flatnonzero(left)
        while len(live):
            out[live] = self.moved(out[live]) ^ self._short(data, at[live], np.full(len(live), self.reach))
            at[live] += self.reach
            left[live] -= 1
            live = live[left[live] > 0]
        return out

    def _short(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        byte = data[np.repeat(starts, sizes) + place]
        behind = np.repeat(sizes, sizes) - 1 - place
        return np.bitwise_xor.reduceat(self.flat[behind * 256 + byte], first)

    def crc32(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return self.linear(data, starts, ends) ^ constants(ends - starts)


def constants(sizes: np.ndarray) -> np.ndarray:
    """crc32 of as many zero bytes: what the first and last inversion add at each length."""
    lengths, which = np.unique(sizes, return_inverse=True)
    out, crc, at = np.empty(len(lengths), np.uint32), 0, 0
    for k, n in enumerate(lengths.tolist()):
        crc, at = zlib.crc32(bytes(n - at), crc), n
        out[k] = crc
    return out[which]


def features(data: np.ndarray, offs: np.ndarray, table: PositionTable, ngram: int = NGRAM, buckets: int = BUCKETS):
    """(row, bucket) of every feature of some rows, rows in order, and the words of each row."""
    data = LOWER[data]
    starts, ends, wo = spans(data, offs, ALNUM)
    n = np.diff(wo)
    if ngram > 1:
        data, starts, ends = _spaced(data, starts, ends)
    row = np.repeat(np.arange(len(n)), n)
    rows, found = [], []
    for k in range(1, ngram + 1):
        first = np.flatnonzero(row[k - 1 :] == row[: len(row) - k + 1]) if len(row) >= k else np.zeros(0, np.int64)
        rows.append(row[first])
        found.append((table.crc32(data, starts[first], ends[first + k - 1]) % np.uint32(buckets)).astype(np.int64))
    rows, found = np.concatenate(rows), np.concatenate(found)
    if ngram > 1:
        order = np.argsort(rows, kind="stable")
        rows, found = rows[order], found[order]
    return rows, found, n


def _spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """The words alone, one space between them."""
    sizes = ends - starts + 1
    at = np.cumsum(sizes) - sizes
    out = np.full(int(sizes.sum()), 0x20, np.uint8)
    place = np.arange(len(out)) - np.repeat(at, sizes)
    inside = place < np.repeat(sizes - 1, sizes)
    out[inside] = data[(np.repeat(starts, sizes) + place)[inside]]
    return out, at, at + sizes - 1


def bucket_counts(texts: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def add(total, batch):
        table = PositionTable()
        for _, _, data, offs in pieces(batch["text"]):
            total += np.bincount(features(data, offs, table, ngram, buckets)[1], minlength=buckets)

    return corpus_sum(texts.select("text"), buckets, add)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, by bucket, as whole numbers."""
    n = len(source)
    over = (target + 1).astype(np.float64) * (int(source.sum()) + n)
    under = (source + 1).astype(np.float64) * (int(target.sum()) + n)
    return np.floor(1000 * np.log(over / under)).astype(np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable that the id fixes."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance(documents: DataFrame, target: DataFrame, ngram: int = NGRAM, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""
    gain = gains(bucket_counts(documents, ngram, buckets), bucket_counts(target, ngram, buckets))

    def rows(batches):
        table = PositionTable()
        for batch in batches:
            for i, j, data, offs in pieces(batch["text"]):
                row, bucket, words = features(data, offs, table, ngram, buckets)
                n = np.bincount(row, minlength=j - i)
                total = np.zeros(j - i, np.int64)
                full = np.flatnonzero(n)
                if len(full):
                    total[full] = np.add.reduceat(gain[bucket], (np.cumsum(n) - n)[full])
                cols = [batch["doc_id"][i:j], pa.array(words.astype(np.int64)), pa.array(n.astype(np.int64)), pa.array(total // np.maximum(n, 1))]
                yield pa.record_batch(cols, names=["doc_id", "n_words", "n_features", "weight"])

    weighed = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, n_words long, n_features long, weight long")
    return weighed.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def ranked(scored: DataFrame, wanted: int, eligible: Column) -> DataFrame:
    """`scored` with rank: 1, 2, ... for the `wanted` eligible rows of highest score, ties by doc_id; else null.

    Scores are whole thousandths, so their bands are few. The driver counts bands, then the scores of
    the band where the draw ends; rows below that score keep a null and do not travel.
    """
    names = scored.columns
    row = scored.select(F.struct(*names).alias("row"), F.coalesce(eligible, F.lit(False)).alias("in"))
    band = F.floor(F.col("row.score") / SCORES_A_BAND)
    open_rows = row.where("in")
    before, cut = 0, None
    if wanted > 0:
        for level, within in ((band, None), (F.col("row.score"), band)):
            here = open_rows if within is None else open_rows.where(within == cut)
            counted = here.groupBy(level.alias("at")).agg(F.count("*").alias("n")).collect()
            for at, n in sorted(((r["at"], r["n"]) for r in counted), reverse=True):
                cut = at
                if before + n >= wanted:
                    break
                before += n
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return row.select("row.*", none)
    chosen = F.col("in") & (F.col("row.score") >= cut)
    folded = row.where(chosen).groupBy("row").agg(F.count("*").alias("n"))
    tally = folded.groupBy(F.col("row.score").alias("s"), band.alias("b")).agg(F.sum("n").alias("n"))
    bands = tally.groupBy("b").agg(F.sum("n").alias("n"))
    above = Window.orderBy(F.col("b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    bands = bands.select("b", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("over"))
    higher = Window.partitionBy("b").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, -1)
    tally = tally.withColumn("n", F.coalesce(F.sum("n").over(higher), F.lit(0))).join(bands, "b").select("s", (F.col("n") + F.col("over")).alias("over"))
    order = [F.col(f"row.{c}") for c in ["doc_id", *[c for c in names if c not in ("doc_id", "score")]]]
    earlier = Window.partitionBy(F.col("row.score")).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = folded.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(tally, F.col("row.score") == F.col("s"))
    copies = placed.select("row", "over", "first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy"))
    rank = F.col("over") + F.col("first") + F.col("copy")
    return copies.select("row.*", F.when(rank <= wanted, rank).alias("rank")).unionByName(row.where(~chosen).select("row.*", none))


def resampled(documents: DataFrame, target: DataFrame, percent: int = DRAW_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every document."""
    scored = staged(importance(documents, target))
    eligible = F.col("n_words") >= least_words
    return ranked(scored, percent * scored.where(eligible).count() // 100, F.col("row.n_words") >= least_words)


_SQL = r"""
WITH RECURSIVE steps AS (
    SELECT range AS b, range AS c, 0 AS k FROM range(256)
    UNION ALL
    SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(CAST(c AS BIGINT) ORDER BY b) AS t FROM steps WHERE k = 8),
d AS MATERIALIZED (
    SELECT row_number() OVER () AS r, CAST(doc_id AS BIGINT) AS doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
    FROM documents),
w AS MATERIALIZED (SELECT r, unnest(ws) AS w FROM d),
b AS MATERIALIZED (
    SELECT unnest(list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS w
    FROM benchmark),
k AS MATERIALIZED (
    SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(hex(encode(w)), '..'), lambda x: CAST('0x' || x AS BIGINT))),
                              lambda a, b: xor(a >> 8, crc.t[CAST(xor(a, b) & 255 AS BIGINT) + 1])), CAST(4294967295 AS BIGINT)) % 10000 AS k
    FROM (SELECT w FROM w UNION SELECT w FROM b), crc),
s AS (SELECT k, count(*) AS s FROM w JOIN k USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN k USING (w) GROUP BY k),
g AS MATERIALIZED (
    SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM w) + 10000) AS DOUBLE)
                                   / CAST((coalesce(s, 0) + 1) * ((SELECT count(*) FROM b) + 10000) AS DOUBLE))) AS BIGINT) AS g
    FROM s FULL JOIN t USING (k)),
f AS (SELECT r, CAST(floor(sum(g) / count(*)) AS BIGINT) AS weight FROM w JOIN k USING (w) JOIN g USING (k) GROUP BY r),
scored AS (
    SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
    FROM d LEFT JOIN f USING (r)),
draw AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS FIRST, n, weight) AS rank FROM scored WHERE n >= 20
    QUALIFY rank <= (SELECT 10 * count(*) // 100 FROM scored WHERE n >= 20))
SELECT doc_id, n AS n_features, weight, score, rank FROM scored LEFT JOIN draw USING (r)
"""


@query("op13_importance_resampling", _SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    drawn = resampled(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
