"""Centroid clustering of integer vectors with the equal-average equal-variance nearest-neighbour search.

A vector x of d components with sum S and Q = d * sum(x * x) - S * S obeys, for every centroid c,
d * |x - c|^2 >= (Sx - Sc)^2 + (sqrt(Qx) - sqrt(Qc))^2. Centroids lie sorted by their sums. A vector
scans outward from its own sum, to both sides; a side ends as soon as the first term alone exceeds
the best distance, a centroid is passed over when both terms do, and only the others are measured, in
integers. Bounds are floats with a margin for rounding, so they never pass over a centroid that is as
near as the best; equal distances go to the smaller number.

Each round is one pass in Arrow batches that hands on one row per task and centroid (count and sums),
which are added by centroid and component; the new centroids are the floors of sums over counts.

Defined cases: vectors with another number of components, a null array, a null, NaN or infinite
component are left out, and so are those with a component of 2**19 or more in size, whose distances a
long can't hold. Starting centroids go by hash of the id, then by id and by components; repeated ids
are vectors of their own; a null id starts no centroid; with fewer vectors than centroids all of them
start one; an empty centroid stays where it is. No vectors give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.registry import query, table
from tillcast.sources.staging import staged

DIMS = 64
CENTROIDS = 40
ROUNDS = 5
SCALE = 256
SEED = 2
LARGEST = float(1 << 19)
ROWS = 2048  # vectors that are searched together
_MARGIN = 1e-9


class Centroids:
    """Integer centroids by number, with their sums in order."""

    def __init__(self, centers: np.ndarray):
        self.centers = centers
        sums = centers.sum(1)
        self.order = np.argsort(sums, kind="stable")
        self.sorted = centers[self.order]
        self.sums = sums[self.order]
        self.spread, self.slack = _spread(self.sorted, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, squared distance) of the centroid nearest to each row; equal distances: smaller number."""
        n, (k, d) = len(x), self.centers.shape
        sums = x.sum(1)
        spread, slack = _spread(x, sums)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
        middle = np.searchsorted(self.sums, sums)
        sides = [(middle - 1, -1), (middle, 1)]
        live = [np.flatnonzero((at >= 0) & (at < k)) for at, _ in sides]
        while len(live[0]) or len(live[1]):
            for side, (at, way) in enumerate(sides):
                rows = live[side]
                if not len(rows):
                    continue
                c = at[rows]
                by_sum = (sums[rows] - self.sums[c]).astype(np.float64) ** 2
                bound = d * best[rows].astype(np.float64) * (1 + _MARGIN) + 1
                rows, c, by_sum, bound = (v[by_sum <= bound] for v in (rows, c, by_sum, bound))
                by_spread = np.maximum(np.abs(spread[rows] - self.spread[c]) - slack[rows] - self.slack[c], 0) ** 2
                close = by_sum + by_spread <= bound
                r, m = rows[close], c[close]
                if len(r):
                    apart = x[r] - self.sorted[m]
                    far = np.einsum("ij,ij->i", apart, apart)
                    name = self.order[m]
                    better = (far < best[r]) | ((far == best[r]) & (name < number[r]))
                    best[r[better]], number[r[better]] = far[better], name[better]
                at[rows] += way
                live[side] = rows[(at[rows] >= 0) & (at[rows] < k)]
        return number, best


def _spread(x: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """sqrt(d * sum of squares - square of the sum), which grows with the deviation, and its error at most."""
    squares = x.shape[1] * np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    return np.sqrt(np.maximum(squares - sums.astype(np.float64) ** 2, 0)), 2e-7 * np.sqrt(squares)


def integer_vectors(rows: DataFrame, dims: int = DIMS, scale: int = SCALE, vector: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(scale * x) of every vector that can be used."""
    usable = (F.size(vector) == dims) & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("int"))
    return rows.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v"))


def _blocks(batch: pa.RecordBatch, dims: int):
    """(first row, integers) of some rows at a time."""
    x = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for i in range(0, len(x), ROWS):
        yield i, x[i : i + ROWS].astype(np.int64)


def starting_centers(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of `seed:vec_id`."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(named, 256), "vec_id", "v").limit(k).collect()
    return np.array([r["v"] for r in first], np.int64)


def moved_centers(vectors: DataFrame, centers: np.ndarray) -> np.ndarray:
    """Floors of the means of the vectors nearest to each centroid; the same centroid where there are none."""
    k, dims = centers.shape
    known = vectors.sparkSession.sparkContext.broadcast(Centroids(centers))

    def by_task(batches):
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, x in _blocks(batch, dims):
                number, _ = known.value.nearest(x)
                order = np.argsort(number, kind="stable")
                held, first = np.unique(number[order], return_index=True)
                sums[held] += np.add.reduceat(x[order], first, 0)
                counts += np.bincount(number, minlength=k)
        full = np.flatnonzero(counts)
        if len(full):
            yield pa.record_batch([pa.array(full, pa.int32()), pa.array(counts[full]), pa.array(sums[full].tolist(), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = vectors.select("v").mapInArrow(by_task, "cluster int, n long, sums array<long>")
    added = parts.select("cluster", "n", F.posexplode("sums").alias("at", "x")).groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    out = centers.copy()
    for r in added.collect():
        out[r["cluster"], r["at"]] = r["x"] // r["n"]
    known.destroy()
    return out


def assigned(vectors: DataFrame, centers: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector; distance is squared."""
    dims = centers.shape[1]
    known = vectors.sparkSession.sparkContext.broadcast(Centroids(centers))

    def rows(batches):
        for batch in batches:
            for i, x in _blocks(batch, dims):
                number, far = known.value.nearest(x)
                yield pa.record_batch([batch["vec_id"][i : i + len(x)], pa.array(number, pa.int32()), pa.array(far)], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(rows, "vec_id long, cluster int, distance long")


def centroid_clusters(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """Assignment of `integer_vectors` after the rounds, and the final centroids."""
    vectors = staged(vectors)
    centers = starting_centers(vectors, k, seed)
    if len(centers) == 0:
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centers
    for _ in range(rounds):
        centers = moved_centers(vectors, centers)
    return staged(assigned(vectors, centers)), centers


def _sql() -> str:
    """Each round as one step: distances by component, nearest centroid, floors of the means."""
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
dist{r} AS MATERIALIZED (
    SELECT x.r, c.c, sum((x.v - c.v) * (x.v - c.v)) AS d FROM x JOIN c{r} c ON c.i = x.i GROUP BY x.r, c.c),
near{r} AS MATERIALIZED (SELECT r, c, d FROM dist{r} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if r < ROUNDS:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
    SELECT c.c, c.i, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN (
        SELECT n.c, x.i, CAST((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS v
        FROM near{r} n JOIN x ON x.r = n.r GROUP BY n.c, x.i) m ON m.c = c.c AND m.i = c.i)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {DIMS} AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e) AND abs(e) < {int(LARGEST)})) = {DIMS}),
x AS MATERIALIZED (
    SELECT r, i, CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS v FROM (SELECT r, embedding, unnest(range(1, {DIMS + 1})) AS i FROM kept)),
first AS (
    SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id NULLS FIRST, embedding) - 1 AS c FROM kept),
c0 AS MATERIALIZED (SELECT c, i, v FROM first JOIN x USING (r) WHERE c < {CENTROIDS}),{",".join(steps)},
sums AS (SELECT c, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM near{ROUNDS} GROUP BY c),
named AS (SELECT c, sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT CAST(vec_id AS BIGINT) AS vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, cluster_inertia,
       (SELECT CAST(sum(d) AS BIGINT) FROM near{ROUNDS}) AS inertia, centroid_sha256
FROM near{ROUNDS} JOIN kept USING (r) JOIN sums USING (c) JOIN named USING (c)
"""


@query("op12_centroid_clustering", _sql())
def op12(spark: SparkSession, sf: str) -> DataFrame:
    near, centers = centroid_clusters(integer_vectors(table(spark, sf, "embeddings")))
    sums = {r["cluster"]: r["s"] for r in near.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers.tolist()]
    per = spark.createDataFrame(
        [(c, sums[c], sum(sums.values()), digests[c]) for c in sorted(sums)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return near.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
