"""Near-duplicate documents by an exact join of word n-gram sets at Jaccard 3/4 or more.

Shingles are ordered from rare to frequent, by counts over all documents in a table of fixed size,
then by hash. Sets that are similar enough share two shingles of their prefixes, which are extended
by one for this. The index holds single shingles; where a shingle is frequent, it holds pairs.

1. Index: each task emits the prefixes of its distinct texts, with the number of shingles from there
   on, which bounds the overlap of a pair that meets there first. Shingles that nobody shares go.
2. Star: every document is tried with one document of each shingle's list, the one with most shingles
   left there. That connects whole groups of copies by few pairs, in number linear in the rows.
3. Rest: lists that now lie within one component are done. Of others, all pairs in different
   components are tried: by single shingles where they are rare, by pairs of shingles where frequent.
   Of all pairs, those are verified that what their prefixes have in common still allows.

Verification intersects the sets of 64-bit shingle hashes. Defined cases: null and empty texts have
no shingles and are linked with nothing; fewer than five words are one shingle; rows with the same
doc_id share a component; a null doc_id has a null component; no rows give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.batches import SPACED, int64s, mix, row_words, shingle_set, sliced
from tillcast.llm.columns import quoted
from tillcast.llm.components import components
from tillcast.llm.corpus_sums import corpus_sum
from tillcast.llm.meeting import meet, met_pairs
from tillcast.llm.registry import query, table
from tillcast.sources.staging import staged

COUNTERS = 1 << 20  # places of the shingle counts
FREQUENT = 64  # longest list of a shingle that is joined by itself
COPY_PLACES = 1024  # parts of a group of equal sets; each has a first document
_FLAG = np.uint64(1)  # lowest bit of an indexed shingle: frequent by the counts


def _enough(x: str, y: str, shared: Column) -> Column:
    """A Jaccard similarity of 3/4 with `shared` common shingles of sets with x and y."""
    return 7 * shared >= 3 * (F.col(x) + F.col(y))


def shingle_counts(documents: DataFrame) -> np.ndarray:
    """Documents per hashed shingle."""

    def add(total, batch):
        waiting, size = [], 0
        for _, h in row_words(batch["text"], SPACED):
            waiting.append(shingle_set(h))
            size += len(waiting[-1])
            if size > 1 << 18:
                total += np.bincount((np.concatenate(waiting) >> np.uint64(44)).astype(np.int64), minlength=COUNTERS)
                waiting, size = [], 0
        if waiting:
            total += np.bincount((np.concatenate(waiting) >> np.uint64(44)).astype(np.int64), minlength=COUNTERS)

    return corpus_sum(documents.select("text"), COUNTERS, add)


def set_sizes(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, h): size and hash of every row's set."""

    def rows(batches):
        for batch in sliced(batches):
            sizes, marks = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.uint64)
            for r, h in row_words(batch["text"], SPACED):
                s = shingle_set(h)
                sizes[r], marks[r] = len(s), np.bitwise_xor.reduce(s) if len(s) else 0
            yield pa.record_batch([batch["doc_id"], pa.array(sizes), int64s(marks)], names=["doc_id", "n_shingles", "h"])

    return documents.mapInArrow(rows, "doc_id long, n_shingles long, h long")


def _prefixes(documents: DataFrame, counts: np.ndarray) -> DataFrame:
    """(key, doc, sizes, often): prefix shingles of the distinct texts of each task, in few bytes, as all of them travel.

    `sizes` is the number of shingles from there on times 2**32, plus the set's. A rare shingle is the
    key itself and `often` is 0; a frequent one is in `often`, and its key is a mix of it and the document.
    """
    known = documents.sparkSession.sparkContext.broadcast(counts)
    often = 4 * FREQUENT + 8 * int(counts.mean())

    def rows(batches):
        counts, seen = known.value, set()
        for batch in sliced(batches):
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            keys, docs, sizes, oftens = [], [], [], []
            for r, h in row_words(batch["text"], SPACED):
                s = shingle_set(h)
                n = len(s)
                if n < 2:
                    continue
                mark = hash(s.tobytes())
                if mark in seen:
                    continue
                seen.add(mark)
                count = counts[(s >> np.uint64(44)).astype(np.int64)]
                first = np.argsort(count, kind="stable")[: min(n, n // 4 + 2)]
                token, many = s[first] & ~_FLAG, count[first] > often
                own = mix(np.full(1, ids[r], np.int64).view(np.uint64))
                keys.append(np.where(many, mix(token ^ own), token))
                oftens.append(np.where(many, token | _FLAG, np.uint64(0)))
                docs.append(np.full(len(first), ids[r]))
                sizes.append((n - np.arange(len(first), dtype=np.int64)) * (1 << 32) + n)
            if keys:
                cols = [int64s(np.concatenate(keys)), pa.array(np.concatenate(docs), pa.int64()), pa.array(np.concatenate(sizes)), int64s(np.concatenate(oftens))]
                yield pa.record_batch(cols, names=["key", "doc", "sizes", "often"])

    return documents.where("doc_id IS NOT NULL").mapInArrow(rows, "key long, doc long, sizes long, often long")


def _shared(prefixes: DataFrame) -> DataFrame:
    """Rows whose shingle others have too; frequent ones are all kept, so no list of theirs is gathered."""
    counted = prefixes.selectExpr("*", "count(*) OVER (PARTITION BY key) AS c").where("c > 1 OR often <> 0")
    token = F.when(F.col("often") == 0, F.col("key")).otherwise(F.col("often"))
    rest, n = F.shiftright("sizes", 32).cast("int"), F.col("sizes").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    return counted.select(token.alias("token"), "doc", rest.alias("rest"), n.alias("n"))


def _verified(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""

    def sets(texts):
        return [shingle_set(h).tobytes() for _, h in row_words(texts, SPACED)]

    def compare(batches):
        got = []
        for a, own, b, known in met_pairs(batches, lambda s: np.frombuffer(s.as_py(), np.uint64)):
            if any(7 * len(np.intersect1d(own, k, assume_unique=True)) >= 3 * (len(own) + len(k)) for k in known):
                got.append((a, b))
            if len(got) == 10_000:
                yield as_batch(got)
                got = []
        yield as_batch(got)

    def as_batch(got):
        return pa.record_batch([pa.array([g[i] for g in got], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return meet(documents, pairs, sets).mapInArrow(compare, "a long, b long").distinct()


def near_duplicate_links(documents: DataFrame) -> DataFrame:
    """(a, b): links that connect exactly the documents that all links of similarity 3/4 connect."""
    shared = staged(_shared(_prefixes(documents, shingle_counts(documents))))
    hub = F.max(F.struct("rest", (-F.col("doc")).alias("neg"), "n"))
    lists = shared.groupBy("token").agg(F.count("*").alias("c"), F.min("n").alias("least_n"), hub.alias("hub")).where("c > 1")
    viable = shared.join(lists, "token").where(_enough("n", "least_n", F.col("rest") + 1))
    viable = staged(viable.select("token", "doc", "rest", "n", "c", (-F.col("hub.neg")).alias("hub"), F.col("hub.rest").alias("hub_rest"), F.col("hub.n").alias("hub_n")))
    near = viable.where(F.col("doc") != F.col("hub")).where(_enough("n", "hub_n", F.least("rest", "hub_rest") + 1))
    near = near.select(F.col("doc").alias("a"), F.col("hub").alias("b")).distinct()
    star = staged(_verified(documents, staged(_by_prefix(near, shared))))

    label = components(star).withColumnRenamed("node", "doc")
    named = viable.join(label, "doc", "left").select("token", "doc", "rest", "n", "c", F.coalesce("component", "doc").alias("label"))
    mixed = named.groupBy("token").agg(F.min("label").alias("l0"), F.max("label").alias("l1")).where("l0 <> l1").select("token")
    open_ = staged(named.join(mixed, "token"))
    frequent = (F.col("c") > FREQUENT) | (F.col("token").bitwiseAND(F.lit(1)) == 1)
    rest = _across(open_.where(~frequent), ["token"])
    own = open_.where(frequent).groupBy("doc", "n", "label").agg(F.array_sort(F.collect_list(F.struct((-F.col("rest")).alias("neg"), "token"))).alias("ts"))
    second = F.explode(F.expr("flatten(transform(ts, (s, i) -> transform(slice(ts, i + 2, size(ts)), t -> struct(s.token AS token, t.token AS token2, -t.neg AS rest))))"))
    pairs = own.select("doc", "n", "label", second.alias("p")).select("doc", "n", "label", "p.*")
    rest = rest.union(_across(pairs, ["token", "token2"])).distinct()
    return star.union(_verified(documents, staged(_by_prefix(rest, shared))))


def _by_prefix(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """The pairs that have enough in common when all that lies behind the prefixes is counted as common."""
    behind = F.col("n") - F.least(F.col("n"), F.floor(F.col("n") / 4) + 2)
    lists = shared.groupBy("doc", "n").agg(F.collect_set("token").alias("ts")).withColumn("behind", behind)
    x = lists.select(F.col("doc").alias("a"), "n", "ts", "behind")
    y = lists.select(F.col("doc").alias("b"), F.col("n").alias("n_"), F.col("ts").alias("ts_"), F.col("behind").alias("behind_"))
    most = F.size(F.array_intersect("ts", "ts_")) + F.greatest("behind", "behind_")
    return pairs.join(x, "a").join(y, "b").where(_enough("n", "n_", most)).select("a", "b").distinct()


def _across(rows: DataFrame, key: list[str]) -> DataFrame:
    """Pairs of one list that lie in different components and can still be similar enough."""
    other = rows.select(*key, *[F.col(c).alias(f"{c}_") for c in ("doc", "rest", "n", "label")])
    met = (F.col("doc") < F.col("doc_")) & (F.col("label") != F.col("label_"))
    on = [rows[k] == other[k] for k in key] + [met, _enough("n", "n_", F.least("rest", "rest_") + 1)]
    return rows.join(other, on).select(F.col("doc").alias("a"), F.col("doc_").alias("b"))


def _copies(sizes: DataFrame) -> DataFrame:
    """(a, b): every document with the first one of its part of a group of equal sets, and these with the group's first."""
    parts = sizes.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(COPY_PLACES)))
    firsts = parts.groupBy("n_shingles", "h", "part").agg(F.min("doc_id").alias("b"))
    first = firsts.groupBy("n_shingles", "h").agg(F.min("b").alias("first"))
    within = parts.join(firsts, ["n_shingles", "h", "part"]).where(F.col("doc_id") != F.col("b")).select(F.col("doc_id").alias("a"), "b")
    across = firsts.join(first, ["n_shingles", "h"]).where(F.col("b") != F.col("first")).select(F.col("b").alias("a"), F.col("first").alias("b"))
    return within.union(across)


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = staged(set_sizes(documents))
    copies = _copies(sizes.where("n_shingles > 0 AND doc_id IS NOT NULL"))
    found = components(copies.union(near_duplicate_links(documents))).withColumnRenamed("node", "doc_id")
    return sizes.join(found, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def distinct_documents(documents: DataFrame) -> DataFrame:
    """The rows of `documents` whose doc_id is the smallest of its group; rows with a null doc_id and all columns stay."""
    names = near_duplicates(documents).where("doc_id <> component_id").select("doc_id").distinct()
    return documents.join(names, "doc_id", "left_anti").select(*map(quoted, documents.columns))


_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS k
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
    SELECT a, b FROM o JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
    WHERE 100 * c >= 75 * (na.n + nb.n - c)),
reach AS (SELECT a AS doc_id, b AS other FROM link UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.first, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS first FROM reach GROUP BY doc_id) m USING (doc_id)
"""


@query("op3_ngram_join", _SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"))
