"""Benchmark decontamination: an FM-index per shard of training texts, searched for benchmark windows.

A window is ten consecutive words of an item, or the whole of a shorter item. Each task indexes its
texts shard by shard, `SHARD_BYTES` at a time; words outside the benchmark cannot be part of a match,
so runs of them are one separator symbol. All windows are searched backwards at once through
wavelet ranks, found rows are located by sampled suffix positions, and hit words merge to spans.

The benchmark is a query set: it is worked through in blocks of about `BLOCK_WORDS` words, chosen by
hash of the item, and each block is one broadcast of bounded size and one pass over the texts.

Defined cases: null or empty texts and items have no words; item rows with a null item_id are left
out; repeated rows of an item count once; repeated documents are searched row by row; an empty
benchmark hits nothing. Words are compared by 64-bit hashes of their lower-cased bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tillcast.llm.batches import ALNUM, LOWER, flat, hashes, pieces, spans
from tillcast.llm.columns import unfolded, whole
from tillcast.llm.registry import query, table

WINDOW = 10
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 500_000
SAMPLE_EVERY = 8


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared length; the last symbol is the unique smallest."""
    n, k = len(t), 1
    rank = np.unique(t, return_inverse=True)[1].astype(np.int64)
    while True:
        later = np.zeros(n, np.int64)
        if k < n:
            later[:-k] = rank[k:] + 1
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        k *= 2


class FMIndex:
    """Backward search, counting and locating in a sequence of symbols 1..top; 0 separates."""

    def __init__(self, text: np.ndarray):
        t = np.concatenate([text.astype(np.int64) + 1, [0]])
        sa = suffix_array(t)
        self.bwt = t[sa - 1]
        self.levels = max(1, int(t.max()).bit_length())
        self.first = np.searchsorted(np.sort(t), np.arange((1 << self.levels) + 1))
        self.ones, self.zeros, cur = [], [], self.bwt
        for level in reversed(range(self.levels)):
            bit = (cur >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(bit) - bit.sum()))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])
        self.sampled = np.where(sa % SAMPLE_EVERY == 0, sa, -1)
        self.size = len(t)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first i of the transform."""
        left, right = np.zeros_like(i), i
        for depth, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = (symbol >> (self.levels - 1 - depth)) & 1 == 1
            left = np.where(up, zeros + ones[left], left - ones[left])
            right = np.where(up, zeros + ones[right], right - ones[right])
        return right - left

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each pattern."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        live = np.arange(len(patterns))
        for step in reversed(range(patterns.shape[1])):
            s = patterns[live, step] + 1
            fits = s < (1 << self.levels)
            high[live[~fits]] = low[live[~fits]] = 0
            live, s = live[fits], s[fits]
            low[live] = self.first[s] + self.rank(s, low[live])
            high[live] = self.first[s] + self.rank(s, high[live])
            live = live[high[live] > low[live]]
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes of these rows, walking back to the next sampled one."""
        out, steps, at, todo = np.empty(len(rows), np.int64), 0, rows.copy(), np.arange(len(rows))
        while len(todo):
            place = self.sampled[at]
            done = place >= 0
            out[todo[done]] = place[done] + steps
            todo, at = todo[~done], at[~done]
            s = self.bwt[at]
            at = self.first[s] + self.rank(s, at)
            steps += 1
        return out


class Block:
    """The windows of one block of items, as symbols of the block's own vocabulary."""

    def __init__(self, ids: list[str], texts: list[str]):
        self.ids = sorted(set(ids))
        number = {v: k for k, v in enumerate(self.ids)}
        data, offs = flat(pa.array(texts, pa.large_string()))
        data = LOWER[data]
        starts, ends, wo = spans(data, offs, ALNUM)
        words = hashes(data, starts, ends)
        self.vocabulary = np.unique(words)
        symbols = np.searchsorted(self.vocabulary, words) + 1
        rows: dict[int, list[np.ndarray]] = {}
        items: dict[int, list[int]] = {}
        for r, name in enumerate(ids):
            own = symbols[wo[r] : wo[r + 1]]
            size = min(WINDOW, len(own))
            if size:
                found = np.lib.stride_tricks.sliding_window_view(own, size)
                rows.setdefault(size, []).append(found)
                items.setdefault(size, []).extend([number[name]] * len(found))
        self.windows = {}  # size: distinct windows, and pairs (window, item) ordered by window
        for size, parts in rows.items():
            distinct, which = np.unique(np.concatenate(parts), axis=0, return_inverse=True)
            pairs = np.unique(np.stack([which.ravel(), np.array(items[size])], 1), axis=0)
            self.windows[size] = distinct, np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1]

    def hits(self, data: np.ndarray, offs: np.ndarray):
        """(word starts, word ends, row offsets, hit flag of each word, distinct (row, item) pairs)."""
        starts, ends, wo = spans(LOWER[data], offs, ALNUM)
        hit, found = np.zeros(len(starts) + 1, np.int64), []
        if self.windows and len(starts):
            text, place = self._reduced(hashes(LOWER[data], starts, ends), wo, min(self.windows))
            index = FMIndex(text) if len(text) else None
            for size, (patterns, cuts, items) in self.windows.items() if index else ():
                low, high = index.search(patterns)
                count = high - low
                which = np.repeat(np.arange(len(patterns)), count)
                rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                at = place[index.locate(rows)]
                np.add.at(hit, at, 1)
                np.subtract.at(hit, at + size, 1)
                row = np.searchsorted(wo, at, "right") - 1
                named = cuts[which + 1] - cuts[which]
                item = items[np.arange(named.sum()) - np.repeat(np.cumsum(named) - named, named) + np.repeat(cuts[which], named)]
                found.append(np.unique(np.stack([np.repeat(row, named), item], 1), axis=0))
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return starts, ends, wo, np.cumsum(hit)[:-1] > 0, pairs

    def _reduced(self, words: np.ndarray, wo: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Runs of at least `least` known words of a row, each ended by a 0; and each symbol's word number."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == words
        begins = known.copy()
        begins[1:] &= ~known[:-1]
        cuts = wo[:-1][wo[:-1] < len(words)]
        begins[cuts] = known[cuts]
        finish = known.copy()
        finish[:-1] &= ~known[1:]
        cuts = wo[1:][wo[1:] > 0] - 1
        finish[cuts] = known[cuts]
        first, last = np.flatnonzero(begins), np.flatnonzero(finish)
        long = last - first + 1 >= least
        first, size = first[long], (last - first + 1)[long] + 1
        ends = np.cumsum(size)
        place = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(first, size)
        stops = ends - 1
        place[stops] -= 1
        text = at[place] + 1
        text[stops] = 0
        return text, place


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[Block]:
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    words = items.select(F.sum(F.octet_length("text") / 4)).first()[0] or 0
    n = max(1, int(-(-words // block_words)))
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).distinct().collect()
        yield Block([r["item_id"] for r in rows], [r["text"] for r in rows])


def _merged(spans_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans_):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


def find_contamination(documents: DataFrame, benchmark: DataFrame, keep: tuple[str, ...], cleaned: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """`keep` of every row of `documents`, with n_words, starts and ends of hit word spans, and items.

    `cleaned` adds `clean_text`, the text without the hit spans. Columns that are not kept may have any name.
    """
    extra = ["clean_text"] if cleaned else []
    out = _found(documents, benchmark, cleaned, block_words)
    return out.select(*[F.col("row")[c].alias(c) for c in keep], "n_words", "starts", "ends", "items", *extra)


def _found(documents: DataFrame, benchmark: DataFrame, cleaned: bool, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(row, starts, ends, items, n_words), and clean_text if wanted."""
    out = documents.select(whole(documents))
    for f in ("starts", "ends"):
        out = out.withColumn(f, F.array().cast("array<long>"))
    out = out.withColumn("items", F.array().cast("array<string>"))
    blocks = list(_blocks(benchmark, block_words))
    for block in blocks:
        last = block is blocks[-1]
        out = _scanned(out, block, last, cleaned and last)
    return out


def _scanned(df: DataFrame, block: Block, last: bool, cleaned: bool) -> DataFrame:
    def rows(batches):
        for batch in batches:
            texts = batch["row"].field("text")
            for i, j, data, offs in pieces(texts, SHARD_BYTES):
                w0, w1, wo, hit, pairs = block.hits(data, offs)
                starts, ends, items = ([x.as_py() for x in batch[c][i:j]] for c in ("starts", "ends", "items"))
                for r in np.unique(np.searchsorted(wo, np.flatnonzero(hit), "right") - 1):
                    flags = np.diff(np.concatenate([[0], hit[wo[r] : wo[r + 1]], [0]]).astype(np.int8))
                    merged = _merged(list(zip(starts[r], ends[r])) + list(zip(np.flatnonzero(flags == 1).tolist(), np.flatnonzero(flags == -1).tolist())))
                    starts[r], ends[r] = [s for s, _ in merged], [e for _, e in merged]
                for r, item in pairs.tolist():
                    items[r].append(block.ids[item])
                longs, names = pa.list_(pa.int64()), pa.list_(pa.string())
                cols = [batch["row"][i:j], pa.array(starts, longs), pa.array(ends, longs), pa.array(items, names)]
                if last:
                    cols.append(pa.array(np.diff(wo)))
                if cleaned:
                    cols.append(pa.array([_without(texts[i + r].as_py(), data[offs[r] : offs[r + 1]], w0[wo[r] : wo[r + 1]] - offs[r], w1[wo[r] : wo[r + 1]] - offs[r], starts[r], ends[r]) for r in range(j - i)], pa.string()))
                yield pa.record_batch(cols, names=["row", "starts", "ends", "items", "n_words", "clean_text"][: len(cols)])

    fields = list(df.schema.fields)
    if last:
        fields.append(StructField("n_words", LongType()))
    if cleaned:
        fields.append(StructField("clean_text", StringType()))
    return df.mapInArrow(rows, StructType(fields))


def _without(text, data, w0, w1, starts, ends):
    if not starts:
        return text
    kept, at = [], 0
    for s, e in zip(starts, ends):
        kept.append(data[at : w0[s]])
        at = int(w1[e - 1])
    return np.concatenate([*kept, data[at:]]).tobytes().decode()


def decontaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`documents` with the hit words taken out of the texts; n_chars follows where there is one.

    No row goes, null texts stay null, and further columns, of whatever name, stay as they are.
    """
    out = _found(documents, benchmark, cleaned=True)
    changed = {"text": F.col("clean_text")}
    if "n_chars" in documents.columns:
        counted = F.char_length("clean_text").cast(documents.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("starts") > 0, counted).otherwise(F.col("row.n_chars"))
    return out.select(unfolded(documents, **changed))


_SQL = r"""
WITH w AS (
    SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
    FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
win AS (
    SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS k
    FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM w WHERE len(ws) > 0)),
d AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws
    FROM documents),
occ AS (
    SELECT g.r, g.i, g.m, win.item_id FROM (
        SELECT r, i, m, array_to_string(ws[i : i + m - 1], ' ') AS k
        FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(ws) >= m)) g
    JOIN win ON win.m = g.m AND win.k = g.k),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + m)) AS p FROM occ) GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN it USING (r)
"""


@query("op6_decontamination", _SQL)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_contamination(documents, table(spark, sf, "benchmark"), ("doc_id",))
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda s, e: e - s), F.lit(0).cast("long"), lambda a, x: a + x)
    named = F.array_sort(F.array_distinct("items"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(named).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", named), 256).alias("items_sha256"), (F.size("starts") > 0).alias("contaminated"),
    )
