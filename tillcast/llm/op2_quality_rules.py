"""Quality rules: counted base rules, then a calibrated logistic model of hashed word and character n-grams.

Words, pairs of words and character n-grams never cross the end of a text, so a score depends on its
text alone. Whole texts are scored in Arrow batches against fixed thresholds. Defined cases: null and empty texts
have no words, so they fail the base rules; repeated rows are scored row by row; without labelled
rows, or with one class only, the model answers that class (keep, if there are none); a probability
equal to the threshold is kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.batches import SPACED, grams, hashes, pieces, spans
from tillcast.llm.logistic import fit_logistic, fit_platt, sigmoid
from tillcast.llm.registry import query, table
from tillcast.llm.sample import labelled_ids

WORD_DIMS = CHAR_DIMS = 1 << 12
DIMS = WORD_DIMS + CHAR_DIMS
CHARS = 4
SAMPLE_PER_CLASS = 1000  # labelled rows that the model is fitted on, per class
MIN_WORDS = 10
MAX_REPEAT_PCT = 20
KEEP_FROM = 0.5

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_LINE = np.arange(256) != 0x0A
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _within(n: int, cuts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Which of n - k + 1 consecutive k-grams lie inside one row, and the offsets of each row's grams among these."""
    inside = np.ones(max(n - k + 1, 0), bool)
    inner = cuts[1:-1]
    for back in range(1, k):
        at = inner - back
        inside[at[(at >= 0) & (at < len(inside))]] = False
    return inside, np.concatenate([[0], np.cumsum(np.maximum(np.diff(cuts) - k + 1, 0))])


def _parts(data, offs, wo, h):
    """(feature, offsets, first dimension) of words, pairs of words and character n-grams; each row's share sums to one."""
    yield (h >> np.uint64(52)).astype(np.int64), wo, 0
    inside, cuts = _within(len(h), wo, 2)
    yield (grams(h, 2)[inside] >> np.uint64(52)).astype(np.int64), cuts, 0
    if len(data) >= CHARS:
        code = np.zeros(len(data) - CHARS + 1, np.uint32)
        for k in range(CHARS):
            code |= data[k : len(code) + k].astype(np.uint32) << np.uint32(8 * k)
        code *= np.uint32(0x9E3779B1)
        code >>= np.uint32(20)
        inside, cuts = _within(len(data), offs, CHARS)
        yield code[inside].astype(np.int64), cuts, WORD_DIMS


def _repeated(h: np.ndarray) -> int:
    """Words inside 5-word windows that occur twice or more in the text."""
    g = grams(h, 5)
    if len(g) < 2:
        return 0
    order = np.argsort(g, kind="stable")
    same = g[order[1:]] == g[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(len(g), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int64)
    at = np.flatnonzero(hit)
    cover[at] += 1
    np.subtract.at(cover, at + 5, 1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def _measure(data, offs):
    """Base counts of each row, and what the features need."""
    starts, ends, wo = spans(data, offs, SPACED)
    h = hashes(data, starts, ends)
    n = len(offs) - 1
    points = np.concatenate([[0], np.cumsum(SPACED[data] & ((data & 0xC0) != 0x80))])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOLS[data])])
    ls, le, lo = spans(data, offs, _LINE)
    lh = hashes(data, ls, le, seed=1)
    worded = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    dup, rep = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for r in range(n):
        lines = lh[lo[r] : lo[r + 1]][worded[lo[r] : lo[r + 1]]]
        if len(lines) > 1:
            dup[r] = len(lines) - len(np.unique(lines))
        rep[r] = _repeated(h[wo[r] : wo[r + 1]])
    counts = (np.diff(wo), points[offs[1:]] - points[offs[:-1]], symbols[offs[1:]] - symbols[offs[:-1]], dup, rep)
    return counts, wo, h


def _sampled(documents: DataFrame, ids: DataFrame):
    """Dense features and labels of the sampled rows: at most 2 x SAMPLE_PER_CLASS rows of DIMS shares."""
    def rows(batches):
        for batch in batches:
            for i, j, data, offs in pieces(batch["text"]):
                starts, ends, wo = spans(data, offs, SPACED)
                x = np.zeros((j - i, DIMS), np.float32)
                for feature, cuts, base in _parts(data, offs, wo, hashes(data, starts, ends)):
                    for r in range(j - i):
                        own = feature[cuts[r] : cuts[r + 1]]
                        if len(own):
                            x[r, base : base + WORD_DIMS] += np.bincount(own, minlength=WORD_DIMS) / len(own)
                yield pa.record_batch([pa.array([r.tobytes() for r in x.astype(np.float16)], pa.binary()), batch["y"][i:j]], names=["x", "y"])

    chosen = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", F.col("y").cast("int").alias("y"))
    got = chosen.mapInArrow(rows, "x binary, y int").toArrow()
    y, packed = got["y"].to_numpy().astype(np.float64), got["x"].combine_chunks()
    x = np.empty((len(y), DIMS), np.float32)
    for r, k in enumerate(np.lexsort((packed.to_numpy(zero_copy_only=False), y)) if len(y) else []):
        x[r] = np.frombuffer(packed[int(k)].as_buffer(), np.float16)
    return x, np.sort(y)


def train(documents: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[np.ndarray, float, float, float]:
    """(weights, bias, a, c): fitted on four of five rows, calibrated on the fifth."""
    x, y = _sampled(documents, labelled_ids(labels, label, SAMPLE_PER_CLASS, training_only=False))
    if len(y) == 0:
        return np.zeros(DIMS, np.float32), 6.0, 1.0, 0.0
    scale = 1.0 / np.maximum(np.sqrt(np.einsum("ij,ij->j", x, x) / len(x)), 1e-4)
    x *= scale
    apart = np.argsort(np.arange(len(y)) % 5 == 4, kind="stable")
    cut = len(y) - len(y) // 5
    x, y = x[apart], y[apart]
    w, b = fit_logistic(x[:cut], y[:cut], l2=3e-3, steps=120, rate=0.02)
    a, c = fit_platt(x[cut:] @ w + b, y[cut:])
    return (w * scale).astype(np.float32), b, a, c


def _judged(model, column: pa.Array, keep_from: float):
    """(first row, end row, base counts, base_failed, probability, kept) of consecutive rows."""
    w, b, a, c = model
    for i, j, data, offs in pieces(column):
        counts, wo, h = _measure(data, offs)
        z = np.full(j - i, b)
        for feature, cuts, base in _parts(data, offs, wo, h):
            sums = np.concatenate([[0.0], np.cumsum(w[base + feature], dtype=np.float64)])
            z += (sums[cuts[1:]] - sums[cuts[:-1]]) / np.maximum(np.diff(cuts), 1)
        p = sigmoid(a * z + c)
        failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MAX_REPEAT_PCT * counts[0])
        yield i, j, counts, failed, p, ~failed & (p >= keep_from)


def quality_scores(documents: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id of every row with the base counts, base_failed, probability and kept."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    def rows(batches):
        for batch in batches:
            for i, j, counts, failed, p, kept in _judged(model.value, batch["text"], keep_from):
                cols = [batch["doc_id"][i:j], *map(pa.array, (*counts, failed, p, kept))]
                yield pa.record_batch(cols, names=["doc_id", *COUNTS, "base_failed", "probability", "kept"])

    schema = ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "base_failed boolean, probability double, kept boolean"])
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, schema)


def kept_documents(documents: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of `documents` that pass, unchanged and judged one by one."""
    model = documents.sparkSession.sparkContext.broadcast(train(documents, labels))

    @F.pandas_udf("boolean")
    def passes(texts: pd.Series) -> pd.Series:
        column = pa.Array.from_pandas(texts, type=pa.large_string())
        return pd.Series([k for *_, kept in _judged(model.value, column, keep_from) for k in kept], dtype=bool)

    return documents.where(passes("text"))


@query("op2_quality_rules")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))
