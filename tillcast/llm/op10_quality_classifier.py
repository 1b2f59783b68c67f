"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Word vectors come from all documents: each of `VOCAB` hashed words adds up the sparse random index
vectors of the words within `REACH` places of it. A document is the mean and the mean square of its
words' unit vectors. The network is fitted with numpy on a bounded labelled sample outside the test
fold; a temperature fitted on a part that the network has not seen calibrates its probabilities.

Defined cases: null and empty texts pool to zeros and are scored like that; repeated rows are scored
row by row; without labels all scores are 0.5, with one class only they lean to that class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.batches import SPACED, hashes, mix, pieces, spans
from tillcast.llm.corpus_sums import corpus_sum
from tillcast.llm.logistic import sigmoid
from tillcast.llm.registry import query, table
from tillcast.llm.sample import held_out, labelled_ids

VOCAB = 1 << 14
DIMS = 32
NONZERO = 2  # random signs per index vector
REACH = 2
SAMPLE_PER_CLASS = 4000  # labelled rows that the network is fitted on, per class
HIDDEN = 32
GOOD_FROM = 0.7


def _words(data, offs):
    starts, ends, wo = spans(data, offs, SPACED)
    return (hashes(data, starts, ends) % np.uint64(VOCAB)).astype(np.int64), wo


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each hashed word's index vector, the same in every task."""
    h = mix(np.arange(VOCAB * NONZERO, dtype=np.uint64) + np.uint64(12345)).reshape(VOCAB, NONZERO)
    return (h % np.uint64(DIMS)).astype(np.int64), ((h >> np.uint64(40)) & np.uint64(1)).astype(np.int64) * 2 - 1


def _pooled(vectors: np.ndarray, column: pa.Array):
    """(first row, end row, features) of consecutive rows."""
    for i, j, data, offs in pieces(column, 1 << 18):
        word, wo = _words(data, offs)
        x = np.zeros((j - i, 2 * DIMS), np.float32)
        full = np.flatnonzero(np.diff(wo))
        if len(full):
            v = vectors[word]
            n = np.diff(wo)[full, None]
            x[full, :DIMS] = np.add.reduceat(v, wo[full], 0) / n
            x[full, DIMS:] = np.add.reduceat(v * v, wo[full], 0) / n
        yield i, j, x


def word_vectors(documents: DataFrame) -> np.ndarray:
    """Unit vectors of the hashed words, from the neighbours of all words of all rows."""
    place, sign = _index_vectors()

    def add(total, batch):
        for _, _, data, offs in pieces(batch["text"]):
            word, wo = _words(data, offs)
            row = np.repeat(np.arange(len(wo) - 1), np.diff(wo))
            for d in range(1, REACH + 1):
                near = np.flatnonzero(row[d:] == row[:-d]) if len(row) > d else np.zeros(0, np.int64)
                a, b = word[near], word[near + d]
                for center, other in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        total += np.bincount(center * DIMS + place[other, k], sign[other, k], len(total)).astype(np.int64)

    sums = corpus_sum(documents.select("text"), VOCAB * DIMS, add).reshape(VOCAB, DIMS).astype(np.float32)
    return sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-6)


def _fit(x, y, seed=7, steps=400, rate=0.01, l2=1e-4):
    """Weights of the two layers, by full-batch Adam on class-balanced cross entropy."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    cost = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share)) / len(y)
    for t in range(1, steps + 1):
        a = np.maximum(x @ params[0] + params[1], 0)
        d = (sigmoid(a @ params[2] + params[3]) - y) * cost
        back = d[:, None] * params[2] * (a > 0)
        grads = [x.T @ back + l2 * params[0], back.sum(0), a.T @ d + l2 * params[2], np.array([d.sum()])]
        for k, g in enumerate(grads):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            params[k] = params[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return params


def _logit(model, x):
    mean, scale, params, temperature = model
    a = np.maximum(((x - mean) / scale) @ params[0] + params[1], 0)
    return (a @ params[2] + params[3]) / temperature


def train(documents: DataFrame, labels: DataFrame, vectors: np.ndarray, label: str = "quality"):
    """(mean, scale, layers, temperature); fitted on four of five sampled rows, tempered on the fifth."""
    known = documents.sparkSession.sparkContext.broadcast(vectors)

    def rows(batches):
        for batch in batches:
            for i, j, x in _pooled(known.value, batch["text"]):
                yield pa.record_batch([pa.array([r.tobytes() for r in x], pa.binary()), batch["y"][i:j]], names=["x", "y"])

    ids = labelled_ids(labels, label, SAMPLE_PER_CLASS, training_only=True)
    chosen = documents.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("text", F.col("y").cast("int").alias("y"))
    got = chosen.mapInArrow(rows, "x binary, y int").toArrow()
    seen = sorted(zip(got["y"].to_pylist(), got["x"].to_pylist()))
    x = np.frombuffer(b"".join(v for _, v in seen), np.float32).reshape(-1, 2 * DIMS).astype(np.float64)
    y = np.array([v for v, _ in seen], np.float64)
    if len(y) == 0:
        return 0.0, 1.0, [np.zeros((2 * DIMS, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.zeros(1)], 1.0
    mean, scale = x.mean(0), x.std(0) + 1e-4
    held = np.arange(len(y)) % 5 == 4
    params = _fit((x[~held] - mean) / scale, y[~held])
    z = _logit((mean, scale, params, 1.0), x[held])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 41))
    loss = [np.logaddexp(0, np.where(y[held] > 0.5, -z, z) / t).mean() if len(z) else 0.0 for t in grid]
    return mean, scale, params, float(grid[int(np.argmin(loss))]) if len(z) else 1.0


def classify(documents: DataFrame, vectors: np.ndarray, model) -> DataFrame:
    """doc_id of every row with score and predicted."""
    known = documents.sparkSession.sparkContext.broadcast((vectors, model))

    def rows(batches):
        vectors, model = known.value
        for batch in batches:
            for i, j, x in _pooled(vectors, batch["text"]):
                p = sigmoid(_logit(model, x))
                yield pa.record_batch([batch["doc_id"][i:j], pa.array(p), pa.array((p >= GOOD_FROM).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, "doc_id long, score double, predicted int")


@query("op10_quality_classifier")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    documents, labels = table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels")
    vectors = word_vectors(documents)
    scored = classify(documents, vectors, train(documents, labels, vectors))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
