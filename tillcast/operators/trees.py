"""A random forest of regression trees, grown level by level over parts of the rows, in numpy.

Features are cut into at most `BINS` bins: between all their values where there are so few, else at
their quantiles. Trees see a row as often as a Poisson draw of mean 1 says, which a digest of the row
and the tree decides, so nothing is kept per row and tree. Rows that lie in the same bins of all features
(a cell) take the same ways, so a tree adds them up first. A level is one pass: every part of the rows
sums draws and labels by tree, node, feature and bin, for a third of the features drawn per node; the
sums of one tree meet and give its best splits. Parts hold a bounded number of rows, and one tree's sums
of one small block of cells are worked on at a time.

Of a node's splits that leave `leaf` draws or more on both sides, the largest drop in squared error wins;
without one, or at the last level, a node is a leaf and predicts its mean. Trees are arrays of full
depth, in which a leaf sends everything to its first child.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32
PART = 1 << 20  # rows of a part
CELLS = 1 << 12  # cells that are worked on together
SUMS = 1 << 22  # sums that a task holds at a time
PIECE = 1 << 16  # rows that are scored together
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = 0x9E3779B97F4A7C15
#: draws of mean 1 by 16 random bits
DRAWS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.float64)


def draws(key: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is drawn for `tree` and the three after it, which starts a block of four; one column each."""
    x = key + np.uint64((tree // 4 + 1) * _STEP & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    x ^= x >> np.uint64(31)
    return DRAWS[x.view(np.uint16).reshape(-1, 4)]


def feature_cuts(rows: DataFrame, names: list[str]) -> list[np.ndarray]:
    """Sorted cut points of each column: at most BINS - 1, between its values or at its quantiles."""

    def values(batches):
        seen = [np.zeros(0)] * len(names)
        for batch in batches:
            for i, v in enumerate(seen):
                if len(v) <= BINS:
                    seen[i] = np.unique(np.r_[v, batch[i].to_numpy(zero_copy_only=False)])[: BINS + 1]
        at = np.repeat(np.arange(len(names)), [len(v) for v in seen])
        yield pa.record_batch([pa.array(at, pa.int32()), pa.array(np.concatenate(seen), pa.float64())], names=["at", "v"])

    found = rows.select(*names).mapInArrow(values, "at int, v double").distinct().toArrow()
    at, v = found["at"].to_numpy(), found["v"].to_numpy()
    probs = [i / BINS for i in range(1, BINS)]
    quantiles = rows.agg(*[F.percentile_approx(n, probs, 10_000).alias(n) for n in names]).first()
    cuts = []
    for i, n in enumerate(names):
        few = np.unique(v[at == i])
        cuts.append(few[:-1] + (few[1:] - few[:-1]) / 2 if len(few) <= BINS else np.unique(quantiles[n]))
    return cuts


def binned(cuts: list[np.ndarray], columns) -> np.ndarray:
    """Bins of rows given by column: the number of cut points below each value."""
    return np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, columns)], 1).astype(np.uint8)


def as_cells(bins: np.ndarray) -> pa.Array:
    n, k = bins.shape
    offsets = np.arange(n + 1, dtype=np.int32) * k
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(bins))])


def from_cells(column: pa.Array, k: int) -> np.ndarray:
    if len(column) == 0:
        return np.zeros((0, k), np.uint8)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint8)[first : first + len(column) * k].reshape(-1, k)


class Trees:
    """`code`: per tree and node (numbered from 1, children 2i and 2i + 1) the feature and cut, `value`: the mean of the node."""

    def __init__(self, cuts: list[np.ndarray], trees: int, depth: int):
        self.cuts, self.depth, self.mean = cuts, depth, 0.0
        #: cuts of feature f are columns first[f], first[f] + 1, ...; column 0 sends all rows to the first child
        self.first = 1 + np.cumsum([0, *map(len, cuts)])[:-1]
        self.code = np.zeros((trees, 1 << depth), np.int32)
        self.value = np.zeros((trees, 2 << depth))

    def above(self, bins: np.ndarray) -> np.ndarray:
        """One flat array of cells by column: whether a cell lies above a cut."""
        parts = [np.zeros((1, len(bins)), np.uint8)]
        parts += [bins[:, f] > np.arange(len(c))[:, None] for f, c in enumerate(self.cuts)]
        return np.concatenate(parts).astype(np.uint8).ravel()

    def nodes(self, tree: int, above: np.ndarray, at: np.ndarray, n: int, level: int) -> np.ndarray:
        """The nodes of a level that the cells at places `at` of `n` ones reach."""
        code = self.code[tree].astype(np.intp) * n
        node = np.ones(len(at), np.intp)
        for _ in range(level):
            node = 2 * node + above[code[node] + at]
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        if len(bins) == 0:
            return np.zeros(0)
        _, one, back = np.unique(np.ascontiguousarray(bins).view(f"S{bins.shape[1]}").ravel(), return_index=True, return_inverse=True)
        out = np.zeros(len(one))
        for i in range(0, len(one), CELLS):
            part = bins[one[i : i + CELLS]]
            above, at = self.above(part), np.arange(len(part))
            for tree in range(len(self.code)):
                out[i : i + CELLS] += self.value[tree][self.nodes(tree, above, at, len(part), self.depth)]
        return (out / len(self.code) + self.mean)[back]


def _sums(known: Trees, drawn: np.ndarray, level: int, bins: np.ndarray, key: np.ndarray, label: np.ndarray) -> Iterator[tuple]:
    """(tree, places, draws, labels): the sums of one part by tree, as places among (node, drawn feature, bin)."""
    trees, width, m = drawn.shape
    k = bins.shape[1]
    start = np.flatnonzero(np.r_[True, (bins[1:] != bins[:-1]).any(1)])
    end = np.r_[start[1:], len(bins)]
    block = max(4, SUMS // (width * m * BINS) // 4 * 4)
    for low in range(0, trees, block):
        here = range(low, min(low + block, trees))
        n, s = np.zeros((2, len(here), width * m * BINS))
        for i in range(0, len(start), CELLS):
            cells = start[i : i + CELLS]
            rows = slice(cells[0], end[min(i + CELLS, len(start)) - 1])
            part, size = bins[cells], len(cells)
            above = known.above(part)
            flat = part.T.astype(np.intp).ravel()
            y, h, runs = label[rows], key[rows], cells - cells[0]
            single = len(y) == size
            for t in here:
                if t % 4 == 0:
                    four = draws(h, t)
                w = four[:, t % 4]
                count, total = (w, w * y) if single else (np.add.reduceat(w, runs), np.add.reduceat(w * y, runs))
                at = np.flatnonzero(count)
                count, total = count[at], total[at]
                node = known.nodes(t, above, at, size, level) - width
                feature = drawn[t] * size
                for j in range(m):
                    place = (node * m + j) * BINS + flat[feature[node, j] + at]
                    n[t - low] += np.bincount(place, count, width * m * BINS)
                    s[t - low] += np.bincount(place, total, width * m * BINS)
        for t in here:
            places = np.flatnonzero(n[t - low])
            yield t, places, n[t - low][places], s[t - low][places]


def best_splits(n: np.ndarray, s: np.ndarray, leaf: int) -> dict[str, np.ndarray]:
    """The best split of each node from its sums by drawn feature and bin; `slot` is -1 where there is none."""
    nl, sl = n.cumsum(2), s.cumsum(2)
    total, label = nl[:, :1, -1:], sl[:, :1, -1:]
    with np.errstate(divide="ignore", invalid="ignore"):
        parent = label * label / total
        gain = sl * sl / nl + (label - sl) ** 2 / (total - nl) - parent
        gain = np.where((nl >= leaf) & (total - nl >= leaf), gain, -np.inf).reshape(len(n), -1)
        best = gain.argmax(1)
        rows = np.arange(len(n))
        splits = gain[rows, best] > 1e-12 * np.abs(parent.ravel())
        ln, ls = nl.reshape(len(n), -1)[rows, best], sl.reshape(len(n), -1)[rows, best]
        n_, s_ = total.ravel(), label.ravel()
        return {
            "slot": np.where(splits, best // BINS, -1), "bin": best % BINS, "n": n_, "mean": np.where(n_ > 0, s_ / n_, 0.0),
            "left": ls / ln, "right": (s_ - ls) / (n_ - ln),
        }


def grow(rows: DataFrame, cuts: list[np.ndarray], trees: int, depth: int, leaf: int, seed: int) -> Trees:
    """The forest of `rows` (cell, key, label), in which equal cells should be neighbours."""
    k, known, rng = len(cuts), Trees(cuts, trees, depth), np.random.default_rng(seed)
    m = k if trees == 1 else -(-k // 3)
    size, mean = rows.agg(F.count("*"), F.avg("label")).first()
    if not size:
        raise ValueError("no rows to train a forest on")
    known.mean = mean
    salt = np.uint64(rng.integers(1 << 63))
    alive = np.ones((trees, 1), bool)
    for level in range(depth):
        width = 1 << level
        drawn = rng.random((trees, width, k)).argsort(2)[:, :, :m]
        found = _level(rows, known, drawn, level, mean, salt, leaf).toArrow()
        get = {c: found[c].combine_chunks().flatten().to_numpy().reshape(-1, width) for c in found.column_names if c != "tree"}
        order = found["tree"].to_numpy()
        at = slice(width, 2 * width)
        mean_of, splits = np.zeros((trees, width)), np.zeros((trees, width), bool)
        mean_of[order], splits[order] = get["mean"], get["slot"] >= 0
        splits &= alive
        value = known.value[:, at]
        if level == 0:
            value[:] = mean_of
        sides = np.repeat(value[:, :, None], 2, 2)
        for i, tree in enumerate(order):
            here = np.flatnonzero(splits[tree])
            feature = drawn[tree, here, get["slot"][i, here]]
            known.code[tree, width + here] = known.first[feature] + get["bin"][i, here]
            sides[tree, here, 0], sides[tree, here, 1] = get["left"][i, here], get["right"][i, here]
        known.value[:, 2 * width : 4 * width] = sides.reshape(trees, 2 * width)
        alive = np.repeat(splits, 2, 1)
        if not alive.any():
            known.value[:, 1 << depth :] = np.repeat(known.value[:, 2 * width : 4 * width], 1 << (depth - level - 1), 1)
            break
    return known


def _level(rows: DataFrame, known: Trees, drawn: np.ndarray, level: int, mean: float, salt: np.uint64, leaf: int) -> DataFrame:
    """(tree, slot, bin, n, mean, left, right): the best splits of a level, one array entry per node."""
    trees, width, m = drawn.shape
    k, spark = len(known.cuts), rows.sparkSession
    forest = spark.sparkContext.broadcast((known, drawn))

    def summed(batches):
        known, drawn = forest.value
        held, size = [], 0

        def out():
            bins = np.concatenate([from_cells(b["cell"], k) for b in held])
            key = np.concatenate([b["key"].to_numpy() for b in held]).view(np.uint64) ^ salt
            label = np.concatenate([b["label"].to_numpy() for b in held]) - mean
            for t, at, n, s in _sums(known, drawn, level, bins, key, label):
                cols = [pa.array([t], pa.int32())] + [pa.array([x.tobytes()], pa.binary()) for x in (at.astype(np.int32), n.astype(np.int32), s)]
                yield pa.record_batch(cols, names=["tree", "at", "n", "s"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= PART:
                yield from out()
                held, size = [], 0
        if size:
            yield from out()

    def split(batches):
        tree, n, s = None, None, None

        def out():
            got = best_splits(n.reshape(width, m, BINS), s.reshape(width, m, BINS), leaf)
            kinds = {"slot": pa.int32(), "bin": pa.int32(), "n": pa.float64(), "mean": pa.float64(), "left": pa.float64(), "right": pa.float64()}
            cols = [pa.array([tree], pa.int32()), *[pa.array([got[c]], pa.list_(kind)) for c, kind in kinds.items()]]
            return pa.record_batch(cols, names=["tree", *kinds])

        for batch in batches:
            for t, *sums in zip(batch["tree"].to_pylist(), batch["at"], batch["n"], batch["s"]):
                if t != tree:
                    if tree is not None:
                        yield out()
                    tree, (n, s) = t, np.zeros((2, width * m * BINS))
                at, draws_, labels = (np.frombuffer(x.as_buffer(), kind) for x, kind in zip(sums, (np.int32, np.int32, np.float64)))
                n[at] += draws_
                s[at] += labels
        if tree is not None:
            yield out()

    sums = rows.select("cell", "key", "label").mapInArrow(summed, "tree int, at binary, n binary, s binary")
    met = sums.repartition("tree").sortWithinPartitions("tree")
    arrays = "slot array<int>, bin array<int>, n array<double>, mean array<double>, left array<double>, right array<double>"
    return met.mapInArrow(split, f"tree int, {arrays}")
