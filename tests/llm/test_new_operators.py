import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import op2_quality_rules as op2
from tillcast.llm import op11_sharding as op11
from tillcast.llm import op12_centroid_clustering as op12
from tillcast.llm import op13_importance_resampling as op13

SCHEMA = "doc_id long, text string"


# --- op11

def mixed(x):
    for _ in range(2):
        x = (x ^ x >> 16) * 0x45D9F3B % 2**32
    return x ^ x >> 16


def shard_by_hand(key, weights):
    digest = hashlib.md5(f"{'' if key is None else key}".encode()).hexdigest()
    drawn = []
    for s, w in enumerate(weights):
        x = mixed(mixed((int(digest[:8], 16) + s * 0x9E3779B9) % 2**32) ^ int(digest[8:16], 16))
        drawn.append((-math.log((x + 0.5) / 2**32) / w, s))
    return min(drawn)[1]


def test_shards_match_hand_loop_and_growth_moves_only_to_new(spark):
    weights = [1.0, 2.0, 0.5, 3.0, 1.0, 1.0, 1.0]
    got = op11.sharded(spark.range(3000).withColumnRenamed("id", "k"), "k", weights, [2.5]).collect()
    for r in got:
        assert r["shard"] == shard_by_hand(r["k"], weights)
        assert r["grown_shard"] in (r["shard"], 7)
        assert r["grown_shard"] == shard_by_hand(r["k"], [*weights, 2.5])
    n = Counter(r["shard"] for r in got)
    for s, w in enumerate(weights):
        assert abs(n[s] / 3000 - w / sum(weights)) < 0.04
    assert abs(sum(r["grown_shard"] == 7 for r in got) / 3000 - 2.5 / (sum(weights) + 2.5)) < 0.04
    with pytest.raises(ValueError):
        op11.draws(F.lit(1), [1.0, 0.0])


@pytest.mark.parametrize("block_rows", [1, 7, 10**6])
def test_slots_are_gapless_and_do_not_depend_on_blocks(spark, block_rows):
    rows = [(i % 90, f"t{i % 11}") for i in range(400)] + [(None, "a"), (None, None), (5, ""), (6, "x" * 200_000)] + [(7, "hot")] * 300
    docs = op11.measured(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = op11.slotted(op11.sharded(docs, "doc_id", [1.0] * 5, [1.0]), docs.columns, block_rows)
    assert got.columns == ["doc_id", "size", "text_crc32", "shard", "grown_shard", "slot"]
    got = [tuple(r) for r in got.collect()]
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter(r[:3] for r in got) == want
    by_shard = defaultdict(list)
    for i, size, crc, shard, _, slot in got:
        h = int(hashlib.md5(f"{'' if i is None else i}:{size}:{crc}".encode()).hexdigest()[:8], 16)
        by_shard[shard].append((slot, (h, -1 if i is None else i, size, crc)))
        assert shard == shard_by_hand(i, [1.0] * 5)
    for placed in by_shard.values():
        placed.sort()
        assert [s for s, _ in placed] == list(range(len(placed)))
        assert [k for _, k in placed] == sorted(k for _, k in placed)


def test_sharding_of_nothing_and_of_clashing_columns(spark):
    none = op11.measured(spark.createDataFrame([], SCHEMA))
    assert op11.slotted(op11.sharded(none, "doc_id", [1.0] * 3), none.columns).count() == 0
    odd = spark.createDataFrame([(1, 2, 3, 4, 5, 6, 7)], "doc_id long, slot int, shard int, row int, n int, h int, block int")
    out = op11.slotted(op11.sharded(odd, "doc_id", [1.0] * 3), ["doc_id"]).first()
    assert (out["row"], out["n"], out["h"], out["block"], out["slot"]) == (4, 5, 6, 7, 0)
    assert out["shard"] == shard_by_hand(1, [1.0] * 3)


# --- op12

def nearest_by_hand(x, centers):
    far = ((x[:, None, :] - centers[None]) ** 2).sum(2)
    return far.argmin(1), far.min(1)


@pytest.mark.parametrize("spread,offset", [(3, 0), (200, 0), (1, 50_000), (1 << 26, 0)])
def test_search_matches_all_distances(spread, offset):
    rng = np.random.default_rng(spread)
    centers = rng.integers(-spread, spread + 1, (17, 8)) + offset
    centers[5] = centers[2]  # equal centroids: the smaller number
    x = np.concatenate([rng.integers(-spread, spread + 1, (500, 8)) + offset, centers, np.zeros((1, 8), np.int64)])
    number, far = op12.Centroids(centers).nearest(x)
    want, least = nearest_by_hand(x, centers)
    assert number.tolist() == want.tolist() and far.tolist() == least.tolist()


def test_search_passes_over_most_distances(monkeypatch):
    rng = np.random.default_rng(1)
    scale = rng.integers(1, 400, (40, 1))
    centers = rng.integers(-9, 10, (40, 16)) + scale * 20
    measured = []
    plain = np.einsum
    monkeypatch.setattr(op12.np, "einsum", lambda s, a, b: (measured.append(len(a)) if a.dtype == np.int64 else None, plain(s, a, b))[1])
    x = np.repeat(centers, 10, 0) + rng.integers(-3, 4, (400, 16))
    number, _ = op12.Centroids(centers).nearest(x)
    assert number.tolist() == nearest_by_hand(x, centers)[0].tolist()
    assert sum(measured) < 0.25 * 400 * 40


def lloyd_by_hand(rows, k, rounds, seed):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 4 and all(e is not None and math.isfinite(e) and abs(e) < 2**19 for e in v):
            kept.append((i, [math.floor(256 * float(np.float32(e))) for e in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centers = np.array([v for _, v in order[:k]], np.int64)
    x = np.array([v for _, v in kept], np.int64)
    for _ in range(rounds):
        number, _ = nearest_by_hand(x, centers)
        for c in range(len(centers)):
            if (number == c).any():
                centers[c] = x[number == c].sum(0) // (number == c).sum()
    number, far = nearest_by_hand(x, centers)
    return sorted(zip([(-1 if i is None else i) for i, _ in kept], number.tolist(), far.tolist())), centers


def test_clusters_match_hand_loop(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(i % 3, 0.3) for _ in range(4)]) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0]), (302, [1.0]), (303, [float("nan")] * 4), (304, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(305, [2.0**19, 0.0, 0.0, 0.0]), (None, [0.5] * 4), (7, [0.1] * 4), (306, [-0.001] * 4)] + [(400 + i, [1.0] * 4) for i in range(150)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("cluster", F.lit(9)).repartition(4)
    near, centers = op12.centroid_clusters(op12.integer_vectors(table, 4), 9, 5, 2)
    want, at = lloyd_by_hand(rows, 9, 5, 2)
    assert sorted((-1 if r["vec_id"] is None else r["vec_id"], r["cluster"], r["distance"]) for r in near.collect()) == want
    assert centers.tolist() == at.tolist()


def test_clusters_of_nothing_and_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    near, centers = op12.centroid_clusters(op12.integer_vectors(spark.createDataFrame([], schema)))
    assert near.count() == 0 and len(centers) == 0
    near, centers = op12.centroid_clusters(op12.integer_vectors(spark.createDataFrame([(1, [1.0] * 64), (2, [2.0] * 64)], schema)))
    assert len(centers) == 2 and {r["distance"] for r in near.collect()} == {0}


# --- op13

def test_position_table_matches_crc32():
    rng = np.random.default_rng(4)
    data = rng.integers(0, 256, 70_000).astype(np.uint8)
    starts = np.concatenate([rng.integers(0, 60_000, 300), [0, 5, 5, 69_999]])
    sizes = np.concatenate([rng.integers(1, 400, 300), [70_000, 1, 64, 1]])
    for reach in (4, 13, 64):
        got = op13.PositionTable(reach).crc32(data, starts, starts + sizes)
        assert got.tolist() == [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(starts, sizes)]
    assert len(op13.PositionTable().crc32(data, starts[:0], starts[:0])) == 0


def words(text):
    out, word = [], bytearray()
    for b in (text or "").encode() + b" ":
        b = b + 32 if 0x41 <= b <= 0x5A else b
        if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A:
            word.append(b)
        elif word:
            out.append(bytes(word))
            word = bytearray()
    return out


def drawn_by_hand(docs, target, ngram, buckets=10_000):
    def found(text):
        w = words(text)
        return [zlib.crc32(b" ".join(w[i : i + k])) % buckets for k in range(1, ngram + 1) for i in range(len(w) - k + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(found(text))
    for text in target:
        t.update(found(text))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (sum(s.values()) + buckets) / ((s[b] + 1) * (sum(t.values()) + buckets)))) for b in range(buckets)}
    out = []
    for i, text in docs:
        f = found(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([-1 if i is None else i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))])
    order = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0], r[4], r[1], r[2]))
    top = len(order) * 10 // 100
    ranks = defaultdict(list)
    for k, r in enumerate(order):
        ranks[tuple(r)].append(k + 1 if k < top else None)
    return [(*r[:4], ranks[tuple(r)].pop(0) if r[4] >= 20 else None) for r in out]


@pytest.mark.parametrize("ngram", [1, 3])
def test_draw_matches_hand_loop(spark, ngram, monkeypatch):
    rng = random.Random(6)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(i, prose(rng.randint(1, 80))) for i in range(400)]
    docs += [(None, prose(30)), (401, None), (402, ""), (403, "... !"), (404, "A" * 5000 + " b" * 30), (405, prose(20_000)), docs[3], (3, prose(25))]
    docs += [(900, prose(40) if k == 0 else "same words over and over again " * 5) for k in range(60)]
    target = [prose(50), None, "", "x" * 300]
    monkeypatch.setattr(op13, "SCORES_A_BAND", 64)
    frames = spark.createDataFrame(docs, SCHEMA).repartition(4), spark.createDataFrame([(t,) for t in target], "text string")
    scored = op13.importance(*frames, ngram=ngram)
    n = scored.where("n_words >= 20").count()
    got = op13.ranked(scored, 10 * n // 100, F.col("row.n_words") >= 20)
    got = [(-1 if r["doc_id"] is None else r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got.collect()]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(got, key=key) == sorted(drawn_by_hand(docs, target, ngram), key=key)


def test_draw_of_nothing(spark):
    docs, target = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "text string")
    assert op13.resampled(docs, target).count() == 0
    few = spark.createDataFrame([(1, "a b"), (2, "word " * 25)], SCHEMA).withColumn("rank", F.lit("x")).withColumn("row", F.lit(0))
    got = op13.resampled(few, target)
    assert {(r["doc_id"], r["rank"]) for r in got.collect()} == {(1, None), (2, None)}


def test_draw_prefers_the_target(spark):
    near = [(i, " ".join(["apple", "pear", "plum", f"w{i % 7}"] * 8)) for i in range(200)]
    far = [(1000 + i, " ".join(["iron", "zinc", "lead", f"w{i % 7}"] * 8)) for i in range(800)]
    target = spark.createDataFrame([("apple pear plum " * 200,)], "text string")
    got = op13.resampled(spark.createDataFrame(near + far, SCHEMA), target).where("rank IS NOT NULL").collect()
    assert len(got) == 100 and sum(r["doc_id"] < 1000 for r in got) > 60


# --- op2: grams within texts

def test_grams_stay_within_their_text():
    import pyarrow as pa

    texts = ["one two three", "", "x", "four five", None, "ab", "six seven eight nine"]
    for order in (texts, texts[::-1]):
        data, offs = op2.pieces(pa.array(order)).__next__()[2:]
        starts, ends, wo = op2.spans(data, offs, op2.SPACED)
        for feature, cuts, base in op2._parts(data, offs, wo, op2.hashes(data, starts, ends)):
            assert len(cuts) == len(order) + 1 and cuts[-1] == len(feature)
            for r, text in enumerate(order):
                alone, aoffs = op2.pieces(pa.array([text])).__next__()[2:]
                s, e, w = op2.spans(alone, aoffs, op2.SPACED)
                parts = list(op2._parts(alone, aoffs, w, op2.hashes(alone, s, e)))
                own = feature[cuts[r] : cuts[r + 1]].tolist()
                assert own in [p[0].tolist() for p in parts if p[2] == base] + ([[]] if not own else [])


def test_word_order_counts_and_dealing_does_not(spark):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(40)]

    def ordered(n):
        i = rng.randrange(40)
        return [vocabulary[(i + k) % 40] for k in range(n)]

    rows, labels = [], []
    for i in range(600):
        words = ordered(rng.randint(12, 30))
        if i % 2:
            rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1 - i % 2))
    docs = spark.createDataFrame(rows, SCHEMA)
    known = spark.createDataFrame(labels[:400], "doc_id long, quality int")
    got = [{r["doc_id"]: r["probability"] for r in op2.quality_scores(docs.repartition(n), known).collect()} for n in (2, 13)]
    assert got[0].keys() == got[1].keys() and all(abs(got[0][i] - got[1][i]) < 1e-6 for i in got[0])
    right = sum((got[0][i] >= 0.5) == (i % 2 == 0) for i in range(400, 600))
    assert right >= 170
