import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillcast.llm import op1_url_filter as op1
from tillcast.llm import op2_quality_rules as op2
from tillcast.llm import op3_ngram_join as op3
from tillcast.llm import op4_license_scan as op4
from tillcast.llm import op5_line_dedup as op5
from tillcast.llm import op6_decontamination as op6
from tillcast.llm import op7_language_id as op7
from tillcast.llm import op8_substring_dedup as op8
from tillcast.llm import op9_best_fit_packing as op9
from tillcast.llm import op10_quality_classifier as op10
from tillcast.llm.batches import SPACED, flat, hashes, row_words, spans
from tillcast.llm.components import components
from tillcast.sources.staging import CLEANUP, staged

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
rng = random.Random(5)
VOCAB = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edited(text, every, seed):
    words = text.split()
    for i in range(every, len(words), every):
        words[i] = f"edit{seed}x{i}"
    return " ".join(words)


BASE = prose(200, 1)
PASSAGE = prose(60, 2)
TEXTS = [
    BASE, BASE, edited(BASE, 90, 1), edited(BASE, 7, 2), prose(150, 3), None, "", "one two", "one two", "One  TWO",
    prose(80, 4) + " " + PASSAGE + " " + prose(70, 5), prose(33, 6) + " " + PASSAGE + " " + prose(90, 7),
    "a line of some words here\nand another line\na line of some words here\n\n" + prose(30, 8),
    "a line of some words here now\n" + prose(40, 9), "\n".join(["Released under the MIT License.", prose(50, 10)]),
    "word " * 300, prose(20_000, 11), "   \n\t ",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [(None, "null id", None, None, None), rows[4]]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in (text or "").split()]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_words_of_bytes():
    texts = ["Über  straße\n", None, "", "a\x0bb", "x"]
    data, offs = flat(pa.array(texts))
    starts, ends, wo = spans(data, offs, SPACED)
    assert [data[s:e].tobytes().decode() for s, e in zip(starts, ends)] == ["Über", "straße", "a", "b", "x"]
    assert wo.tolist() == [0, 2, 2, 2, 4, 5]
    assert len(set(hashes(data, starts, ends).tolist())) == 5


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(20)] + [(100, 100 + i) for i in range(1, 9)] + [(None, 3), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 100 for i in range(100, 109)}}


def test_url_rules(spark):
    urls = [
        "http://A.org/x?y", "https://sub.example.org/es/1", "http://example.org/en/12", "http://example.org/en/2", "http://x.com/fr/1#a",
        "http://x.com/de/", "http://org", "no scheme", None, "http://cheap-pills.example.net/en/1", "http://badorg/x",
    ]
    pages = spark.createDataFrame([(i, u, "keep") for i, u in enumerate(urls)], "page_id long, url string, score string")
    labelled = spark.createDataFrame(op1.LABELLED, "url string, label int")
    got = {r["page_id"]: r for r in op1.url_verdicts(pages, labelled).collect()}
    assert [got[i]["rule"] for i in range(11)] == ["org/", "example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, None, None, None]
    assert [got[i]["verdict"] for i in range(6)] == ["allow", "block", "block", "allow", "allow", "block"]
    assert (got[0]["host"], got[0]["path"], got[7]["host"], got[8]["path"]) == ("a.org", "/x", "", "")
    assert got[9]["verdict"] == "block"
    none = spark.createDataFrame([], "url string, label int")
    assert {r["verdict"] for r in op1.url_verdicts(pages, none, ()).collect()} == {"allow"}
    assert op1.url_verdicts(pages.limit(0), labelled).count() == 0


def test_quality_counts_match_brute_force(spark, docs, empty):
    labels = spark.createDataFrame([(0, 1, 0), (4, 1, 0), (15, 0, 0), (15, 0, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = op2.quality_scores(docs, labels)
    by_id = {r["doc_id"]: r for r in got.collect()}
    for i, t in enumerate(TEXTS):
        w = (t or "").split()
        windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + d for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for d in range(5)}
        lines = [x for x in (t or "").split("\n") if x.split()]
        r = by_id[i]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w))
        assert not (r["kept"] and r["base_failed"])
    assert got.count() == len(TEXTS) + 2
    assert op2.quality_scores(empty, labels.limit(0)).count() == 0


def test_near_duplicates_match_brute_force(docs, empty):
    got = {r["doc_id"]: r for r in op3.near_duplicates(docs).collect()}
    sets = [shingles(t) for t in TEXTS]
    root = list(range(len(TEXTS)))
    for _ in TEXTS:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    assert {i: (got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(TEXTS))} == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert got[None]["component_id"] is None
    assert op3.near_duplicates(empty).count() == 0


def test_licenses(spark, docs, empty):
    templates = spark.createDataFrame(op4.TEMPLATES, "license string, text string")
    extra = spark.createDataFrame([(50, "x " * 40 + "licensed under the apache license version 2.1 " + "y " * 9, "", "", 0), (51, "the rights are reserved", "", "", 0)], SCHEMA)
    got = {(r["doc_id"], r["license"]): r["containment"] for r in op4.scan_licenses(docs.union(extra), templates).collect()}
    assert got == {(14, "mit"): 1.0, (50, "apache-2.0"): 0.75}
    assert op4.scan_licenses(empty, templates).count() == 0


def test_lines_match_brute_force(docs, empty):
    got = {tuple(r) for r in op5.repeated_lines(docs).collect()}
    lines = [(i, k, set(x.split())) for i, t in enumerate(TEXTS) for k, x in enumerate((t or "").split("\n"))]
    lines = [x for x in lines if x[2]]
    want = {y[:2] for n, y in enumerate(lines) if any(7 * len(x[2] & y[2]) >= 3 * (len(x[2]) + len(y[2])) for x in lines[:n])}
    assert got == want and len(want) > 5
    cleaned = {r["doc_id"]: r["text"] for r in op5.without_repeats(docs).collect()}
    assert cleaned[12].startswith("a line of some words here\nand another line\n\n") and cleaned[5] is None
    assert op5.without_repeats(empty).count() == 0


def test_lines_need_no_python_workers(docs, monkeypatch):
    monkeypatch.setattr(op5, "staged", lambda df: df)
    plan = op5.repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    assert not any(x in plan for x in ("MapInArrow", "FlatMapGroupsInArrow", "ArrowEvalPython", "BatchEvalPython"))


def test_only_lines_that_verification_asks_for_travel(spark):
    """Before, the whole texts of all documents were shuffled for each round of verification."""
    texts = [f"alpha beta{i}\tgamma\n\x0b \nsame line\r\nlast {i}" for i in range(300)] + [None, "", "alpha"]
    docs = spark.createDataFrame([*enumerate(texts), (None, "alpha"), (7, "other\nlines")], "doc_id long, text string")
    ends = spark.createDataFrame([(3, 0), (3, 0), (7, 1), (9, 2), (301, 0), (999, 0), (4, 50)], "doc long, line int")
    got = sorted(tuple(r) for r in op5._asked(docs, ends).collect())
    want = [(3, 0, "alpha beta3 gamma"), (7, 1, "  "), (7, 1, "lines"), (9, 2, "same line "), (301, 0, "")]
    assert [r for r in got if r[:2] in {w[:2] for w in want}] == want
    assert len(got) < len(want) + 5
    plan = op5._asked(docs, ends)._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan


def test_late_pairs_shuffle_one_index(spark):
    texts = [prose(12, i % 40) + f" own{i}" for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = op5.line_sets(docs).where("NOT copy").drop("copy")
    late = op5.late_pairs(sets, sets.select("doc", "line").where("doc % 3 = 0"))
    assert {r["doc"] % 3 for r in late.collect()} == {1, 2}
    assert "ReusedExchange" in late._jdf.queryExecution().executedPlan().toString()


def test_shuffle_files_of_a_staged_table_go(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {f.toString() for f in iter_java(manager.getAllFiles())}

    def iter_java(seq):
        return [seq.apply(i) for i in range(seq.size())]

    before = files()
    counted = staged(spark.range(20_000).groupBy((F.col("id") % 5000).alias("k")).count())
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert counted.count() == 5000 and spark.conf.get(CLEANUP, None) in (None, "false")


def test_words_between_any_whitespace(spark):
    docs = spark.createDataFrame([(1, "a\tb  c\x0bd\x0ce\rf\n \t\r\ng h"), (2, " f e d c b a \nh g x y")], "doc_id long, text string")
    assert sorted(tuple(r) for r in op5.repeated_lines(docs).collect()) == [(2, 0)]
    assert {r["line"] for r in op5.line_sets(docs).where("doc = 1").collect()} == {0, 2}


def test_near_copies_of_a_line_do_not_meet_all_in_all(spark):
    n = 400
    base = [f"word{k}" for k in range(30)]
    texts = [" ".join(base[: i % 30] + [f"changed{i}"] + base[i % 30 + 1 :]) for i in range(n)]
    docs = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA).select("doc_id", "text")
    sets = op5.line_sets(docs).where("NOT copy").drop("copy")
    sure = op5._verified(docs, op5.star_pairs(sets))
    assert op5.late_pairs(sets, sure).count() < 10 * n
    assert {r["doc_id"] for r in op5.repeated_lines(docs).collect()} == set(range(1, n))


def test_fm_index_finds_every_occurrence():
    r = np.random.default_rng(3)
    text = r.integers(0, 4, 300)
    index = op6.FMIndex(text)
    patterns = r.integers(1, 6, (50, 3))
    low, high = index.search(patterns)
    for p, a, b in zip(patterns, low, high):
        want = [i for i in range(298) if (text[i : i + 3] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("block_words", [500_000, 20])
def test_decontamination_matches_brute_force(spark, docs, empty, block_words):
    items = [(7, PASSAGE.upper()), (8, "one-two"), (9, None), (10, ""), (None, BASE), (7, PASSAGE.upper()), (11, prose(12, 4))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in op6.find_contamination(docs, bench, ("doc_id",), cleaned=True, block_words=block_words).collect()}
    known = {7: PASSAGE.split(), 8: ["one", "two"], 11: prose(12, 4).split()}
    for i, t in enumerate(TEXTS):
        w = (t or "").lower().split()
        hit, found = set(), set()
        for k, item in known.items():
            m = min(10, len(item))
            windows = {tuple(item[j : j + m]) for j in range(len(item) - m + 1)}
            for j in range(len(w) - m + 1):
                if tuple(w[j : j + m]) in windows:
                    hit |= set(range(j, j + m))
                    found.add(str(k))
        assert {p for s, e in zip(got[i]["starts"], got[i]["ends"]) for p in range(s, e)} == hit
        assert set(got[i]["items"]) == found and got[i]["n_words"] == len(w)
        assert (got[i]["clean_text"] or "").lower().split() == [x for p, x in enumerate(w) if p not in hit]
    assert op6.find_contamination(empty, bench, ("doc_id",)).count() == 0
    assert op6.decontaminated(docs, bench.limit(0)).count() == len(TEXTS) + 2
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_language_parser_counts_phrases():
    parser = op7.Parser({"a": b"abcabcabc", "b": b"xyzzy"})
    data, offs = flat(pa.array(["abcabc", "xyzxyz", "", "qq"]))
    phrases = parser.costs(data, offs) / parser.bits
    assert phrases[0, 0] == 1 and phrases[0, 1] > 5 and phrases[1, 1] == 2 and phrases[2].tolist() == [0, 0]


def test_language_held_out_accuracy(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = op7.op7(spark, "/root/testdata/sf0.001").join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?")], "doc_id long, text string")
    assert {(r["lang_pred"], r["score"]) for r in op7.predict_language(odd, op7.train(docs)).collect()} == {("und", 0.0)}
    assert {r["lang_pred"] for r in op7.predict_language(docs, op7.train(empty)).collect()} == {"und"}


def test_passages_match_brute_force(docs, empty):
    got = defaultdict(list)
    for r in op8.repeated_passages(docs).collect():
        got[r["doc_id"]].append(r)
    assert {0, 1, 2, 10, 11} <= set(got) <= {0, 1, 2, 3, 10, 11}
    (first,), (second,) = got[10], got[11]
    assert (first["start_word"], first["end_word"], first["removed"]) == (80, 140, False)
    assert (second["start_word"], second["end_word"], second["kept_doc_id"], second["removed"]) == (33, 93, 10, True)
    assert op8.repeated_passages(empty).count() == 0


def test_packing_keeps_every_word(docs, empty):
    rows = op9.best_fit(docs, lengths=(64, 256, 1024), shard_pieces=5).collect()
    words = Counter()
    bins = defaultdict(list)
    for r in rows:
        words[r["doc_id"]] += r["n_tokens"]
        if r["sequence_id"] is not None:
            bins[r["sequence_id"], r["capacity"]].append((r["offset"], r["n_tokens"]))
    for i, t in enumerate(TEXTS):
        assert words[i] == len((t or "").split()) * (2 if i == 4 else 1)
    assert len({s for s, _ in bins}) == len(bins)
    for (_, capacity), parts in bins.items():
        used = sum(n for _, n in parts)
        assert capacity == min(c for c in (64, 256, 1024) if c >= used)
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
    assert op9.best_fit(empty).count() == 0


def test_quality_classifier_held_out_accuracy(spark, empty):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = op10.op10(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.95
    vectors = op10.word_vectors(empty)
    model = op10.train(empty, labels.limit(0).selectExpr("doc_id", "quality"), vectors)
    odd = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {r["score"] for r in op10.classify(odd, vectors, model).collect()} == {0.5}


CLASHING = ["row", "place", "gone", "id", "_id", "_gone", "_place", "starts", "ends", "items", "n_words", "clean_text", "a.b", "token", "component"]


@pytest.fixture(scope="module")
def odd(spark, docs):
    """The fixture's rows with columns that are named like those of the operators."""
    return docs.selectExpr("*", *[f"concat('{c} ', doc_id) AS `{c}`" for c in CLASHING])


def test_stages_keep_columns_of_any_name(spark, docs, odd):
    bench = spark.createDataFrame([(7, PASSAGE)], "item_id long, text string")
    labels = spark.createDataFrame([(0, 1), (15, 0)], "doc_id long, quality int")
    steps = [
        lambda d: op2.kept_documents(d, labels), op5.without_repeats, op3.distinct_documents, lambda d: op6.decontaminated(d, bench),
    ]
    for step in steps:
        found = step(odd)
        assert found.columns == odd.columns
        got = found.collect()
        assert sorted((tuple(r)[: len(docs.columns)] for r in got), key=str) == sorted((tuple(r) for r in step(docs).collect()), key=str)
        for r in got:
            assert all(r[c] == (None if r["doc_id"] is None else f"{c} {r['doc_id']}") for c in CLASHING)
    pages = spark.createDataFrame([("x", "http://a.org/" + "long/" * 20_000, "y")], "_says string, url string, verdict string")
    (page,) = op1.url_verdicts(pages, spark.createDataFrame(op1.LABELLED, "url string, label int")).collect()
    assert (page["_says"], page["verdict"], len(page["path"])) == ("x", "allow", 100_001)


def test_pipeline_stages_match_brute_force(spark, docs, empty, tmp_path):
    """Each stage on its own input; empty tables give empty results."""
    spark.createDataFrame([(7, PASSAGE), (8, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(4, 1, 0), (15, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    sf = str(tmp_path)
    by_name = dict(corpus_pipeline.STAGES)
    every = docs.collect()

    verdicts = {r["doc_id"]: r["kept"] for r in op2.quality_scores(docs, spark.read.parquet(sf + "/labels.parquet")).collect()}
    kept = by_name["quality rules"](spark, docs, sf).collect()
    assert sorted(map(str, kept)) == sorted(str(r) for r in every if verdicts[r["doc_id"]])
    for r in every:
        w = (r["text"] or "").split()
        windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + d for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for d in range(5)}
        assert not (verdicts[r["doc_id"]] and (len(w) < 10 or 100 * len(covered) > 20 * len(w)))

    seen, want = [], {}
    for r in sorted((r for r in every if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        if r["doc_id"] in want or r["text"] is None:
            continue
        lines = []
        for line in r["text"].split("\n"):
            own = set(line.split())
            if not own or not any(7 * len(own & x) >= 3 * (len(own) + len(x)) for x in seen):
                lines.append(line)
            if own:
                seen.append(own)
        want[r["doc_id"]] = "\n".join(lines)
    got = by_name["line dedup"](spark, docs, sf).collect()
    assert len(got) == len(every)
    assert all(r["text"] == want.get(r["doc_id"], None if r["doc_id"] is not None else "null id") for r in got)
    assert all(r["n_chars"] == len(r["text"]) for r in got if r["text"] is not None and r["doc_id"] is not None)

    sets = [shingles(t) for t in TEXTS]
    root = list(range(len(TEXTS)))
    for _ in TEXTS:
        for a, x in enumerate(sets):
            for b, y in enumerate(sets):
                if x and y and 100 * len(x & y) >= 75 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    got = Counter(r["doc_id"] for r in by_name["n-gram Jaccard join"](spark, docs, sf).collect())
    assert got == Counter([i for i in range(len(TEXTS)) if root[i] == i] + [None, 4])

    passage = PASSAGE.split()
    windows = {tuple(passage[i : i + 10]) for i in range(len(passage) - 9)}
    for r in by_name["benchmark decontamination"](spark, docs, sf).collect():
        w = (r["text"] or "").split()
        assert not any(tuple(w[i : i + 10]) in windows for i in range(len(w) - 9))
        assert r["doc_id"] is None or PASSAGE in (TEXTS[r["doc_id"]] or "") or r["text"] == TEXTS[r["doc_id"]]

    packed = Counter()
    for r in by_name["best-fit packing"](spark, docs, sf).collect():
        packed[r["doc_id"]] += r["n_tokens"]
    assert packed == Counter({i: len((t or "").split()) * (2 if i == 4 else 1) for i, t in enumerate(TEXTS)} | {None: 2})
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf).count() == 0


def plain_best_fit(sizes, lengths, cost):
    """Every open sequence and every later piece are looked at for every piece; of equal rooms the newest is taken."""
    bins, placed = [], []
    for i, size in enumerate(sizes):
        fits = [(c - used, -since, k) for k, (c, used, since) in enumerate(bins) if c - used >= size]
        if fits:
            k = min(fits)[2]
        else:

            def price(c):
                later = sum(x for x in sizes[i + 1 :] if x <= c - size)
                return (c + cost) / (size + min(c - size, later)), c

            k = len(bins)
            bins.append((min((c for c in lengths if c >= size), key=price), 0, 0))
        capacity, used, _ = bins[k]
        placed.append((k, used))
        bins[k] = capacity, used + size, i
    final = [min(c for c in lengths if c >= used) for _, used, _ in bins]
    return [(k, at, final[k]) for k, at in placed]


def test_packing_matches_plain_best_fit():
    r = np.random.default_rng(8)
    for n in (0, 1, 7, 60, 250):
        sizes = np.sort(r.integers(1, 1025, n) // r.integers(1, 40, n) + 1)[::-1].astype(np.int64)
        got = zip(*(x.tolist() for x in op9.pack(sizes, (64, 256, 1100), 16)))
        assert list(got) == plain_best_fit(sizes.tolist(), (64, 256, 1100), 16)


def test_equal_rows_are_dealt_to_all_shards(spark):
    docs = spark.range(40_000).selectExpr("7L AS doc_id", "'two words' AS text").union(spark.createDataFrame([(2**60 + 1, "x"), (None, "y z")], "doc_id long, text string"))
    rows = op9.best_fit(docs, shard_pieces=4_000).collect()
    shards = Counter(r["sequence_id"] >> 32 for r in rows)
    assert len(rows) == 40_002 and len(shards) == 11 and max(shards.values()) < 4_400
    assert {r["doc_id"] for r in rows} == {7, 2**60 + 1, None}
    lengths = spark.createDataFrame([(1, -5), (2, None), (3, 20_000)], "doc_id long, n int")
    got = sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in op9.best_fit(lengths.selectExpr("doc_id", "'' AS text", "n"), length=F.col("n")).collect())
    assert got == [(1, 0, 0), (2, 0, 0), (3, 0, 8192), (3, 8192, 8192), (3, 16384, 3616)]


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, sf)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert corpus_pipeline.run(spark, sf).columns[:2] == ["doc_id", "piece"]


def test_passages_behind_a_common_notice(spark):
    """Documents between the first and the last of a list are tried with each other, also of lists longer than a block."""
    notice, passage = prose(40, 900), prose(20, 901)
    texts = [prose(60, 1000 + i) + " " + notice + " " + (passage + " " if i in (5, 9) else "") + prose(60, 2000 + i) for i in range(160)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {(r["doc_id"], r["start_word"], r["end_word"], r["kept_doc_id"], r["removed"]) for r in op8.repeated_passages(docs).collect()}
    assert got == {(5, 60, 120, 5, False), (9, 60, 120, 5, True)}


def test_near_copies_share_a_band(spark):
    """One shared band makes a pair: 221 of these 300 passages of 51 words with one changed word have one, 185 have two."""
    rows = []
    for i in range(300):
        passage = prose(51, 5000 + i).split()
        rows += [(2 * i, " ".join(passage))]
        passage[6 + i % 39] = "changed"
        rows += [(2 * i + 1, " ".join(passage))]
    pairs = op8.candidate_pairs(op8.band_lists(spark.createDataFrame(rows, "doc_id long, text string")))
    met = {tuple(sorted(r)) for r in pairs.collect()}
    assert sum((2 * i, 2 * i + 1) in met for i in range(300)) >= 210


def test_passages_with_a_word_more_or_less():
    passage = prose(100, 70).split()

    def found(x, y):
        words = [op8.Words(h) for _, h in row_words(pa.array([" ".join(x), " ".join(y)]), SPACED)]
        return op8.common_passages(*words)

    gap = passage[:50] + passage[51:]
    before, after = prose(9, 71).split(), prose(30, 72).split()
    assert found(before + passage + after, gap) == [(9, 109, 0, 99)]
    assert found(gap, before + passage + after) == [(0, 99, 9, 109)]
    assert found(passage[:51], passage[:20] + before + passage[:51]) == [(0, 51, 29, 80)]
    assert found(passage[:50], before + passage[:50]) == []
    assert found(["a", "b"] * 60, ["a", "b"] * 80) == [(0, 120, 0, 160)]
    assert found(["a"] * 20_000, ["a"] * 300) == [(0, 20_000, 0, 300)]


def test_languages_with_few_letters_win_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    tiny = spark.createDataFrame([(10**6 + i, t, lang) for i, (t, lang) in enumerate([("12 34", "digits"), ("", "none"), ("xq", "tiny")] * 9)], docs.schema)
    parser = op7.train(docs.union(tiny))
    assert "digits" not in parser.names and "none" not in parser.names and {"de", "en", "es", "fr", "tiny"} <= set(parser.names)
    rows = op7.predict_language(docs, parser).join(docs.select("doc_id", "lang"), "doc_id").where(op7.held_out()).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    late = spark.createDataFrame([(i, "1 " * 5000 + "word", "xx") for i in range(8)], docs.schema)
    assert op7.train(late).names == ["xx"]


def test_too_many_languages_are_an_error(spark):
    rows = [(i, "some words", f"l{i // 8}") for i in range(8 * (op7.MAX_LANGUAGES + 1))]
    with pytest.raises(ValueError):
        op7.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
