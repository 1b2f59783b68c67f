"""URL filter: host and path rules first, else logistic regression on hashed character n-grams.

Defined cases: a null url, or one without "://", has an empty host and path and is judged by the
model's bias alone; an empty rule table leaves all to the model; an empty labelled table allows all.
Equal rules with different verdicts: block wins. Repeated urls and pages are judged row by row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.batches import flat, mix
from tillcast.llm.logistic import fit_logistic, sigmoid
from tillcast.llm.registry import query, table

DIMS = 1 << 14
SIZES = (3, 4, 5)
MAX_LABELLED = 10_000
BLOCK_BELOW = 0.3  # unknown names score around one half; only those that look unwanted go

RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)

#: names of a small labelled table: what unwanted and what wanted hosts are called anywhere
UNWANTED = (
    "lucky-casino", "royalcasino", "grand-casino-slots", "pokerwin", "jackpot-win", "casinobonus", "cheapmeds", "pill-shop",
    "buy-pills-now", "discount-pharmacy", "cheap-viagra", "best-bets", "betsport", "freebet-tips", "sport-bets", "adultvideo",
    "adult-dating", "xxx-tube", "adult-cams", "spamlinks", "link-spam", "seo-farm", "adserver", "ads-click", "click-track", "banner-ads",
)
WANTED = (
    "citylibrary", "gardening", "weather-report", "the-kitchen", "worldhistory", "science-news", "mathsforum", "northern-lights",
    "nation-station", "otherthings", "theatre-week", "thunderstorms", "thesistips", "railwaystation", "education", "traditions",
    "handthreads", "healthanswers", "thatch-roofs", "thorn-hedge", "tablethings", "motionpictures", "missionstatement",
    "heritage-tours", "herbgarden", "birthstones",
)
#: both classes take these in turn, so that only names tell them apart
FORMS = (
    "http://{}.com/en/140", "https://www.{}.net/7", "https://{}.org/fr/310?page=3", "http://m.{}.com/de/15/", "https://{}.net/es/66.html",
    "http://blog.{}.org/en/9052#top", "https://www.{}.com/today", "http://{}.net/de/777", "https://m.{}.org/es/12?ref=mail",
    "http://www.{}.com/fr/8841.html", "https://blog.{}.net/en/19/", "http://{}.org/tips/88", "https://{}.com/de/4#live",
)
LABELLED = [(FORMS[i % len(FORMS)].format(name), label) for label, names in ((0, UNWANTED), (1, WANTED)) for i, name in enumerate(names)]


def host_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or end, A-Z lower-cased; path: then up to `?` or `#`."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.regexp_extract(text, parts, 1), letters, letters.lower()), F.regexp_extract(text, parts, 2)


def _rule(rules, host: Column, path: Column, verdict: bool) -> Column:
    """The longest rule that fits, or its verdict."""
    found = F.lit(None).cast("string")
    for text, says in sorted(set(rules), key=lambda r: (len(r[0]), r[1] == "block")):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, says if verdict else text).otherwise(found)
    return found


def _grams(column: pa.Array, salt: int):
    """(row, hashed n-gram) of all byte n-grams of each row."""
    data, offs = flat(column)
    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    left = offs[1:][row] - np.arange(len(data))
    for n in SIZES:
        at = np.flatnonzero(left >= n)
        code = np.full(len(at), salt * 16 + n, np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + data[at + k]
        yield row[at], (mix(code) % np.uint64(DIMS)).astype(np.int64)


def _features(host: pa.Array, path: pa.Array):
    named = pc.binary_join_element_wise("^", pc.fill_null(host, ""), "$", "")
    for column, salt in ((named, 1), (pc.fill_null(path, ""), 2)):
        yield from _grams(column, salt)


def train(labelled: DataFrame) -> tuple[np.ndarray, float]:
    """Fits on at most `MAX_LABELLED` rows (url, label), the first by hash."""
    host, path = host_path(F.col("url"))
    rows = labelled.where(F.col("label").isin(0, 1)).select(host.alias("host"), path.alias("path"), F.col("label").cast("double").alias("label"))
    got = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(MAX_LABELLED).toArrow()
    if got.num_rows == 0:
        return np.zeros(DIMS, np.float32), 6.0
    x = np.zeros((got.num_rows, DIMS), np.float32)
    for row, gram in _features(got["host"].combine_chunks(), got["path"].combine_chunks()):
        x[row, gram] = 1.0
    x /= np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
    return fit_logistic(x, got["label"].to_numpy(), l2=1e-4, rate=0.1)


def url_verdicts(pages: DataFrame, labelled: DataFrame, rules=RULES, threshold: float = BLOCK_BELOW, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule, score (probability that the url is wanted) and verdict.

    Columns of `pages` with those names are replaced, all others stay. Urls of any length are scored whole.
    """
    spark = pages.sparkSession
    host, path = host_path(F.col(url))
    judged = pages.withColumns({"host": host, "path": path})
    judged = judged.withColumn("rule", _rule(rules, F.col("host"), F.col("path"), False))
    model = spark.sparkContext.broadcast(train(labelled))

    @F.pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        w, bias = model.value
        total, seen = np.zeros(len(hosts)), np.zeros(len(hosts))
        for row, gram in _features(pa.Array.from_pandas(hosts, type=pa.string()), pa.Array.from_pandas(paths, type=pa.string())):
            pair = np.unique(row * DIMS + gram)
            total += np.bincount(pair // DIMS, w[pair % DIMS], len(hosts))
            seen += np.bincount(pair // DIMS, minlength=len(hosts))
        return pd.Series(sigmoid(total / np.sqrt(np.maximum(seen, 1)) + bias))

    judged = judged.withColumn("score", score("host", "path"))
    by_model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return judged.withColumn("verdict", F.coalesce(_rule(rules, F.col("host"), F.col("path"), True), by_model))


@query("op1_url_filter")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    labelled = spark.createDataFrame(LABELLED, "url string, label int")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return url_verdicts(pages, labelled).select("page_id", "host", "path", "rule", "verdict", "score")
