"""Language identification by cross-parsing.

A suffix automaton per language holds a sample of its text. A text is cut into the longest phrases
that the automaton knows; the language with the fewest phrases wins. A phrase costs the bits that name
a place in the longest sample, whatever the language, so a small sample gains nothing. Texts are
parsed whole, as bytes, A-Z lower-cased and everything in ASCII that is no letter folded to one blank,
in strips of `STRIP` symbols that advance together: a step is one table lookup for all strips and
languages at once.

Samples hold `LETTERS` letters of each language, from as many slices of texts outside the test fold as
that takes, or all slices where there are fewer; a language without a letter is not learned. More than
`MAX_LANGUAGES` languages are an error.

Defined cases: null texts, texts without a letter, and a training set without any language give
`und` with score 0; equal costs go to the first language name; repeated rows are parsed row by row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.batches import LOWER, pieces
from tillcast.llm.registry import query, table
from tillcast.llm.sample import held_out

LETTERS = 20_000  # letters learned of each language, from the texts that come first by hash
SLICE = 400  # characters taken of each, from a place that depends on the id
MAX_LANGUAGES = 500
STRIP = 512
_RESTART = np.int32(1 << 30)

_KEEP = np.array([b >= 0x80 or 0x61 <= b <= 0x7A for b in range(256)])


def _folded(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with blanks of one 0 each, and the rows' new offsets."""
    data = np.where(_KEEP[LOWER[data]], LOWER[data], 0).astype(np.uint8)
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != 0) | (data[:-1] != 0)
    keep[offs[:-1][offs[:-1] < len(data)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return data[keep], at[offs]


class _Automaton:
    """The suffix automaton of a byte string, built online."""

    def __init__(self, text: bytes):
        self.next: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            cur = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = cur
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    twin = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = link[p]
                    link[q] = link[cur] = twin
            last = cur


class Parser:
    """Automata of all languages in one table: (state, symbol) to the next state, marked where a phrase ends."""

    def __init__(self, texts: dict[str, bytes]):
        self.names = sorted(texts)
        used = sorted({b for t in texts.values() for b in t})
        self.symbol = np.full(256, len(used), np.int64)  # unknown bytes
        self.symbol[used] = np.arange(len(used))
        self.width = len(used) + 1
        tables, self.roots, base = [], [], 0
        for name in self.names:
            edges = _Automaton(texts[name]).next
            t = np.full((len(edges), self.width), base | int(_RESTART), np.int32)
            for c, to in edges[0].items():
                t[:, self.symbol[c]] = (base + to) | int(_RESTART)
            for state, out in enumerate(edges):
                for c, to in out.items():
                    t[state, self.symbol[c]] = base + to
            tables.append(t)
            self.roots.append(base)
            base += len(edges)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.bits = np.full(len(self.names), np.log2(max(map(len, texts.values()), default=0) + 2))

    def costs(self, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Bits of each row's phrases, by language: (rows, languages)."""
        data, offs = _folded(data, offs)
        sizes = np.diff(offs)
        strips = -(-sizes // STRIP)
        row = np.repeat(np.arange(len(sizes)), strips)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(strips) - strips, strips)
        start = offs[:-1][row] + nth * STRIP
        size = np.minimum(STRIP, offs[1:][row] - start)
        order = np.argsort(-size, kind="stable")
        row, start, size = row[order], start[order], size[order]
        symbols = self.symbol[data]
        phrases = np.ones((len(self.names), len(row)), np.int64)
        state = np.repeat(np.array(self.roots, np.int64)[:, None], len(row), 1)
        live = np.searchsorted(-size, -np.arange(STRIP), "left")  # strips longer than t come first
        for t in range(int(size[0]) if len(size) else 0):
            n = live[t]
            got = self.table[state[:, :n] * self.width + symbols[start[:n] + t]]
            phrases[:, :n] += got >> 30
            state[:, :n] = got & (int(_RESTART) - 1)
        total = np.stack([np.bincount(row, p, len(sizes)) for p in phrases], 1)
        return total * self.bits


def train(documents: DataFrame) -> Parser:
    """A parser from bounded samples of the texts outside the test fold, one per language."""
    chars = F.char_length("text")
    place = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.greatest(chars - SLICE + 1, F.lit(1))) + 1
    rows = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    at_place = F.substring("text", place.cast("int"), F.lit(SLICE))
    first_letter = F.regexp_extract("text", rf"\p{{L}}[\s\S]{{0,{SLICE - 1}}}", 0)
    piece = rows.select("lang", F.xxhash64("doc_id", "text").alias("h"), F.when(at_place.rlike(r"\p{L}"), at_place).otherwise(first_letter).alias("piece"))
    piece = piece.withColumn("letters", F.char_length(F.regexp_replace("piece", r"\P{L}+", ""))).where("letters > 0")
    piece = piece.withColumn("level", F.char_length(F.bin(F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 1))))
    sums = piece.groupBy("lang", "level").agg(F.sum("letters").alias("letters")).orderBy("lang", "level").limit(64 * MAX_LANGUAGES).collect()
    upto: dict[str, int] = {}  # by language, the least level under which there are enough letters
    have: dict[str, int] = {}
    for r in sums:
        if have.get(r["lang"], 0) < LETTERS:
            have[r["lang"]] = have.get(r["lang"], 0) + r["letters"]
            upto[r["lang"]] = r["level"]
    if len(upto) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    levels = documents.sparkSession.createDataFrame(list(upto.items()), "lang string, top int")
    near = piece.join(F.broadcast(levels), "lang").where("level <= top")
    parts: dict[str, list[bytes]] = {}
    have = {}
    for r in near.select("lang", "piece", "letters").orderBy("lang", "h", "piece").collect():
        if have.get(r["lang"], 0) < LETTERS:
            have[r["lang"]] = have.get(r["lang"], 0) + r["letters"]
            data = np.frombuffer((r["piece"] + "\n").encode(), np.uint8)
            parts.setdefault(r["lang"], []).append(_folded(data, np.array([0, len(data)]))[0].tobytes())
    return Parser({lang: b"".join(p) for lang, p in parts.items()})


def predict_language(documents: DataFrame, parser: Parser) -> DataFrame:
    """doc_id of every row with lang_pred and score, the winner's share of 2 ** -bits."""

    def rows(batches):
        names = np.array([*parser.names, "und"], dtype=object)
        for batch in batches:
            for i, j, data, offs in pieces(batch["text"], 4 << 20):
                lettered = batch["lettered"][i:j].to_numpy(zero_copy_only=False).astype(bool)
                best, score = np.full(j - i, len(parser.names)), np.zeros(j - i)
                if parser.names:
                    cost = parser.costs(data, offs)
                    low = cost.min(1, keepdims=True)
                    best = np.where(lettered, cost.argmin(1), best)
                    score = np.where(lettered, 1.0 / np.exp2(np.maximum(low - cost, -1000)).sum(1), 0.0)
                yield pa.record_batch([batch["doc_id"][i:j], pa.array(names[best], pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return documents.select(F.col("doc_id").cast("long"), "text", lettered).mapInArrow(rows, "doc_id long, lang_pred string, score double")


@query("op7_language_id")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    found = predict_language(documents.select("doc_id", "text"), train(documents))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
