"""Best-fit packing of documents into sequences of several permitted lengths.

A document of n words (runs between whitespace; or any length column the caller gives) longer than
the largest length is cut into pieces of that length and a rest. Pieces are dealt by hash to shards
of about `SHARD_PIECES`, and each shard is packed on its own, longest piece first: into the open
sequence with the least room that still holds it, else into a new one. A new sequence gets the
length with the least cost per word that it can still hope to hold, given what is left to pack; in
the end every sequence shrinks to the shortest length that holds its contents.

Defined cases: null and empty texts have length 0 and one row with a null sequence; equal pieces go
by doc_id and piece; repeated rows are packed as often as they occur, dealt to shards copy by copy;
a null doc_id is packed like any other, a length below 0 is 0; no rows give no rows.
"""

from __future__ import annotations

import bisect

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.batches import SPACED, pieces, spans
from tillcast.llm.registry import query, table
from tillcast.sources.staging import staged

LENGTHS = (512, 1024, 2048, 4096, 8192)
SEQUENCE_COST = 32  # what a sequence costs besides its length
SHARD_PIECES = 8_000
COPIES = 10_000  # equal rows that one task numbers at a time


def word_counts() -> Column:
    """A UDF from text to its number of words."""

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        column = pa.Array.from_pandas(texts, type=pa.large_string())
        sizes = [np.diff(spans(data, offs, SPACED)[2]) for _, _, data, offs in pieces(column)]
        return pd.Series(np.concatenate(sizes) if sizes else np.zeros(0, np.int64))

    return count


def pack(sizes: np.ndarray, lengths=LENGTHS, sequence_cost: float = SEQUENCE_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset in it, its final length) of pieces that are sorted from long to short."""
    lengths = sorted(lengths)
    rest = np.concatenate([np.cumsum(sizes[::-1])[::-1], [0]])  # words of this and all later pieces
    rising = sizes[::-1]
    n = len(sizes)
    seq, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room_of: list[int] = []  # by sequence
    used: list[int] = []
    rooms: list[int] = []  # distinct rooms of open sequences, sorted
    open_at: dict[int, list[int]] = {}

    def hope(room: int, i: int) -> int:
        """Words that later pieces could still put into this room."""
        first = n - int(np.searchsorted(rising, room, "right"))
        return min(room, int(rest[max(first, i + 1)]))

    for i in range(n):
        size = int(sizes[i])
        k = bisect.bisect_left(rooms, size)
        if k < len(rooms):
            room = rooms[k]
            s = open_at[room].pop()
            if not open_at[room]:
                del open_at[room], rooms[k]
        else:
            fitting = [c for c in lengths if c >= size]
            room = min(fitting, key=lambda c: ((c + sequence_cost) / (size + hope(c - size, i)), c))
            s = len(used)
            room_of.append(room)
            used.append(0)
        seq[i], offset[i] = s, used[s]
        used[s] += size
        room -= size
        if room:
            if room not in open_at:
                bisect.insort(rooms, room)
                open_at[room] = []
            open_at[room].append(s)
    final = np.array(lengths)[np.searchsorted(lengths, used)] if used else np.zeros(0, np.int64)
    return seq, offset, final[seq] if n else final


def best_fit(
    documents: DataFrame, length: Column | None = None, lengths=LENGTHS, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """(doc_id, piece, start, n_tokens, sequence_id, offset, capacity), one row per piece."""
    top = max(lengths)
    size = word_counts()("text") if length is None else F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0))
    sized = documents.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n"), F.xxhash64("doc_id", "text").alias("h"))
    rows = staged(sized.groupBy("doc_id", "n", "h").agg(F.count("*").alias("copies")))
    last = F.floor(F.greatest(F.col("n") - 1, F.lit(0)) / top).cast("int")
    held = rows.agg(F.sum(F.col("copies") * (last + 1))).first()[0] or 0
    shards = max(1, -(-held // shard_pieces))

    # equal rows are numbered, so that their pieces are dealt to all shards; many of them by several tasks
    blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))))
    blocks = blocks.where("block = 0").unionByName(blocks.where("block > 0").repartition("h", "block"))
    numbers = F.sequence(F.col("block") * COPIES, F.least(F.col("copies"), (F.col("block") + 1) * COPIES) - 1)
    each = blocks.withColumn("copy", F.explode(numbers)).withColumn("piece", F.explode(F.sequence(F.lit(0), last)))
    start = F.col("piece").cast("long") * top
    cut = each.select(
        "doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(top)).cast("long").alias("n_tokens"),
        F.xxhash64("h", "copy", "piece").alias("h"),
    )

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("h", "ascending")])
        sizes = rows["n_tokens"].to_numpy()
        full = sizes > 0
        seq, offset, final = pack(sizes[full], lengths)
        out = rows.select(["doc_id", "piece", "start", "n_tokens"])
        for name, values in (("sequence_id", rows["shard"].to_numpy()[full] * (1 << 32) + seq), ("offset", offset), ("capacity", final)):
            cells = np.zeros(len(sizes), np.int64)
            cells[full] = values
            out = out.append_column(name, pa.array(cells, mask=~full))
        return out

    schema = "doc_id long, piece int, start long, n_tokens long, sequence_id long, offset long, capacity long"
    return cut.withColumn("shard", F.pmod("h", F.lit(shards))).groupBy("shard").applyInArrow(packed, schema)


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return best_fit(table(spark, sf, "documents").select("doc_id", "text"))
