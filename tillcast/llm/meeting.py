"""Brings the texts of document pairs together for verification."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.batches import mix, sliced
from tillcast.llm.corpus_sums import corpus_sum

MARKS = 1 << 21
MEETING = 200  # members that are verified against one text at one place


def id_marks(ids) -> np.ndarray:
    """Places of ids in the table of wanted documents."""
    return (mix(np.asarray(ids, np.int64).view(np.uint64)) % np.uint64(MARKS)).astype(np.int64)


def wanted_marks(docs: DataFrame) -> np.ndarray:
    """A table of fixed size that is true wherever an id of `docs` falls."""

    def add(total, batch):
        total[id_marks(batch[0].to_numpy(zero_copy_only=False))] = 1

    return corpus_sum(docs, MARKS, add) > 0


def packed(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc, z): texts as they travel, compressed; all that `wanted` names, and some more."""
    marks = documents.sparkSession.sparkContext.broadcast(np.packbits(wanted_marks(wanted)))

    def rows(batches):
        known = np.unpackbits(marks.value, count=MARKS).astype(bool)
        for batch in sliced(batches):
            batch = batch.filter(pa.array(known[id_marks(batch["doc_id"].to_numpy(zero_copy_only=False))]))
            z = [zlib.compress(t.as_buffer() if t.is_valid else b"", 1) for t in batch["text"].cast(pa.large_binary())]
            yield pa.record_batch([batch["doc_id"], pa.array(z, pa.binary())], names=["doc", "z"])

    return documents.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(rows, "doc long, z binary")


def unpacked(column: pa.Array) -> pa.Array:
    return pa.array([zlib.decompress(z.as_buffer()) for z in column], pa.large_binary()).cast(pa.large_string())


def meet(documents: DataFrame, pairs: DataFrame, payload: Callable[[pa.Array], list[bytes]] | None = None) -> DataFrame:
    """(b, place, member, doc, s): for each pair (a, b), a's payload after that of b, in one partition.

    At most about `MEETING` members come to one place; a b with more has several, each with its
    payload. The payload is the compressed text if no function makes another of the texts.
    """
    load = pairs.groupBy("b").agg(F.ceil(F.count("*") / MEETING).cast("int").alias("places"))
    at = F.pmod(F.xxhash64("a"), F.col("places")).cast("int")
    members = pairs.join(load, "b").select(F.col("a").alias("doc"), "b", at.alias("place"), F.lit(True).alias("member"))
    hubs = load.select(F.col("b").alias("doc"), "b", F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"), F.lit(False).alias("member"))
    ends = pairs.select("a").union(pairs.select("b"))
    met = packed(documents, ends).join(members.union(hubs).hint("merge"), "doc")

    def made(batches):
        for batch in sliced(batches):
            cols = [batch[c] for c in ("b", "place", "member", "doc")]
            yield pa.record_batch([*cols, pa.array(payload(unpacked(batch["z"])), pa.binary())], names=["b", "place", "member", "doc", "s"])

    schema = "b long, place int, member boolean, doc long, s binary"
    met = met.mapInArrow(made, schema) if payload else met.select("b", "place", "member", "doc", F.col("z").alias("s"))
    return met.repartition("b", "place").sortWithinPartitions("b", "place", "member")


def met_pairs(batches, load: Callable) -> Iterator[tuple[int, object, int, list]]:
    """(a, what `load` makes of a's payload, b, the same of all rows of b) in the order of `meet`."""
    key, known = None, []
    for batch in sliced(batches):
        for b, place, member, doc, s in zip(*(batch[c].to_pylist() for c in ("b", "place", "member", "doc")), batch["s"]):
            if key != (b, place):
                key, known = (b, place), []
            if member:
                yield doc, load(s), b, known
            else:
                known.append(load(s))
