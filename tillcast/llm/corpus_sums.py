"""Sums over all rows of a corpus into one array of fixed size, such as hashed counts.

Each task adds into its own array and hands it on in chunks; chunks of the same place are added as
they stream in, so no task holds more than one chunk of each place, however many tasks there were.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK = 1 << 14


def corpus_sum(df: DataFrame, size: int, add: Callable[[np.ndarray, pa.RecordBatch], None]) -> np.ndarray:
    """The sum of what `add(total, batch)` adds to an int64 array of `size` entries, over all batches."""

    def by_task(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            add(total, batch)
        for k, at in enumerate(range(0, size, CHUNK)):
            part = total[at : at + CHUNK]
            if part.any():
                narrow = np.int32 if np.abs(part).max() < 2**31 else np.int64
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([part.astype(narrow).tobytes()], pa.binary()), pa.array([narrow().itemsize], pa.int32())], names=["chunk", "part", "width"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, total = None, None
        for batch in batches:
            for k, part, width in zip(batch["chunk"].to_pylist(), batch["part"], batch["width"].to_pylist()):
                values = np.frombuffer(part.as_buffer(), np.int32 if width == 4 else np.int64)
                chunk, total = k, values.astype(np.int64) if total is None else total + values
        yield pa.record_batch([pa.array([chunk], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["chunk", "part"])

    added.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    parts = df.mapInArrow(by_task, "chunk int, part binary, width int")
    out = np.zeros(size, np.int64)
    for row in parts.groupBy("chunk").applyInArrow(added, "chunk int, part binary").collect():
        at = row["chunk"] * CHUNK
        out[at : at + CHUNK] = np.frombuffer(row["part"], np.int64)
    return out
