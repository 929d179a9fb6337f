"""Counts of hashed items in a table of fixed size, summed over all tasks."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

SLICES = 64
_SLICE = "slice int, tasks int, counts binary"


def _packed(part: np.ndarray) -> bytes:
    """Numbers as 4-byte integers where that loses nothing, compressed."""
    small = part.astype("<u4") if part.size and 0 <= part.min() and part.max() < 2**32 else None
    if small is not None and (small == part).all():
        return b"u" + zlib.compress(small.tobytes(), 1)
    return b"d" + zlib.compress(part.astype("<f8").tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data[1:]), "<u4" if data[:1] == b"u" else "<f8").astype(float)


def summed(
    df: DataFrame, size: int, count: Callable[[Iterator[pd.DataFrame]], np.ndarray]
) -> np.ndarray:
    """The sum over all tasks of an array of ``size`` numbers that ``count`` makes of a task's frames.

    Arrays travel in slices and are added up in two rounds, so no task gets more than about a
    thousand parts of one slice; the driver gets ``size`` numbers, whatever the input.
    """

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = np.array_split(count(frames), SLICES)
        yield pd.DataFrame(
            {
                "slice": np.arange(SLICES, dtype="int32"),
                "tasks": np.int32(TaskContext.get().partitionId() // 1000),
                "counts": [_packed(p) for p in parts],
            }
        )

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(_unpacked(c) for c in frame["counts"])
        return frame.iloc[:1].assign(tasks=np.int32(0), counts=[_packed(total)])

    rows = df.mapInPandas(local, _SLICE).groupBy("slice", "tasks").applyInPandas(add, _SLICE)
    rows = rows.groupBy("slice").applyInPandas(add, _SLICE).collect()
    got = {row["slice"]: _unpacked(row["counts"]) for row in rows}
    if not got:
        return np.zeros(size)
    return np.concatenate([got[i] for i in range(SLICES)])
