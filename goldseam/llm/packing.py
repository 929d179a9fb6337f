"""Packing of documents into sequences of one length with few padded places."""

from __future__ import annotations

import bisect
import struct
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from goldseam.llm.common import apply_frames, written
from goldseam.llm.pieces import PIECE_BYTES, column_slices, tokenizer_encoder
from goldseam.llm.registry import query
from goldseam.workloads.registry import table

PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, "
    "ids binary, open_group long"
)


#: Bytes of ids of pieces that a worker of the query keeps.
KEPT_BYTES = 96 << 20


class Windows:
    """At most ``most`` open windows of ``size`` places.

    ``place`` puts an item into the window with the smallest sufficient gap. When none fits and
    all windows are in use, the fullest one is closed first. Closed windows are returned.
    """

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.gaps: list[tuple[int, int]] = []
        self.items: dict[int, list] = {}
        self.made = 0

    def place(self, length: int, item) -> list[list]:
        closed = []
        at = bisect.bisect_left(self.gaps, (length, -1))
        if at < len(self.gaps):
            gap, key = self.gaps.pop(at)
        else:
            if len(self.gaps) >= self.most:
                closed.append(self.items.pop(self.gaps.pop(0)[1]))
            gap, key = self.size, self.made
            self.made += 1
            self.items[key] = []
        self.items[key].append((self.size - gap, item))
        if gap > length:
            bisect.insort(self.gaps, (gap - length, key))
        else:
            closed.append(self.items.pop(key))
        return closed

    def rest(self) -> list[list]:
        return [self.items[key] for _, key in self.gaps]


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    size: int = 1024,
    open_windows: int = 256,
    merged: int = 32,
    id_col: str = "doc_id",
    text_col: str = "text",
    kept_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """Pieces of all documents with their places in sequences of ``size`` ids.

    A document's ids (by the tokenizers file ``tokenizer``) get ``end_id`` at the end. Whole
    stretches of ``size`` ids are sequences of their own. What is left goes, while the task reads
    on, into one of ``open_windows`` open windows: the one that it fills best; when it fits none,
    the fullest is closed. The windows open at the end of a task are merged with those of
    ``merged`` neighbouring tasks, the fullest first. A worker keeps the ids of known pieces within
    ``kept_bytes``, which decides about speed only.

    Returns ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` (little-endian
    unsigned 32-bit). A null or empty text is one piece with the end id; null and repeated ids
    are kept, each row is packed by itself; an empty table gives no rows; other columns are
    ignored.
    """

    kinds = to_arrow_schema(StructType.fromDDL(PIECES))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_encoder(tokenizer, kept_bytes)
        end = struct.pack("<I", end_id)
        task = TaskContext.get().partitionId()
        group, sequence = task // merged, task << 36
        windows = Windows(size, open_windows)

        def rows(window: list, number: int, group: int | None):
            return [(*head, number, place, ids, group) for place, (head, ids) in window]

        def table_of(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kinds)], schema=kinds)

        for numbers, texts in column_slices(batches):
            out: list = []
            for key, ids in zip(numbers.to_pylist(), encoder.encode_column(texts)):
                ids += end
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start : 4 * (start + size)]
                    length = len(part) // 4
                    for window in windows.place(length, ((key, start, length, total), part)):
                        out += rows(window, sequence, None)
                        sequence += 1
            if out:
                yield table_of(out)
        out = []
        for window in windows.rest():
            out += rows(window, sequence, group)
            sequence += 1
        if out:
            yield table_of(out)

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        """Windows as items, the fullest first; a merged one keeps its first window's number."""
        used = frame.groupby("sequence_id")["length"].sum()
        order = used.sort_values(ascending=False, kind="stable")
        windows = Windows(size, len(order))
        done = [w for s, n in order.items() for w in windows.place(int(n), s)] + windows.rest()
        number = {s: window[0][1] for window in done for _, s in window}
        shift = {s: place for window in done for place, s in window}
        return frame.assign(
            offset=frame["offset"] + frame["sequence_id"].map(shift),
            sequence_id=frame["sequence_id"].map(number),
        )

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    first = written(texts.mapInArrow(local, PIECES), "packed")
    closed = first.where("open_group is null")
    groups = first.where("open_group is not null").groupBy("open_group")
    rest = apply_frames(groups, merge, PIECES)
    return closed.unionByName(rest).drop("open_group")


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    packed = pack(table(spark, sf_dir, "documents"), path, kept_bytes=KEPT_BYTES)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )
