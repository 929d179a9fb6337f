"""Token-id files: blocks of concatenated ids with Elias-Fano coded document boundaries."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldseam.llm.common import map_frames, narrow
from goldseam.llm.pieces import column_slices, tokenizer_encoder
from goldseam.llm.registry import query
from goldseam.session import new_path
from goldseam.workloads.registry import table

MAGIC = b"EFID"
HEAD = struct.Struct("<4sIQBxxx")  # magic, documents, ids, low bits
SAMPLE = 64
#: Bytes of known pieces in a worker, and of texts that are encoded at once.
KEPT_BYTES, SLICE_BYTES = 128 << 20, 8 << 20
BLOCKS = "part long, block long, first_id long, n_docs long, n_ids long, payload binary"
ROWS = "part long, doc_id long, start long, n_tokens long, ids binary"


class EliasFano:
    """A non-decreasing sequence in about ``2 + log2(last / n)`` bits a value.

    The low bits are packed; the high parts are a unary bit vector in which value ``i`` is the
    ``i``-th one. ``select`` starts from a sampled position of every ``SAMPLE``-th one.
    """

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        bits = np.unpackbits(np.frombuffer(high, np.uint8), bitorder="little")
        self.samples = np.flatnonzero(bits)[::SAMPLE]

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        last = int(values[-1]) if n else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        values = values.astype(np.uint64)
        shifts = np.arange(low_bits, dtype=np.uint64)
        low = ((values[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
        bits = np.zeros(n + (last >> low_bits) + 1, np.uint8)
        bits[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = 1
        pack = lambda x: np.packbits(x.ravel(), bitorder="little").tobytes()
        return cls(n, low_bits, pack(low), pack(bits))

    def _low(self, i: int) -> int:
        at = i * self.low_bits
        chunk = int.from_bytes(self.low[at // 8 : (at + self.low_bits + 7) // 8], "little")
        return (chunk >> (at % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value ``i``, reading only the stretch after the nearest sampled position."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        while left:
            at += 1
            left -= (self.high[at // 8] >> (at % 8)) & 1
        return ((at - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        bits = np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little")
        high = np.flatnonzero(bits)[: self.n] - np.arange(self.n)
        low = np.unpackbits(np.frombuffer(self.low, np.uint8), bitorder="little")
        low = low[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.int64)
        return (high << self.low_bits) | (low << np.arange(self.low_bits)).sum(axis=1)


def write_block(keys: list[int | None], ids: list[bytes]) -> bytes:
    """One block: head, coded ends of the documents, document ids, token ids."""
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
    coded = EliasFano.of(ends)
    known = np.packbits([k is not None for k in keys], bitorder="little").tobytes()
    numbers = np.array([k or 0 for k in keys], "<i8").tobytes()
    head = HEAD.pack(MAGIC, len(keys), int(ends[-1]) if len(ends) else 0, coded.low_bits)
    sizes = struct.pack("<II", len(coded.low), len(coded.high))
    return b"".join([head, sizes, coded.low, coded.high, known, numbers, *ids])


class Block:
    """A block read back: ``bounds(i)`` by select, ``ids(i)`` as little-endian bytes."""

    def __init__(self, payload: bytes):
        magic, n, self.n_ids, low_bits = HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        n_low, n_high = struct.unpack_from("<II", payload, HEAD.size)
        at = HEAD.size + 8
        self.ends = EliasFano(n, low_bits, payload[at : at + n_low], payload[at + n_low :][:n_high])
        at += n_low + n_high
        known = np.unpackbits(np.frombuffer(payload, np.uint8, (n + 7) // 8, at), bitorder="little")
        at += (n + 7) // 8
        numbers = np.frombuffer(payload, "<i8", n, at)
        self.keys = [int(k) if there else None for k, there in zip(numbers, known)]
        self.at, self.payload = at + 8 * n, payload

    def bounds(self, i: int) -> tuple[int, int]:
        return (self.ends.select(i - 1) if i else 0), self.ends.select(i)

    def ids(self, i: int) -> bytes:
        start, end = self.bounds(i)
        return self.payload[self.at + 4 * start : self.at + 4 * end]


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    block_ids: int = 1_000_000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Write the ids of all documents below ``path``, in ascending order of ``id_col``.

    Each task holds a range of document ids, in order, and cuts it into blocks of about
    ``block_ids`` ids (a longer document is a block of its own). Spark commits the files, so a
    repeated task leaves no second copy. Null ids come first; rows with equal ids lie next to
    each other in any order, and may be dealt to several tasks. A null or empty text is its end id. An empty table writes no block.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer_encoder(tokenizer, KEPT_BYTES)
        end = struct.pack("<I", end_id)
        part = TaskContext.get().partitionId()
        keys, ids, held, first, number = [], [], 0, 0, 0

        def flush():
            row = [part, number, first, len(keys), held, write_block(keys, ids)]
            kinds = [*[pa.int64()] * 5, pa.binary()]
            names = "part block first_id n_docs n_ids payload".split()
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds)], names=names)

        for numbers, texts in column_slices(batches, SLICE_BYTES):
            for key, x in zip(numbers.to_pylist(), encoder.encode_column(texts)):
                keys.append(key)
                ids.append(x + end)
                held += len(x) // 4 + 1
                if held >= block_ids:
                    yield flush()
                    keys, ids, held, first, number = [], [], 0, first + held, number + 1
        if keys:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    dealt = rows.repartitionByRange("_id").sortWithinPartitions("_id")
    dealt.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids``.

    A full scan decodes the boundaries of a block in order; select serves single look-ups.
    """

    def documents(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part, first, payload in zip(frame["part"], frame["first_id"], frame["payload"]):
                block = Block(payload)
                ends = block.ends.all()
                starts = np.concatenate([[0], ends[:-1]])
                cut = zip(starts.tolist(), ends.tolist())
                yield pd.DataFrame(
                    {
                        "part": part,
                        "doc_id": pd.array(block.keys, "Int64"),
                        "start": starts + first,
                        "n_tokens": ends - starts,
                        "ids": [payload[block.at + 4 * s : block.at + 4 * e] for s, e in cut],
                    }
                )

    blocks = spark.read.schema(BLOCKS).parquet(path)
    # One row per written range, so the running total is over a short list.
    before = F.sum("part_ids").over(Window.orderBy("part")) - F.col("part_ids")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    # Written first, so that Spark knows its size before it plans the join.
    bases = narrow(parts.select("part", before.alias("base")), "bases")
    rows = map_frames(blocks.select("part", "first_id", "payload"), documents, ROWS)
    return rows.join(bases, "part").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids"
    )


@query("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, written to files and read back."""
    import public_tokenizers

    path = new_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
