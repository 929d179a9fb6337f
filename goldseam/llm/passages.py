"""Repeated word passages found by super-k-mers: every copy but that of the smallest id is cut out.

A window is ``size`` consecutive words; its minimiser is the least of its ``mark``-word stretches
in an order that puts frequent stretches last. Consecutive windows with one minimiser travel as one
packed string to the minimiser's bucket, so a word is sent about three times, not ``size`` times.
In its bucket, sorting brings equal windows together. Equal strings of a chunk of texts are packed
once, with their smallest and largest document id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import written
from goldseam.llm.registry import query
from goldseam.llm.sketch import summed
from goldseam.llm.words import hashed_words, mixed, text_slices
from goldseam.workloads.registry import table

COUNTERS = 1 << 20
#: Words of a chunk within which equal strings are packed once.
CHUNK_WORDS = 2_000_000
#: Groups of minimisers in a bucket; a task unpacks and sorts one group at a time.
GROUPS = 8
_FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_WINDOW = 0x2545F4914F6CDD1D


def _stretches(words: np.ndarray, mark: int) -> np.ndarray:
    """A number for the ``mark`` words from each place on."""
    n = len(words) - mark + 1
    total = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        for k in range(mark):
            total = total * np.uint64(_FACTORS[0]) + words[k : k + n]
    return mixed(total)


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    left = width - reach
    return np.minimum(values[: len(values) - left], values[left:]) if left else values


def _places(first: np.ndarray, size: int) -> np.ndarray:
    """All places at which a window starts that lies inside one text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    before = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(first[:-1] - before, counts)


def _identities(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit numbers for each stretch of words, the same wherever the stretch stands."""
    spread = mixed(words)
    out = []
    for factor in _FACTORS:
        powers = np.full(len(words) + 1, factor, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        sums = np.concatenate([[np.uint64(0)], np.cumsum(spread * powers[:-1], dtype=np.uint64)])
        inverse = np.full(len(words) + 1, pow(factor, -1, 2**64), np.uint64)
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        total = (sums[starts + lengths] - sums[starts]) * inverse[starts]
        out.append(mixed(total + mixed(lengths.astype(np.uint64))))
    return out[0], out[1]


@dataclass
class Strings:
    """Super-k-mers of a slice of texts."""

    starts: np.ndarray
    lengths: np.ndarray
    keys: np.ndarray  # minimisers
    high: np.ndarray
    low: np.ndarray


def super_kmers(words: np.ndarray, first: np.ndarray, size: int, mark: int, levels: np.ndarray) -> Strings:
    """Runs of consecutive windows with one minimiser, as stretches of words."""
    places = _places(first, size)
    if not len(places):
        none = np.zeros(0, np.int64)
        return Strings(none, none, none.view(np.uint64), none.view(np.uint64), none.view(np.uint64))
    marks = _stretches(words, mark)
    level = levels[(marks & np.uint64(len(levels) - 1)).astype(np.int64)].astype(np.uint64)
    order = (level << np.uint64(58)) | (marks >> np.uint64(6))
    least = _least_of(order, size - mark + 1)[places]
    new = np.ones(len(places), bool)
    new[1:] = (np.diff(places) != 1) | (least[1:] != least[:-1])
    at = np.flatnonzero(new)
    starts = places[at]
    lengths = np.diff(at, append=len(places)) + size - 1
    high, low = _identities(words, starts, lengths)
    return Strings(starts, lengths, least[at], high, low)


def _grouped(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts by the keys (the last counts most) and where each group begins in it."""
    order = np.lexsort(keys)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        ranked = key[order]
        new[1:] |= ranked[1:] != ranked[:-1]
    return order, np.flatnonzero(new)


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of all words of the stretches, one stretch after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


def _packed(groups: np.ndarray, lengths: np.ndarray, least: np.ndarray, most: np.ndarray, words: np.ndarray) -> bytes:
    """Strings ordered by group in one row: their words once, the most frequent first, then numbers
    of words. ``groups`` is the number of strings in each group."""
    import zstandard

    used, at, counts = np.unique(words, return_inverse=True, return_counts=True)
    by = np.argsort(-counts, kind="stable")
    rank = np.empty(len(used), "<u4")
    rank[by] = np.arange(len(used), dtype="<u4")
    wide = "<u2" if len(used) <= 1 << 16 else "<u4"
    head = np.array([len(lengths), len(used), len(words)], "<u4")
    parts = [head, groups.astype("<u4"), lengths.astype("<u4")]
    parts += [np.diff(least, prepend=0).astype("<i8"), (most - least).astype("<i8"), used[by].astype("<u8")]
    # Bytes of one weight together: the upper ones are nearly all zero.
    numbers = rank[at].astype(wide).view(np.uint8).reshape(len(at), -1).T
    data = b"".join(p.tobytes() for p in parts) + np.ascontiguousarray(numbers).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(data)


class Packed:
    """A packed row read back; ``group(i)`` gives lengths, smallest and largest ids and words."""

    def __init__(self, blob: bytes):
        import zstandard

        data = zstandard.ZstdDecompressor().decompress(blob)
        n, n_used, n_words = np.frombuffer(data, "<u4", 3).tolist()
        groups = np.frombuffer(data, "<u4", GROUPS, 12).astype(np.int64)
        at = 12 + 4 * GROUPS
        self.lengths = np.frombuffer(data, "<u4", n, at).astype(np.int64)
        self.least = np.cumsum(np.frombuffer(data, "<i8", n, at + 4 * n))
        self.most = self.least + np.frombuffer(data, "<i8", n, at + 12 * n)
        at += 20 * n
        self.used = np.frombuffer(data, "<u8", n_used, at)
        at += 8 * n_used
        wide = 2 if n_used <= 1 << 16 else 4
        self.planes = np.frombuffer(data, np.uint8, wide * n_words, at).reshape(wide, n_words)
        self.cuts = np.concatenate([[0], np.cumsum(groups)])
        self.word_cuts = np.concatenate([[0], np.cumsum(self.lengths)])[self.cuts]

    def group(self, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        lo, hi = self.cuts[i], self.cuts[i + 1]
        planes = self.planes[:, self.word_cuts[i] : self.word_cuts[i + 1]]
        numbers = np.ascontiguousarray(planes.T).view(f"<u{len(planes)}").ravel()
        return self.lengths[lo:hi], self.least[lo:hi], self.most[lo:hi], self.used[numbers]


def _bucket_rows(chunk: list[tuple[np.ndarray, Strings, np.ndarray]], buckets: int) -> pa.RecordBatch:
    """Of a chunk of slices (words, strings, document ids of the strings) one packed row per bucket."""
    sizes = np.cumsum([0] + [len(words) for words, _, _ in chunk])
    words = np.concatenate([words for words, _, _ in chunk])
    join = lambda name: np.concatenate([getattr(s, name) for _, s, _ in chunk])
    starts = np.concatenate([s.starts + at for (_, s, _), at in zip(chunk, sizes)])
    lengths, keys, high, low = join("lengths"), join("keys"), join("high"), join("low")
    ids = np.concatenate([i for _, _, i in chunk])
    order, heads = _grouped(low, high)
    least, most = (f.reduceat(ids[order], heads) for f in (np.minimum, np.maximum))
    one = order[heads]
    dealt = mixed(keys[one]) % np.uint64(buckets * GROUPS)
    bucket, group = (dealt // np.uint64(GROUPS)).astype(np.int64), (dealt % np.uint64(GROUPS)).astype(np.int64)
    by = np.lexsort((least, group, bucket))
    one, least, most, bucket, group = one[by], least[by], most[by], bucket[by], group[by]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    blobs = []
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(bucket)]):
        rows = one[lo:hi]
        at = _gather(starts[rows], lengths[rows])
        groups = np.bincount(group[lo:hi], minlength=GROUPS)
        blobs.append(_packed(groups, lengths[rows], least[lo:hi], most[lo:hi], words[at]))
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[cuts], pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "strings"]
    )


def _first_places(words: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of windows in which equal ones are neighbours, and where each kind begins: sorted by
    a number, then compared word by word; sorted by all words should two kinds share a number."""
    total = np.zeros(len(places), np.uint64)
    for k in range(size):
        total = total * np.uint64(_WINDOW) + mixed(words[places + k])
    order, heads = _grouped(total)
    kind = np.repeat(heads, np.diff(heads, append=len(order)))
    here, there = places[order], places[order[kind]]
    several = np.flatnonzero(here != there)
    here, there = here[several], there[several]
    if all((words[here + k] == words[there + k]).all() for k in range(size)):
        return order, heads
    return _grouped(*[words[places + k] for k in range(size)])


def repeats_of(rows: list[Packed], group: int, size: int) -> dict[str, np.ndarray]:
    """From a group of a bucket's strings the stretches of windows that a smaller document has too.

    For each string (``high, low``) that stands in a document larger than the smallest one with
    one of its windows: the windows ``from_window`` to ``to_window`` and that smallest id,
    ``least``.
    """
    parts = [row.group(group) for row in rows]
    lengths, least, most, words = (np.concatenate([p[i] for p in parts]) for i in range(4))
    starts = np.cumsum(lengths) - lengths
    high, low = _identities(words, starts, lengths)
    order, heads = _grouped(low, high)
    one = order[heads]
    least, most = np.minimum.reduceat(least[order], heads), np.maximum.reduceat(most[order], heads)
    starts, lengths, high, low = starts[one], lengths[one], high[one], low[one]
    n = lengths - size + 1
    places = _gather(starts, n)
    owner = np.repeat(np.arange(len(n)), n)
    order, heads = _first_places(words, places, size)
    smallest = np.empty(len(places), np.int64)
    smallest[order] = np.repeat(
        np.minimum.reduceat(least[owner[order]], heads), np.diff(heads, append=len(order))
    )
    at = np.flatnonzero(smallest < most[owner])
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(owner[at]) != 0) | (np.diff(smallest[at]) != 0)
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(at)) - 1 if len(at) else begin
    own = owner[at[begin]]
    return {
        "high": high[own].view(np.int64),
        "low": low[own].view(np.int64),
        "from_window": places[at[begin]] - starts[own],
        "to_window": places[at[end]] - starts[own],
        "least": smallest[at[begin]],
    }


def frequency_levels(texts: DataFrame, mark: int) -> np.ndarray:
    """For each of ``COUNTERS`` hash buckets of word stretches, by how many powers of two it exceeds
    the usual count: 0 to 63. Frequent stretches thereby come last as minimisers, so a bucket grows
    large only by windows that are frequent as a whole, and those are packed once per chunk."""

    def count(frames: Iterator[pd.DataFrame]) -> np.ndarray:
        total = np.zeros(COUNTERS)
        for frame in frames:
            column = pa.array(frame["text"], pa.large_string(), from_pandas=True)
            for lo, hi in text_slices(column):
                words, first = hashed_words(column.slice(lo, hi - lo))
                marks = _stretches(words, mark)
                inside = _places(first, mark)
                at = (marks[inside] & np.uint64(COUNTERS - 1)).astype(np.int64)
                total += np.bincount(at, minlength=COUNTERS)
        return total

    counts = summed(texts.select("text"), COUNTERS, count)
    usual = max(1.0, float(np.median(counts)))
    return np.clip(np.ceil(np.log2(np.maximum(counts, 1) / usual)), 0, 63).astype(np.uint8)


def _marks(found: DataFrame) -> np.ndarray:
    """A bit table of the strings found, 4 MB at most: a clear bit says that a string is not among
    them. A crowded table only lets more strings through, which the later join drops."""
    bits = min(max(1 << 15, 1 << (32 * found.count()).bit_length()), 1 << 25)
    place = F.pmod("high", F.lit(bits)) + 1
    parts = found.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(bits // 8, np.uint8)
    for part in parts.collect():
        at = (part["part"] - 1) * 4096
        out[at : at + 4096] = np.frombuffer(part["bits"], np.uint8)
    return out


def repeated_stretches(
    docs: DataFrame, size: int = 13, mark: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, text_hash, from_word, to_word``: stretches of words of a document that lie in windows
    which also start in a document with a smaller id.

    Windows are judged on the whole input. A null id is smaller or larger than none, so its row
    neither loses nor takes windows; rows that repeat an id are the same document and take nothing
    from each other.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL")
    levels = spark.sparkContext.broadcast(frequency_levels(rows, mark))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def strings(batches: Iterator[pa.RecordBatch], ids: int, text: int):
        for batch in batches:
            numbers = batch.column(ids).to_numpy(zero_copy_only=False)
            column = batch.column(text)
            for lo, hi in text_slices(column):
                words, first = hashed_words(column.slice(lo, hi - lo))
                found = super_kmers(words, first, size, mark, levels.value)
                owner = np.searchsorted(first, found.starts, "right") - 1
                yield batch, lo, words, first, found, owner, numbers[lo:hi][owner]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held = [], 0
        for _, _, words, _, found, _, ids in strings(batches, 0, 1):
            if len(found.starts):
                chunk.append((words, found, ids))
                held += len(words)
            if held >= CHUNK_WORDS:
                yield _bucket_rows(chunk, partitions)
                chunk, held = [], 0
        if chunk:
            yield _bucket_rows(chunk, partitions)

    names = ["high", "low", "from_window", "to_window", "least"]

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [Packed(blob.as_py()) for batch in batches for blob in batch.column(0)]
        for group in range(GROUPS if rows else 0):
            found = repeats_of(rows, group, size)
            yield pa.RecordBatch.from_arrays([pa.array(found[c], pa.int64()) for c in names], names=names)

    packed = rows.mapInArrow(send, "bucket int, strings binary")
    dealt = packed.repartitionById(partitions, F.col("bucket")).select("strings")
    found = written(dealt.mapInArrow(receive, ", ".join(f"{c} long" for c in names)), "repeats")
    bits = spark.sparkContext.broadcast(_marks(found))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bits.value
        most = np.int64(8 * len(marks) - 1)
        for batch, lo, _, first, strings_, owner, ids in strings(batches, 0, 2):
            place = strings_.high.view(np.int64) & most
            on = np.flatnonzero(marks[place >> 3] >> (place & 7).astype(np.uint8) & 1)
            hashes = batch.column(1).to_numpy(zero_copy_only=False)[lo:][owner[on]]
            columns = [strings_.high[on], strings_.low[on], ids[on], hashes]
            columns.append(strings_.starts[on] - first[owner[on]])
            arrays = [pa.array(c.view(np.int64), pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["high", "low", "id", "text_hash", "start"])

    keyed = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
    seen = keyed.mapInArrow(occurrences, "high long, low long, id long, text_hash long, start long")
    return (
        seen.join(found, ["high", "low"])
        .where("least < id")
        .select(
            "id",
            "text_hash",
            (F.col("start") + F.col("from_window")).cast("int").alias("from_word"),
            (F.col("start") + F.col("to_window") + size - 1).cast("int").alias("to_word"),
        )
    )


def remove_repeats(
    docs: DataFrame, size: int = 13, mark: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every document without the words that lie in a window
    of ``size`` words which also starts in a document with a smaller id.

    The words kept are joined by one space. Null and empty texts and texts of fewer than ``size``
    words lose nothing. Null ids and rows that repeat an id are as in ``repeated_stretches``;
    every row comes back; an empty table gives no rows; other columns are ignored, whatever their
    names. Texts are taken whole, whatever their length.
    """
    stretches = repeated_stretches(docs, size, mark, id_col, text_col)
    cuts = stretches.groupBy("id", "text_hash").agg(F.collect_list(F.struct("from_word", "to_word")).alias("cuts"))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(
        F.col(id_col).alias("own_id"), F.col(id_col).cast("long").alias("id"),
        F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"),
    )
    cuts = cuts.select("id", "text_hash", F.col("cuts.from_word").alias("begin"), F.col("cuts.to_word").alias("end"))
    joined = rows.join(cuts, ["id", "text_hash"], "left").select("own_id", "text", "begin", "end")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in text_slices(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                n_words, n_removed, kept = [], [], []
                for text, begin, end in zip(part.column(1), part.column(2), part.column(3)):
                    words = (text.as_py() or "").encode("utf-8").split()
                    n = len(words)
                    if begin.is_valid:
                        depth = np.zeros(n + 1, np.int64)
                        np.add.at(depth, begin.values.to_numpy(), 1)
                        np.add.at(depth, end.values.to_numpy() + 1, -1)
                        stays = np.cumsum(depth[:-1]) == 0
                        words = list(compress(words, stays.tolist()))
                    n_words.append(n)
                    n_removed.append(n - len(words))
                    kept.append(b" ".join(words).decode("utf-8"))
                columns = [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"]
                )

    return joined.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept string")


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13
), g AS (
  SELECT r, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS w FROM s
), m AS (
  SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY w) AS least FROM g
), c AS (
  SELECT r, list_distinct(flatten(list(range(i, i + 13)))) AS gone FROM m WHERE doc_id > least GROUP BY r
), e AS (SELECT r, unnest(gone) AS i FROM c),
t AS (SELECT r, doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM d),
k AS (
  SELECT t.r, count(e.i) AS n_removed, string_agg(x, ' ' ORDER BY t.i) FILTER (WHERE e.i IS NULL) AS kept
  FROM t LEFT JOIN e ON t.r = e.r AND t.i = e.i GROUP BY t.r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)"""


@query("op13_substring_dedup", SQL)
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without passages that a smaller document has."""
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
