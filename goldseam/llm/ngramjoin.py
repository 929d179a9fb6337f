"""Exact Jaccard self-join on word n-grams, with groups of linked documents.

The work in outline: every text becomes a set of hashed n-grams, equal sets become one; index
lists hold, for the rarest n-grams of each set (its prefix), the sets that share them; lists are
cut into blocks by set size and position, and blocks that cannot hold a link are skipped. In each
block one set, the leader, is compared with the others first. From its computed overlaps follow
bounds for the overlaps of all sets that are highly similar to it, and only pairs that the bounds
leave open are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldseam.llm.common import ddl, map_frames, narrow, written
from goldseam.llm.memory import Kept, worker_state
from goldseam.llm.pieces import batches_of
from goldseam.llm.registry import query
from goldseam.llm.sketch import summed
from goldseam.workloads.registry import table

COUNTERS = 1 << 21
CELLS = 256
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams of a text.

    Words are runs of anything but ASCII white space, with A-Z in lower case. Fewer words than
    ``words`` count as one n-gram; no words give an empty set.
    """
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    known = worker_state("ngrams", Kept).table(set(found), lambda new: map(xxhash.xxh64_intdigest, new))
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    if len(found) < words:
        hashes, words = np.concatenate([hashes, np.full(words - len(found), len(found), np.uint64)]), words
    n = len(hashes) - words + 1
    total = np.full(n, len(found) if len(found) < words else words, np.uint64)
    for k in range(words):
        total = total * np.uint64(_MIX[0]) + hashes[k : k + n]
        total ^= total >> np.uint64(29)
    total = (total ^ (total >> np.uint64(30))) * np.uint64(_MIX[1])
    total = (total ^ (total >> np.uint64(27))) * np.uint64(_MIX[2])
    return np.unique(total ^ (total >> np.uint64(31)))


def _planes(counts: np.ndarray) -> bytes:
    """``CELLS`` counts, all lowest bytes first: the others are mostly zero and pack to nothing."""
    return counts.astype("<u4").view(np.uint8).reshape(CELLS, 4).T.tobytes()


def _counts(planes: pd.Series) -> np.ndarray:
    """A row of ``CELLS`` counts for each entry of ``_planes``."""
    parts = np.frombuffer(b"".join(planes), np.uint8).reshape(-1, 4, CELLS)
    return np.ascontiguousarray(parts.transpose(0, 2, 1)).view("<u4").reshape(-1, CELLS)


def set_id(hashes: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(hashes.tobytes())


def frequency_levels(docs: DataFrame, words: int) -> np.ndarray:
    """For each of ``COUNTERS`` buckets of hashes, how far its count stands out (0: not at all).

    Shared n-grams thereby come late in the global order, so index lists stay short. The levels
    decide about speed only: any order gives the same links.
    """

    def count(frames: Iterator[pd.DataFrame]) -> np.ndarray:
        total = np.zeros(COUNTERS)
        for frame in batches_of(frames, "_text", 1_000_000):
            found = [shingles(text, words) for text in frame["_text"]]
            if found:
                at = (np.concatenate(found) & np.uint64(COUNTERS - 1)).astype(np.int64)
                total += np.bincount(at, minlength=COUNTERS)
        return total

    counts = summed(docs, COUNTERS, count)
    usual = float(np.median(counts))
    over = np.maximum(0, counts - usual) // (math.sqrt(usual) + 1)
    return np.ceil(np.log2(over + 1)).astype(np.uint8)


class Threshold:
    """Jaccard similarity of at least ``num / den``, in whole numbers."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def prefix(self, n: int) -> int:
        """Two linked sets share an n-gram among their first so many."""
        return n - -(-n * self.num // self.den) + 1

    def linked(self, common: Column, a: Column, b: Column) -> Column:
        return self.den * common >= self.num * (a + b - common)

    def needed(self, a: Column, b: Column) -> Column:
        """The smallest overlap that links sets of these sizes."""
        return F.ceil((self.num * (a + b)) / F.lit(self.den + self.num))

    def sizes(self, a: Column, b: Column) -> Column:
        return self.den * F.least(a, b) >= self.num * F.greatest(a, b)

    def band(self, n: Column) -> Column:
        """Sets whose bands differ by more than one are never linked."""
        return F.floor(F.log(n.cast("double")) / F.lit(math.log(self.den / self.num))).cast("int")


def index(docs: DataFrame, words: int, limit: Threshold, keep: list[str]) -> DataFrame:
    """``keep``, ``_key`` (hash of the text), ``_n``, ``_digest`` of the set, ``_prefix`` and
    ``_cells`` of every text."""
    levels = docs.sparkSession.sparkContext.broadcast(frequency_levels(docs.select("_text"), words))

    def sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        level = levels.value
        for frame in batches_of(frames, "_text", 1_000_000):
            n, ids, prefixes, cells = [], [], [], []
            for text in frame["_text"]:
                found = shingles(text, words)
                n.append(len(found))
                ids.append(set_id(found) if len(found) else None)
                classes = (found >> np.uint64(56)).astype(np.int64)
                cells.append(_planes(np.bincount(classes, minlength=CELLS)))
                if len(found):
                    order = np.lexsort((found, level[(found & np.uint64(COUNTERS - 1)).astype(np.int64)]))
                    found = found[order[: limit.prefix(len(found))]]
                prefixes.append(found.view(np.int64))
            yield frame.drop(columns="_text").assign(_n=n, _digest=ids, _prefix=prefixes, _cells=cells)

    rows = docs.withColumn("_key", F.xxhash64("_text")).select(*keep, "_key", "_text")
    schema = ddl(rows, "_n long", "_digest binary", "_prefix array<long>", "_cells binary", without=("_text",))
    return written(map_frames(rows, sets, schema), "sets")


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of all nodes of links ``a, b``: every node takes its smallest neighbour, links
    are drawn anew between what was taken, until none is left. Nodes at least halve each time."""
    edges = narrow(links.select("a", "b").where("a <> b").distinct(), "edges")
    nodes = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        taken = narrow(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("to")), "taken")
        if nodes is None:
            nodes = taken.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            step = taken.select(F.col("a").alias("root"), "to")
            nodes = narrow(
                nodes.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "nodes"
            )
        left = taken.select("a", F.col("to").alias("x"))
        right = taken.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = edges.join(left, "a").join(right, "b").where("x <> y")
        edges = narrow(edges.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
    return nodes if nodes is not None else links.selectExpr("a AS node", "b AS root").where("false")


def _marks(keys: DataFrame) -> np.ndarray:
    """A bit table of hashed keys: 64 bits for each key, at most 16 MB whatever their number.

    Rows whose bit is not set are surely not among the keys; a crowded table only lets more rows
    through, which the later join drops.
    """
    bits = min(max(1 << 15, 1 << (64 * keys.count()).bit_length()), 1 << 27)
    place = F.pmod("_key", F.lit(bits)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    table = np.zeros(bits // 8, np.uint8)
    for part in parts.collect():
        at = (part["part"] - 1) * 4096
        table[at : at + 4096] = np.frombuffer(part["bits"], np.uint8)
    return table


def _bounded(sets: DataFrame, pairs: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs that the signatures allow to link: the overlap is at most the sum of the smaller counts
    in each of ``CELLS`` classes of hashes."""
    wanted = pairs.select(F.col("a").alias("_set")).union(pairs.select("b")).distinct()
    signs = narrow(sets.join(wanted, "_set", "left_semi").select("_set", F.col("_cells").alias("cells")), "cells")
    x = signs.select(F.col("_set").alias("a"), F.col("cells").alias("x"))
    y = signs.select(F.col("_set").alias("b"), F.col("cells").alias("y"))

    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x, y = _counts(frame["x"]), _counts(frame["y"])
            yield frame.drop(columns=["x", "y"]).assign(most=np.minimum(x, y).sum(axis=1, dtype=np.int64))

    both = pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "x", "y")
    rows = map_frames(both, bound, "a long, b long, na long, nb long, most long")
    return rows.where(F.col("most") >= limit.needed(F.col("na"), F.col("nb"))).drop("most")


def compare(docs: DataFrame, known: DataFrame, pairs: DataFrame, words: int, limit: Threshold) -> DataFrame:
    """``a, b, na, nb, common`` of pairs of sets; ``common`` is null where signatures rule a link
    out. The other sets are made anew, from one text each."""
    open_pairs = narrow(_bounded(known, pairs, limit), "open-pairs")
    wanted = open_pairs.select(F.col("a").alias("_set")).union(open_pairs.select("b")).distinct()
    chosen = narrow(known.join(wanted, "_set", "left_semi").select("_set", "_digest", "_key"), "chosen")
    marks = docs.sparkSession.sparkContext.broadcast(_marks(chosen))

    def make(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = marks.value
        for frame in batches_of(frames, "_text", 1_000_000):
            at = frame["_key"].to_numpy(np.int64) % (8 * len(table))
            frame = frame[(table[at // 8] >> (at % 8).astype(np.uint8)) & 1 == 1]
            found = [shingles(text, words) for text in frame["_text"]]
            yield pd.DataFrame({"_digest": [set_id(x) for x in found], "items": [x.tobytes() for x in found]})

    texts = docs.select(F.xxhash64("_text").alias("_key"), "_text")
    sets = map_frames(texts, make, "_digest binary, items binary").dropDuplicates(["_digest"])
    sets = written(sets.join(chosen.select("_digest", "_set"), "_digest").select("_set", "items"), "items")

    def overlap(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            common = [
                len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                for x, y in zip(frame["x"], frame["y"])
            ]
            yield frame.drop(columns=["x", "y"]).assign(common=common)

    x = sets.select(F.col("_set").alias("a"), F.col("items").alias("x"))
    y = sets.select(F.col("_set").alias("b"), F.col("items").alias("y"))
    both = open_pairs.join(x, "a").join(y, "b").select("a", "b", "na", "nb", "x", "y")
    counted = map_frames(both, overlap, "a long, b long, na long, nb long, common long")
    return pairs.join(counted.select("a", "b", "common"), ["a", "b"], "left")


def _pair(x: str, y: str) -> list[Column]:
    """Columns ``a, b, na, nb`` with the smaller set id first."""
    swap = F.col(f"{x}._set") > F.col(f"{y}._set")
    pick = lambda c, p, q: F.when(swap, F.col(f"{q}.{c}")).otherwise(F.col(f"{p}.{c}"))
    return [
        pick("_set", x, y).alias("a"), pick("_set", y, x).alias("b"),
        pick("_n", x, y).alias("na"), pick("_n", y, x).alias("nb"),
    ]


def _possible(limit: Threshold, x: str, y: str) -> Column:
    """Sizes and positions allow a link: what follows the shared n-gram in both suffices."""
    n, m = F.col(f"{x}._n"), F.col(f"{y}._n")
    rest = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    return limit.sizes(n, m) & (rest >= limit.needed(n, m))


def near_copies(
    docs: DataFrame,
    words: int = 5,
    num: int = 80,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    star_rounds: int = 12,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row, and ``_key, _root``.

    Two rows link when the Jaccard similarity of their sets of word n-grams is at least
    ``num / den``; a component is what links connect, named by its smallest id. N-grams are
    compared by 64-bit hashes, equal sets are found by 128-bit hashes.

    Only components are computed: sets that are in one component already are not compared, so
    the links within a component are neither listed nor counted.

    A null or empty text, or one without words, has an empty set and links with nothing; rows
    with equal texts link; rows that share an id are separate, and a null id names no component
    (it is null only where all ids are). An empty table gives no rows; other columns are ignored.
    """
    limit = Threshold(num, den)
    docs = docs.select(F.col(id_col).cast("long").alias("_pick"), F.col(text_col).alias("_text"))
    rows = index(docs, words, limit, ["_pick"])
    sets = rows.where("_n > 0").groupBy("_digest").agg(
        F.first("_n").alias("_n"), F.first("_prefix").alias("_prefix"), F.first("_cells").alias("_cells"),
        F.min("_key").alias("_key"), F.min("_pick").alias("first"),
    )
    # Written before use, so a set keeps its number; numbers are half as wide as digests and repeat bytes.
    sets = written(sets.withColumn("_set", F.monotonically_increasing_id()), "distinct")
    postings = sets.select("_set", "_n", F.posexplode("_prefix").alias("pos", "token"))
    # Counted where they are listed, as nearly all n-grams are unique: an aggregate would send them again.
    shared = postings.withColumn("_m", F.count("*").over(Window.partitionBy("token"))).where("_m > 1").drop("_m")
    blocked = shared.withColumn("band", limit.band(F.col("_n")))
    lists = written(blocked.withColumn("place", F.floor(F.lit(8) * F.col("pos") / F.col("_n"))), "lists")

    done = roots = None
    by_list = lists.groupBy("token").agg(F.count("*").alias("m"))
    before = by_list.agg(F.sum(F.expr("m * (m - 1) / 2"))).first()[0] or 0
    for turn in range(star_rounds + 1):
        grouped = lists.withColumn("root", F.col("_set"))
        if roots is not None:
            known = roots.select(F.col("node").alias("_set"), F.col("root").alias("known"))
            grouped = lists.join(known, "_set", "left").withColumn("root", F.coalesce("known", "_set")).drop("known")
            # Only lists that still hold sets of several components.
            by_root = grouped.groupBy("token", "root").count()
            by_root = by_root.groupBy("token").agg(F.count("*").alias("roots"), F.sum("count").alias("m"),
                                                   F.sum(F.col("count") * F.col("count")).alias("own"))
            open_lists = narrow(by_root.where("roots > 1").withColumn("open", F.expr("(m * m - own) / 2")), "open")
            size = open_lists.agg(F.sum("open").alias("pairs"), F.sum("m").alias("m")).first()
            grouped = written(grouped.join(open_lists.select("token"), "token"), "still")
            if not size["m"]:
                break
        # Leaders go on while they settle at least half of what was open.
        last = turn == star_rounds
        if turn and not last:
            last = size["pairs"] <= 32 * size["m"] or size["pairs"] > before / 2
            before = size["pairs"]
        if last:
            pairs = _open_pairs(grouped, limit)
        else:
            # An edited copy has n-grams of its own, which push the shared ones back: where a shared
            # n-gram stands first, the set is most like the others. Later rounds try others.
            rank = F.struct(F.col("pos") if turn == 0 else F.lit(0), F.xxhash64("_set", F.lit(turn)))
            leaders = grouped.groupBy("token", "band").agg(F.min(F.struct(rank, "_set", "_n", "pos", "root")).alias("l"))
            leaders = leaders.select("token", "band", "l._set", "l._n", "l.pos", "l.root")
            joined = grouped.alias("x").join(leaders.alias("y"), ["token", "band"])
            joined = joined.where(F.col("x.root") != F.col("y.root")).where(_possible(limit, "x", "y"))
            pairs = joined.select(*_pair("x", "y")).distinct()
        if done is not None:
            pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
            derived = narrow(_derived(pairs, done, limit), "derived")
            pairs = derived.where("common is null").drop("common")
            sure = derived.where("common is not null")
        fresh = compare(docs, sets, narrow(pairs, "pairs"), words, limit)
        done = narrow(fresh if done is None else fresh.unionByName(sure).unionByName(done), "compared")
        linked = limit.linked(F.col("common"), F.col("na"), F.col("nb"))
        roots = components(done.where(linked))
        if last:
            break

    known = roots.select(F.col("node").alias("_set"), "root")
    own = sets.join(known, "_set", "left").select("_digest", "first", F.coalesce("root", "_set").alias("_root"))
    own = written(own, "own")
    named = own.groupBy("_root").agg(F.min("first").alias("component_id"))
    named = written(own.join(named, "_root").select("_digest", "_root", "component_id"), "named")
    return rows.drop("_prefix", "_cells").join(named, "_digest", "left").select(
        F.col("_pick").alias("doc_id"),
        F.col("_n").alias("n_shingles"),
        F.when(F.col("_n") > 0, F.col("component_id")).otherwise(F.col("_pick")).alias("component_id"),
        "_key", "_root",
    )


def _open_pairs(lists: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs of different components in a list. Blocks of one size band and position are paired
    first; a pair of blocks whose best member could not reach the overlap is skipped whole."""
    key = ["token", "band", "place"]
    blocks = lists.groupBy(*key).agg(
        F.min("_n").alias("least"),
        F.max("_n").alias("most"),
        F.max(F.col("_n") - F.col("pos")).alias("rest"),
        F.min("root").alias("root"), F.max("root").alias("other"),
    )
    p, q = blocks.alias("p"), blocks.toDF(*blocks.columns).alias("q")
    first = F.struct("p.band", "p.place") <= F.struct("q.band", "q.place")
    near = F.abs(F.col("p.band") - F.col("q.band")) <= 1
    reach = F.least("p.rest", "q.rest") >= limit.needed(F.col("p.least"), F.col("q.least"))
    mixed = ~((F.col("p.root") == F.col("p.other")) & (F.col("q.root") == F.col("q.other")) & (F.col("p.root") == F.col("q.root")))
    pairs = p.join(q, (F.col("p.token") == F.col("q.token")) & first & near & reach & mixed).select(
        F.col("p.token").alias("token"), F.col("p.band").alias("band"), F.col("p.place").alias("place"),
        F.col("q.band").alias("band2"), F.col("q.place").alias("place2"),
    )
    x = lists.select(*key, F.struct("_set", "_n", "pos", "root").alias("x"))
    y = lists.select("token", F.col("band").alias("band2"), F.col("place").alias("place2"),
                     F.struct("_set", "_n", "pos", "root").alias("y"))
    joined = pairs.join(x, key).join(y, ["token", "band2", "place2"])
    joined = joined.where(F.col("x.root") != F.col("y.root")).where(_possible(limit, "x", "y"))
    return joined.select(*_pair("x", "y")).distinct()


def _derived(pairs: DataFrame, done: DataFrame, limit: Threshold) -> DataFrame:
    """Pairs with what follows from overlaps with a set that both were compared with.

    With ``i`` and ``j`` elements in common with such a leader of ``n`` elements, two sets have at
    least ``i + j - n`` and at most ``min(i, j) + min(rest, rest)`` in common. A pair whose most is
    too small is left out; one whose least links it gets that as ``common``; else it is null.
    """
    done = done.where("common is not null")
    sides = done.select("a", "b", "na", "nb", "common").union(done.select("b", "a", "nb", "na", "common"))
    best = sides.groupBy("a").agg(F.max(F.struct("common", "b", "nb")).alias("l")).select("a", "l")
    x = best.select("a", F.col("l").alias("x"))
    y = best.select(F.col("a").alias("b"), F.col("l").alias("y"))
    rows = pairs.join(x, "a", "left").join(y, "b", "left")
    same = F.coalesce(F.col("x.b") == F.col("y.b"), F.lit(False))
    i, j = F.col("x.common"), F.col("y.common")
    most = F.least(i, j) + F.least(F.col("na") - i, F.col("nb") - j)
    least = i + j - F.col("x.nb")
    needed = limit.needed(F.col("na"), F.col("nb"))
    rows = rows.where(~same | (most >= needed))
    common = F.when(same & (least >= needed), least).cast("long")
    return rows.select("a", "b", "na", "nb", common.alias("common"))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row with the smallest id
    (null last, then by a hash of the text) stays; rows without words all stay. Columns as they are.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    found = near_copies(docs, **options)
    nulls_last = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "_key")
    kept = found.where("n_shingles > 0").groupBy("_root").agg(F.min(nulls_last).alias("k"))
    kept = written(kept.select("k.doc_id", "k._key"), "kept")
    # The join and the removal of equal rows share these keys, so texts are shuffled once. Their names are
    # longer than any column's.
    own = "_" * (1 + max(map(len, docs.columns)))
    names = [f"{own}{x}" for x in ("no", "id", "key")]

    def keyed(rows: DataFrame, ids: Column, key: Column) -> DataFrame:
        return rows.withColumns(dict(zip(names, (ids.isNull(), F.coalesce(ids, F.lit(0)), key))))

    chosen = keyed(docs, F.col(f"`{id_col}`").cast("long"), F.xxhash64(f"`{text_col}`")).join(
        keyed(kept, F.col("doc_id"), F.col("_key")).select(*names), names, "left_semi"
    )
    chosen = chosen.dropDuplicates([*names, id_col, text_col]).select(*[F.col(f"`{c}`") for c in docs.columns])
    wordless = F.coalesce(F.translate(F.col(text_col), " \t\n\x0b\f\r", ""), F.lit("")) == ""
    return chosen.where(~wordless).unionByName(docs.where(wordless))


@query("op1_ngram_jaccard")
def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    found = near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")
