"""Exact top-k inner products by KD-trees over shards of vectors."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldseam.llm.common import written
from goldseam.llm.registry import query
from goldseam.workloads.registry import table

FOUND = "query_id long, asked long, vec_id long, score long"


class Tree:
    """A KD-tree: median splits of the widest dimension, a tight box around every node.

    A node is ``(low corner, high corner, smallest id, start, end, children)``; leaves hold at
    most ``leaf`` rows. Sums of products are exact: in doubles while they stay below 2**53, else
    in 64-bit integers.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 256):
        self.order = np.arange(len(ids))
        self.ids, self.vectors, self.leaf = ids, vectors, leaf
        self.low, self.high, self.least, self.spans, self.children = [], [], [], [], []
        self._grow(0, len(ids))
        self.ids, self.vectors = ids[self.order], vectors[self.order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, start: int, end: int) -> int:
        part = self.vectors[self.order[start:end]]
        node, low, high = len(self.low), part.min(axis=0), part.max(axis=0)
        self.low.append(low)
        self.high.append(high)
        self.least.append(int(self.ids[self.order[start:end]].min()))
        self.spans.append((start, end))
        self.children.append(())
        if end - start > self.leaf and (high > low).any():
            middle = (end - start) // 2
            split = np.argpartition(part[:, np.argmax(high - low)], middle)
            self.order[start:end] = self.order[start:end][split]
            self.children[node] = (self._grow(start, start + middle), self._grow(start + middle, end))
        return node

    def search(self, own: int, q: np.ndarray, bounds: np.ndarray, k: int, known: tuple | None) -> list:
        """The best ``k`` of ``(score, -id)`` without the query's own id, best first.

        ``known`` is a k-th best found elsewhere: nothing that ranks behind it is needed. Nodes
        are visited by the largest product that their box allows, and the search ends at the
        first that cannot beat the k-th best so far.
        """
        best: list[tuple[int, int]] = []
        queue = [(-bounds[0], self.least[0], 0)]
        while queue:
            bound, least, node = heapq.heappop(queue)
            limit = best[0] if len(best) == k else None
            if known is not None and (limit is None or known > limit):
                limit = known
            if limit is not None and (-bound, -least) < limit:
                if -bound < limit[0]:
                    break
                continue
            if self.children[node]:
                for child in self.children[node]:
                    heapq.heappush(queue, (-bounds[child], self.least[child], child))
                continue
            start, end = self.spans[node]
            scores = self.vectors[start:end] @ q
            ids = self.ids[start:end]
            fit = ids != own
            if limit is not None:
                fit &= scores >= limit[0]
            at = np.flatnonzero(fit)
            if len(at) > 2 * k:  # ties at the edge are kept, the smaller ids win below
                edge = np.partition(scores[at], len(at) - k)[len(at) - k]
                at = at[scores[at] >= edge]
                at = at[np.lexsort((ids[at], -scores[at]))[:k]]
            for s, i in zip(scores[at].tolist(), ids[at].tolist()):
                entry = (int(s), -i)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return sorted(best, reverse=True)


def _search(candidates: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best ``k`` candidates of every query, for one shard and one block of queries."""
    if not len(candidates) or not len(queries):
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "asked", "vec_id", "score")})
    vectors, wanted = (np.array(x["vector"].tolist(), np.int64) for x in (candidates, queries))
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(wanted).max(initial=0)) * vectors.shape[1]
    if most < 2**53:
        vectors, wanted = vectors.astype(float), wanted.astype(float)
    tree = Tree(candidates["vec_id"].to_numpy(), vectors)
    up, down = np.maximum(wanted, 0), np.minimum(wanted, 0)
    out = []
    seen = zip(queries["kth_score"], queries["kth_id"])
    known = [None if pd.isna(s) else (int(s), -int(i)) for s, i in seen]
    for at in range(0, len(wanted), 256):
        cut = slice(at, at + 256)
        bounds = up[cut] @ tree.high.T + down[cut] @ tree.low.T
        names = zip(queries["vec_id"].iloc[cut], queries["asked"].iloc[cut])
        for (own, number), q, b, limit in zip(names, wanted[cut], bounds, known[cut]):
            out += [(own, number, -i, s) for s, i in tree.search(int(own), q, b.tolist(), k, limit)]
    return pd.DataFrame(out, columns=["query_id", "asked", "vec_id", "score"])


def top_inner_products(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    shard_rows: int = 8192,
    block_rows: int = 4096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest inner products.

    Components become ``floor(scale * x)``. Vectors are dealt into shards of about ``shard_rows``
    by a hash, the queries (rows that ``is_query`` holds for) into blocks of ``block_rows``. First
    every block searches one shard, then all others with the k-th best from there as a bound; a
    task holds one shard and one block. Each shard gives at most ``k`` rows per query, which are
    ranked in the end.

    Vectors that are null, or hold a null or non-finite component, take no part, nor do rows with
    a null id. Vectors of another length than the query's are compared by no definition and raise
    an error. Equal scores go to the smaller id; candidate rows that repeat an id count as rows, and
    a query's own id is no candidate. Equal query rows are one query; an id with several vectors is
    one query for each of them, with a list of its own, so its ranks repeat. Fewer candidates than ``k`` give fewer rows; an empty table
    none; other columns are ignored.
    """
    x = F.col(vector_col)
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    good = F.col(id_col).isNotNull() & x.isNotNull() & F.forall(x, finite)
    whole = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    rows = vectors.where(good).select(F.col(id_col).cast("long").alias("vec_id"), whole.alias("vector"))
    rows = written(rows, "vectors")
    n = rows.count()
    # The hash tells the vectors of one id apart, and equal rows are asked once.
    asked = rows.where(is_query).withColumn("asked", F.xxhash64("vector")).dropDuplicates(["vec_id", "asked"])
    shards, blocks = max(1, math.ceil(n / shard_rows)), max(1, math.ceil(asked.count() / block_rows))
    deal = lambda parts: F.pmod(F.xxhash64("vec_id", F.lit(parts)), F.lit(parts)).cast("int")
    dealt = rows.withColumn("shard", deal(shards))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    first_shard = F.pmod("block", F.lit(shards))

    def run(candidates: DataFrame, queries: DataFrame) -> DataFrame:
        left = candidates.toDF(*candidates.columns).groupBy("shard", "block")
        right = queries.toDF(*queries.columns).groupBy("shard", "block")
        return left.cogroup(right).applyInPandas(lambda c, q: _search(c, q, k), FOUND)

    def best(found: DataFrame, upto: int) -> DataFrame:
        place = F.row_number().over(
            Window.partitionBy("query_id", "asked").orderBy(F.desc("score"), "vec_id")
        )
        return found.withColumn("rank", place).where(F.col("rank") <= upto)

    numbers = F.sequence(F.lit(0), F.lit(blocks - 1))
    spread = dealt.withColumn("block", F.explode(numbers))
    none = [F.lit(None).cast("long").alias(c) for c in ("kth_score", "kth_id")]
    start = asked.select("vec_id", "asked", "vector", "block", first_shard.alias("shard"), *none)
    first = written(run(spread.where(first_shard == F.col("shard")), start), "first-shard")
    kth = best(first, k).where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), "asked", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id")
    )
    others = asked.join(kth, ["vec_id", "asked"], "left").withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    )
    rest = run(
        spread.where(first_shard != F.col("shard")),
        others.where(first_shard != F.col("shard")),
    )
    return best(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


@query("op9_exact_topk")
def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of every fiftieth vector."""
    return top_inner_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
