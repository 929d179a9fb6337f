"""Exact nearest neighbours by pivot cells, and the local outlier factor on top.

Points go to the nearest of about sqrt(n) pivots. Cells that lie together make groups of bounded
size, and the points of a group are stored as blocks, a row each. One task takes a group of
queries and the blocks that can hold one of their ``k`` nearest points: the triangle inequality
over the pivots rules the other blocks out. Blocks pass by the task, the closest first; a matrix
product of single precision with a bound of its error shows which pairs can come among the ``k``
nearest found so far, and only these are measured. Equal points are merged first and carry a
weight, so copies cost nothing.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from goldseam.functions import columns as X
from goldseam.operators.ordered import exact_quantiles
from goldseam.session import materialize

MAX_PIVOTS = 4_096
#: Points of a block, and blocks of a group, at most; fewer of long vectors.
BLOCK_ROWS = 2_048
GROUP_BLOCKS = 8
BLOCK_BYTES = 2 << 20
#: Groups that are wanted before they get larger.
LEAST_GROUPS = 48
SMALL = 1e-10


def vector(columns: Sequence[str]) -> Column:
    """Feature columns as one array of doubles."""
    return F.array(*[F.col(c).cast("double") for c in columns])


def distinct_points(df: DataFrame, vec: str, key: str) -> DataFrame:
    """Distinct vectors with the smallest key and the number of copies."""
    return df.groupBy(F.col(vec).cast("array<double>").alias("vec")).agg(
        F.min(key).alias("pid"), F.count(F.lit(1)).alias("w")
    )


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.empty((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances, from differences so that small ones stay exact."""
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for start in range(0, len(a), step):
        part = a[start : start + step, None, :] - b[None, :, :]
        out[start : start + step] = np.sqrt(np.einsum("ijk,ijk->ij", part, part))
    return out


def _lengths(a: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", a, a))


def _finite(vec: str) -> Column:
    """Whether a vector has only numbers; the others are at no distance from anything."""
    return F.coalesce(F.forall(vec, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))), F.lit(False))


def _side_by_side(points: np.ndarray) -> np.ndarray:
    """An order of points in which neighbours mostly stand together: halves along the widest side."""
    parts, out = [np.arange(len(points))], []
    while parts:
        part = parts.pop()
        if len(part) <= 2:
            out.append(part)
            continue
        some = points[part]
        part = part[np.argsort(some[:, np.ptp(some, axis=0).argmax()], kind="stable")]
        parts += [part[len(part) // 2 :], part[: len(part) // 2]]
    return np.concatenate(out) if out else np.zeros(0, int)


class Cells:
    """Pivots and per-cell facts; everything here has at most MAX_PIVOTS entries (times k)."""

    def __init__(self, points: DataFrame, k: int, seed: int = 42) -> None:
        numbers = points.filter(_finite("vec"))
        wanted = min(MAX_PIVOTS, max(1, math.ceil(math.sqrt(numbers.count()))))
        drawn = numbers.orderBy(F.xxhash64(F.lit(seed), "pid"), "pid").limit(wanted)
        self.pivots = _matrix(drawn.select("vec").toPandas()["vec"])
        self.order = _side_by_side(self.pivots)
        self.k = k
        self.all_points = points
        self.points = materialize(self.assigned(numbers), "cells")
        self.counts, self.radius = self.facts(self.points)
        # The k + 1 points closest to each pivot bound the distances of any query.
        closest = Window.partitionBy("cell").orderBy("d", "pid")
        near = (
            self.points.select("cell", "pid", "d")
            .withColumn("_rn", F.row_number().over(closest))
            .filter(F.col("_rn") <= k + 1)
            .toPandas()
        )
        self.inner = np.full((len(self.pivots), k + 1), np.inf)
        self.inner[near["cell"], near["_rn"] - 1] = near["d"]

    def assigned(self, rows: DataFrame) -> DataFrame:
        """Rows with their cell and the distance ``d`` from its pivot."""
        near = rows.withColumn("_c", self.nearest("vec"))
        return near.select(*rows.columns, F.col("_c.cell").alias("cell"), F.col("_c.d").alias("d"))

    def facts(self, rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Rows per cell and the largest distance from its pivot, -1 where there is none."""
        found = rows.groupBy("cell").agg(F.max("d").alias("radius"), F.count(F.lit(1)).alias("n")).toPandas()
        counts, radius = np.zeros(len(self.pivots), int), np.full(len(self.pivots), -1.0)
        counts[found["cell"]], radius[found["cell"]] = found["n"], found["radius"]
        return counts, radius

    def nearest(self, vec: str) -> Column:
        pivots = self.pivots

        @F.pandas_udf("cell int, d double")
        def assign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            middle = pivots.mean(axis=0)
            others = pivots - middle
            half = np.einsum("ij,ij->i", others, others) / 2
            for batch in batches:
                if not len(batch):
                    yield pd.DataFrame({"cell": pd.Series(dtype="int32"), "d": pd.Series(dtype=float)})
                    continue
                rows = _matrix(batch)
                # Of two pivots at almost one distance either will do.
                cell = (half - (rows - middle) @ others.T).argmin(axis=1)
                yield pd.DataFrame({"cell": cell.astype("int32"), "d": _lengths(rows - pivots[cell])})

        return assign(vec)

    def reachable(self, radius: np.ndarray) -> np.ndarray:
        """By cell of queries, as bits: the cells that may hold one of their nearest points.

        ``radius`` is that of the queries of each cell. The k-th nearest point of a query lies no
        further than that of the pivot and the radius together.
        """
        out = []
        for at, pivot in enumerate(self.pivots):
            d = _distances(pivot[None, :], self.pivots)[0]
            close = np.argpartition(d, 63)[:64] if len(d) > 64 else np.arange(len(d))
            above = (d[close, None] + self.inner[close]).ravel()
            rank = min(self.k, len(above) - 1)
            bound = np.partition(above, rank)[rank] + 2 * radius[at]
            out.append(np.packbits((self.counts > 0) & ~(d - self.radius > bound * (1 + 1e-9) + 1e-12)))
        return np.array(out)


class Groups:
    """Cells of close pivots put together up to a number of rows, larger cells cut by hash."""

    def __init__(self, cells: Cells, counts: np.ndarray) -> None:
        dims = cells.pivots.shape[1]
        self.block = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, dims))))
        rows = min(GROUP_BLOCKS * self.block, max(self.block // 4, 1, math.ceil(counts.sum() / LEAST_GROUPS)))
        self.first, self.slices = np.zeros(len(counts), int), np.zeros(len(counts), int)
        self.total, filled, centers = 0, rows, []
        for cell in cells.order:
            if not counts[cell]:
                continue
            self.slices[cell] = math.ceil(counts[cell] / rows)
            if filled + counts[cell] > rows:
                self.total, filled = self.total + self.slices[cell], 0
                centers += [cells.pivots[cell]] * self.slices[cell]
            self.first[cell] = self.total - self.slices[cell]
            filled += counts[cell]
        self.centers = np.array(centers).reshape(len(centers), dims)

    def of(self, rows: DataFrame, key: str) -> DataFrame:
        """Rows with their group."""
        known = pd.DataFrame({"cell": np.arange(len(self.first)), "_at": self.first, "_n": self.slices})
        table = rows.sparkSession.createDataFrame(known[known["_n"] > 0], "cell int, _at int, _n int")
        joined = rows.join(F.broadcast(table), "cell")
        place = F.col("_at") + F.pmod(F.xxhash64(key), F.col("_n")).cast("int")
        return joined.withColumn("grp", place).drop("_at", "_n")


def _vectors(table: pa.Table) -> np.ndarray:
    flat = table.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(table.num_rows, -1)


def _packed(vecs: np.ndarray) -> bytes:
    """Numbers as bytes, in single precision where that keeps them."""
    with np.errstate(over="ignore"):
        short = vecs.astype("<f4")
    return (short if (short == vecs).all() else vecs.astype("<f8")).tobytes()


def _unpacked(data: bytes, rows: int, dims: int) -> np.ndarray:
    return np.frombuffer(data, "<f8" if len(data) == 8 * rows * dims else "<f4").reshape(rows, dims).astype(float)


class Nearest:
    """The ``k`` nearest points of some queries, while blocks of points pass by."""

    def __init__(self, qids: np.ndarray, vecs: np.ndarray, k: int, exclude_self: bool) -> None:
        self.qids, self.vecs, self.k, self.exclude_self = qids, vecs, k, exclude_self
        self.center = vecs.mean(axis=0)
        near = vecs - self.center
        longest = _lengths(near).max()
        self.scale = 1 / longest if 1e-300 < longest < np.inf else 1.0
        self.near = near * self.scale
        self.norm = np.einsum("ij,ij->i", self.near, self.near)
        self.left = np.hstack([-2 * self.near, np.ones((len(vecs), 1))]).astype("f4")
        # Error of a product in single precision, as a share of both squared lengths.
        self.error = (vecs.shape[1] + 16) * 1.2e-7
        self.dist = np.full((len(vecs), k), np.inf)
        self.pids, self.w = None, np.zeros((len(vecs), k), int)

    def add(self, pids: np.ndarray, vecs: np.ndarray, w: np.ndarray) -> None:
        if self.pids is None:
            self.pids = np.zeros(self.dist.shape, pids.dtype)
        points = (vecs - self.center) * self.scale
        middle = points.mean(axis=0)
        reach, far = _lengths(points - middle).max(), _lengths(middle[None, :])[0]
        away = _lengths(self.near - middle) - reach
        last = self.dist[:, -1] * self.scale
        active = np.flatnonzero(~(away > last * (1 + 1e-9) + 1e-12 * (1 + reach + far)))
        norm = np.einsum("ij,ij->i", points, points)
        right = np.hstack([points, norm[:, None] * (1 - self.error)]).astype("f4").T
        for start in range(0, len(active), 1024):
            some = active[start : start + 1024]
            product = self.left[some] @ right
            limit = last[some] ** 2
            new = np.isinf(limit)
            head = max(1024, 4 * self.k)
            if new.any() and min(head, len(points)) > self.k:
                # One of k + 1 points may be the query itself.
                kth = np.partition(product[new, :head], self.k, axis=1)[:, self.k].astype(float)
                above = kth + self.norm[some][new] * (1 + self.error) + 3 * self.error * norm[:head].max()
                limit[new] = np.where(np.isnan(above), np.inf, np.maximum(above, 0))
            bar = limit * (1 + 1e-6) + 1e-30 - self.norm[some] * (1 - self.error)
            bar = np.nextafter(bar.astype("f4"), np.float32(np.inf))
            # Later blocks hold nothing for most queries; a smallest product tells that faster.
            open_ = np.flatnonzero(~(product.min(axis=1) > bar))
            if len(open_) < len(some):
                some, product, bar = some[open_], product[open_], bar[open_]
            hit = np.flatnonzero(~(product > bar[:, None]))
            self._measure(some[hit // len(points)], hit % len(points), pids, vecs, w)

    def _measure(self, row: np.ndarray, col: np.ndarray, pids: np.ndarray, vecs: np.ndarray, w: np.ndarray) -> None:
        """Take pairs of a query and a point, in the order of queries, that may be among the nearest."""
        step = max(1, 4_000_000 // vecs.shape[1])
        d = np.empty(len(row))
        for at in range(0, len(row), step):
            pairs = slice(at, at + step)
            d[pairs] = _lengths(self.vecs[row[pairs]] - vecs[col[pairs]])
        kept = np.isfinite(d) & (d <= self.dist[row, -1])
        if self.exclude_self:
            kept &= self.qids[row] != pids[col]
        row, col, d = row[kept], col[kept], d[kept]
        queries, starts, counts = np.unique(row, return_index=True, return_counts=True)
        # Queries with about as many pairs are ranked together.
        for size in np.unique(np.ceil(np.log2(counts))).astype(int) if len(queries) else ():
            same = np.flatnonzero(np.ceil(np.log2(counts)) == size)
            step = max(1, 2_000_000 // (self.k + (1 << size)))
            for at in range(0, len(same), step):
                part = same[at : at + step]
                self._rank(queries[part], starts[part], counts[part], d, pids[col], w[col])

    def _rank(
        self, q: np.ndarray, starts: np.ndarray, counts: np.ndarray, d: np.ndarray, pids: np.ndarray, w: np.ndarray
    ) -> None:
        places = np.arange(counts.max())
        there = places < counts[:, None]
        at = np.where(there, starts[:, None] + places, 0)
        dist = np.hstack([self.dist[q], np.where(there, d[at], np.inf)])
        ids = np.hstack([self.pids[q], pids[at]])
        order = np.lexsort((ids, dist), axis=1)[:, : self.k]
        self.dist[q] = np.take_along_axis(dist, order, 1)
        found = np.take_along_axis(ids, order, 1)
        self.pids = self.pids.astype(np.promote_types(self.pids.dtype, found.dtype), copy=False)
        self.pids[q] = found
        self.w[q] = np.take_along_axis(np.hstack([self.w[q], w[at]]), order, 1)

    def found(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.qids), 4096):
            rows, places = np.nonzero(np.isfinite(self.dist[at : at + 4096]))
            rows += at
            if len(rows):
                columns = [self.qids[rows], self.pids[rows, places], self.w[rows, places], self.dist[rows, places], places + 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.tolist(), f.type) for c, f in zip(columns, schema)], schema=schema
                )


def nearest_neighbors(queries: DataFrame, cells: Cells, exclude_self: bool) -> DataFrame:
    """The ``k`` nearest distinct points (qid, pid, w, dist, place) of queries (qid, vec)."""
    k, pivots, dims = cells.k, cells.pivots, cells.pivots.shape[-1]
    key_type = queries.schema["qid"].dataType.simpleString()
    point_type = cells.points.schema["pid"].dataType.simpleString()
    ddl = f"qid {key_type}, pid {point_type}, w long, dist double, place int"
    if not len(pivots):
        return queries.sparkSession.createDataFrame([], ddl)
    asked = materialize(cells.assigned(queries.filter(_finite("vec")).select("qid", "vec")), "asked")
    counts, radius = cells.facts(asked)
    near = cells.reachable(radius)
    groups, stored = Groups(cells, counts), Groups(cells, cells.counts)
    block = stored.block
    to_type = "array<struct<grp int, ord double>>"
    packed = f"to {to_type}, qids array<{key_type}>, pids array<{point_type}>, w array<long>, data binary"
    block_kinds, kinds = (to_arrow_schema(StructType.fromDDL(x)) for x in (packed, ddl))

    def goals(vecs: np.ndarray, own: np.ndarray) -> list[dict]:
        """Groups of queries that need a block of points in these cells, and how far away they are."""
        wanted = np.zeros(len(pivots), bool)
        for cell in own:
            wanted |= (near[:, cell >> 3] >> (7 - (cell & 7))) & 1 > 0
        wanted &= groups.slices > 0
        some = [np.arange(f, f + n) for f, n in zip(groups.first[wanted], groups.slices[wanted])]
        numbers = np.unique(np.concatenate(some)) if some else np.zeros(0, int)
        far = _lengths(groups.centers[numbers] - vecs.mean(axis=0))
        return [{"grp": g, "ord": d} for g, d in zip(numbers.tolist(), far.tolist())]

    def pack(table: pa.Table, points: bool) -> pa.Table:
        vecs, cell = _vectors(table), table.column("cell").to_numpy()
        order = np.lexsort((vecs[:, np.ptp(vecs, axis=0).argmax()], cell))
        rows = []
        for at in range(0, len(order), block):
            part = order[at : at + block]
            some = table.take(pa.array(part))
            ids = some.column("id").to_pylist()
            if points:
                to = goals(vecs[part], np.unique(cell[part]))
                rows.append((to, None, ids, some.column("w").to_pylist(), _packed(vecs[part])))
            else:
                to = [{"grp": some.column("grp")[0].as_py(), "ord": -1.0}]
                rows.append((to, ids, None, None, _packed(vecs[part])))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), block_kinds)], schema=block_kinds)

    sides = [
        groups.of(asked, "qid").withColumnRenamed("qid", "id").groupBy("grp").applyInArrow(
            lambda table: pack(table, False), packed
        ),
        stored.of(cells.points, "pid").withColumnRenamed("pid", "id").groupBy("grp").applyInArrow(
            lambda table: pack(table, True), packed
        ),
    ]
    blocks = sides[0].unionByName(sides[1]).select(F.inline("to"), "qids", "pids", "w", "data")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((batch, i) for batch in batches for i in range(batch.num_rows))
        for _, group in itertools.groupby(rows, lambda r: r[0].column("grp")[r[1]].as_py()):
            qids, vecs, task = [], [], None
            for batch, i in group:
                data = batch.column("data")[i].as_py()
                if batch.column("ord")[i].as_py() < 0:
                    qids += batch.column("qids")[i].as_py()
                    vecs.append(_unpacked(data, len(batch.column("qids")[i]), dims))
                    continue
                pids = np.asarray(batch.column("pids")[i].as_py())
                with np.errstate(over="ignore", invalid="ignore"):
                    if task is None:
                        task = Nearest(np.asarray(qids), np.concatenate(vecs), k, exclude_self)
                    task.add(pids, _unpacked(data, len(pids), dims), np.asarray(batch.column("w")[i].as_py()))
            if task is not None and task.pids is not None:
                yield from task.found(kinds)

    dealt = blocks.repartitionById(max(1, int(groups.total)), "grp").sortWithinPartitions("grp", "ord")
    return dealt.mapInArrow(search, ddl)


def _of_vectors(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with what is known of their vector ``vec``. The hash goes first, as arrays sort slowly."""
    sides = [x.withColumn("_hash", F.xxhash64("vec")) for x in (rows, known)]
    return sides[0].join(sides[1], ["_hash", "vec"]).drop("_hash")


def _weighted(neighbors: DataFrame, k: int, own: bool) -> DataFrame:
    """How many copies of each neighbour count towards the ``k``, nearest first."""
    before = Window.partitionBy("qid").orderBy("dist", "pid").rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum("w").over(before), F.lit(0))
    first = F.least(F.col("own") - 1, F.lit(k)) if own else F.lit(0)
    left = F.lit(k) - first - taken
    used = F.when(F.col("w").isNotNull(), F.least("w", left)).otherwise(F.lit(0)).cast("double")
    return neighbors.withColumn("use", used).withColumn("first", first.cast("double"))


def _densities(neighbors: DataFrame, k_distance: DataFrame) -> DataFrame:
    """Local reachability density per query from weighted neighbours."""
    joined = neighbors.join(k_distance.withColumnRenamed("kdist", "_ok"), "pid", "left")
    reach = F.greatest(F.col("_ok"), F.col("dist")) * F.col("use")
    sums = joined.groupBy("qid").agg(
        F.sum(F.when(F.col("use") > 0, reach)).alias("far"),
        F.sum(F.when(F.col("use") > 0, F.col("use"))).alias("n"),
        F.first("first").alias("first"),
        F.first("self_k").alias("self_k"),
    )
    # Copies of the point itself are reached at its own k-distance.
    far = F.coalesce("far", F.lit(0.0)) + F.col("first") * F.coalesce("self_k", F.lit(0.0))
    n = F.coalesce("n", F.lit(0.0)) + F.col("first")
    return sums.select("qid", (F.lit(1.0) / (F.coalesce(X.ratio(far, n), F.lit(0.0)) + SMALL)).alias("lrd"))


class LocalOutlierFactor:
    """Fitted factor: ``train_scores`` for the fitted rows, ``score`` for new ones."""

    def __init__(self, df: DataFrame, vec: str, key: str, k: int = 20) -> None:
        self.k, self.vec, self.key = k, vec, key
        self.rows = df
        self.cells = Cells(materialize(distinct_points(df, vec, key), "points"), k)
        points = self.cells.all_points
        found = nearest_neighbors(
            points.select(F.col("pid").alias("qid"), "vec"), self.cells, exclude_self=True
        )
        sizes = points.select(F.col("pid").alias("qid"), F.col("w").alias("own"))
        # Every point is kept, also one whose neighbours are all copies of itself.
        weighted = _weighted(sizes.filter("qid is not null").join(found, "qid", "left"), k, own=True)
        # A window, as a join of the pairs with their largest distance would search twice.
        last = F.max(F.when(F.col("use") > 0, F.col("dist"))).over(Window.partitionBy("qid"))
        self.neighbors = materialize(weighted.withColumn("self_k", F.coalesce(last, F.lit(0.0))), "neighbors")
        self.k_distance = self.neighbors.groupBy(F.col("qid").alias("pid")).agg(
            F.first("self_k").alias("kdist")
        )
        densities = _densities(self.neighbors, self.k_distance)
        self.density = materialize(densities.withColumnRenamed("qid", "pid"), "density")

    def _factors(self, neighbors: DataFrame, own_density: DataFrame) -> DataFrame:
        joined = neighbors.filter("use > 0").join(
            self.density.withColumnRenamed("lrd", "_olrd"), "pid"
        )
        others = joined.groupBy("qid").agg(
            F.sum(F.col("_olrd") * F.col("use")).alias("dense"), F.sum("use").alias("n")
        )
        firsts = neighbors.groupBy("qid").agg(F.first("first").alias("first"))
        both = own_density.join(firsts, "qid").join(others, "qid", "left")
        dense = F.coalesce("dense", F.lit(0.0)) + F.col("first") * F.col("lrd")
        n = F.coalesce("n", F.lit(0.0)) + F.col("first")
        return both.select("qid", F.coalesce(X.ratio(dense, n) / F.col("lrd"), F.lit(1.0)).alias("lof"))

    def train_scores(self) -> DataFrame:
        """(key, lof) of every fitted row."""
        factors = self._factors(self.neighbors, self.density.withColumnRenamed("pid", "qid"))
        by_vec = factors.join(
            self.cells.all_points.select(F.col("pid").alias("qid"), "vec"), "qid"
        ).select("vec", "lof")
        rows = self.rows.select(self.key, F.col(self.vec).cast("array<double>").alias("vec"))
        return _of_vectors(rows, by_vec).select(self.key, "lof")

    def threshold(self, contamination: float = 0.05) -> float:
        found = exact_quantiles(self.train_scores(), [], "lof", [1.0 - contamination]).first()
        return float(found["quantiles"][0])

    def score(self, df: DataFrame, vec: str, key: str) -> DataFrame:
        """(key, lof) of new rows against the fitted ones."""
        queries = materialize(distinct_points(df, vec, key).select(F.col("pid").alias("qid"), "vec"), "queries")
        found = nearest_neighbors(queries, self.cells, exclude_self=False)
        weighted = materialize(
            _weighted(found, self.k, own=False).withColumn("self_k", F.lit(0.0)), "novel"
        )
        density = _densities(weighted, self.k_distance)
        factors = self._factors(weighted, density)
        by_vec = factors.join(queries, "qid").select("vec", "lof")
        rows = df.select(key, F.col(vec).cast("array<double>").alias("vec"))
        return _of_vectors(rows, by_vec).select(key, "lof")
