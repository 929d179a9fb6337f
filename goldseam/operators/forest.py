"""Isolation forest: sampling and tree growth as one grouped job, scoring as a vector UDF.

Each tree sees at most ``sample_rows`` rows (256 by default), so a group is small whatever
the table's size, and the whole forest has at most ``trees * (2 * sample_rows - 1)`` nodes.
That bound is checked before the nodes are sent to the scoring tasks.
"""

from __future__ import annotations

import math
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldseam.operators.ordered import exact_quantiles

NODE_DDL = (
    "tree int, node int, feature int, threshold double, left int, right int, size long, depth int"
)


def average_path(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + np.euler_gamma) - 2.0 * (n - 1.0) / n


def _grow(values: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes (node, feature, threshold, left, right, size, depth) of one tree."""
    nodes: list[tuple] = []
    pending = [(0, np.arange(len(values)), 0)]
    count = 1
    while pending:
        node, rows, depth = pending.pop()
        part = values[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, len(rows), depth))
            continue
        feature = int(rng.choice(usable))
        threshold = float(rng.uniform(low[feature], high[feature]))
        goes_left = part[:, feature] <= threshold
        left, right = count, count + 1
        count += 2
        nodes.append((node, feature, threshold, left, right, len(rows), depth))
        pending.append((left, rows[goes_left], depth + 1))
        pending.append((right, rows[~goes_left], depth + 1))
    return nodes


def sample_per_tree(
    df: DataFrame, key: str, trees: int, sample_rows: int, total: int, seed: int
) -> DataFrame:
    """At most ``sample_rows`` rows for each tree, chosen by hashes of the key.

    A first hash keeps about ``2 * trees * sample_rows`` rows (all, if there are fewer), a second
    per tree draws from these, so that a row of the table costs one hash and every tree gets about
    twice the rows it needs. Trees may share rows.
    """
    window = Window.partitionBy("tree").orderBy("_pick", key)
    whole, pool = max(total, 1), min(max(total, 1), 2 * trees * sample_rows)
    kept = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(whole)) < pool
    chosen = F.filter(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda t: F.pmod(F.xxhash64(F.lit(seed + 1), t, F.col(key)), F.lit(pool)) < 2 * sample_rows,
    )
    drawn = df.filter(kept).withColumn("tree", F.explode(chosen))
    # About 2 * trees * sample_rows rows are left. They are placed by tree in a fixed number of
    # tasks, because growing is costly per row and the sizes would suggest a single task.
    ranked = drawn.withColumn("_pick", F.xxhash64(F.lit(seed + 2), "tree", key))
    placed = ranked.repartition(trees, "tree")
    return (
        placed.withColumn("_rn", F.row_number().over(window))
        .filter(F.col("_rn") <= sample_rows)
        .drop("_rn")
    )


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    trees: int = 100,
    max_samples: int = 256,
    seed: int = 42,
) -> tuple[DataFrame, int]:
    """The node table and the number of rows each tree saw."""
    total = df.count()
    sample_rows = max(min(max_samples, total), 1)
    names = list(features)
    limit = math.ceil(math.log2(max(sample_rows, 2)))
    drawn = sample_per_tree(df.select(key, *names), key, trees, sample_rows, total, seed)

    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        tree = int(rows["tree"].iloc[0])
        ordered = rows.sort_values(["_pick", key])
        rng = np.random.default_rng([seed, tree])
        nodes = _grow(ordered[names].to_numpy(dtype=float), rng, limit)
        frame = pd.DataFrame(
            nodes, columns=["node", "feature", "threshold", "left", "right", "size", "depth"]
        )
        frame.insert(0, "tree", tree)
        return frame

    return drawn.groupBy("tree").applyInPandas(grow, NODE_DDL), sample_rows


@dataclass(frozen=True)
class Forest:
    """The nodes as arrays, small enough to travel with a task."""

    features: tuple[str, ...]
    sample_rows: int
    trees: tuple

    @staticmethod
    def collect(
        nodes: DataFrame, features: Sequence[str], sample_rows: int, trees: int = 100
    ) -> Forest:
        """Bring the node table of ``trees`` trees to the driver; refuses one larger than such a
        forest can be."""
        bound = trees * (2 * sample_rows - 1)
        rows = nodes.limit(bound + 1).toPandas()
        if len(rows) > bound:
            raise ValueError(f"a forest of {trees} trees has at most {bound} nodes")
        packed = []
        for _, tree in rows.groupby("tree", sort=True):
            tree = tree.sort_values("node")
            leaf = (tree["feature"] < 0).to_numpy()
            number = np.arange(len(tree))
            # A leaf points to itself, so every row takes the same number of steps.
            step = np.empty((len(tree), 2), dtype=np.int32)
            step[:, 0] = np.where(leaf, number, tree["left"])
            step[:, 1] = np.where(leaf, number, tree["right"])
            ends = tree["depth"].to_numpy() + np.array([average_path(n) for n in tree["size"]])
            packed.append(
                (
                    np.where(leaf, 0, tree["feature"]).astype(np.int32),
                    tree["threshold"].to_numpy(dtype=float),
                    step.ravel(),
                    ends,
                    int(tree["depth"].max()),
                )
            )
        return Forest(tuple(features), sample_rows, tuple(packed))

    def path_lengths(self, values: np.ndarray) -> np.ndarray:
        """Mean path length of each row."""
        columns = values.shape[1]
        flat = np.ascontiguousarray(values).ravel()
        first = np.arange(len(values)) * columns
        total = np.zeros(len(values))
        for feature, threshold, step, ends, depth in self.trees:
            at = np.zeros(len(values), dtype=np.int32)
            for _ in range(depth):
                right = flat.take(first + feature.take(at)) > threshold.take(at)
                at = step.take(2 * at + right)
            total += ends.take(at)
        return total / max(len(self.trees), 1)

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Anomaly score 0..1, higher is more anomalous."""
        norm = average_path(self.sample_rows) or 1.0
        return np.power(2.0, -self.path_lengths(values) / norm)


def score_column(forest: Forest, paths: bool = False) -> Column:
    """Score (or mean path length) of the feature columns, in Arrow batches."""
    names = list(forest.features)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            values = np.column_stack([s.to_numpy(dtype=float) for s in batch])
            yield pd.Series(forest.path_lengths(values) if paths else forest.scores(values))

    return score(*[F.col(n).cast("double") for n in names])


def timed_score_column(forest: Forest) -> Column:
    """Score and the milliseconds a row took, averaged over its Arrow batch."""
    names = list(forest.features)

    @F.pandas_udf("score double, latency_ms double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            start = time.perf_counter()
            values = np.column_stack([s.to_numpy(dtype=float) for s in batch])
            scores = forest.scores(values)
            took = (time.perf_counter() - start) * 1000.0 / max(len(values), 1)
            yield pd.DataFrame({"score": scores, "latency_ms": took})

    return score(*[F.col(n).cast("double") for n in names])


def threshold_of(train: DataFrame, score: str, contamination: float = 0.05) -> float:
    """Score above which the given share of the training rows lies."""
    found = exact_quantiles(train, [], score, [1.0 - contamination]).first()
    return float(found["quantiles"][0])


def predict_column(score: str | Column, threshold: float) -> Column:
    """-1 for anomalies, +1 otherwise."""
    value = F.col(score) if isinstance(score, str) else score
    return F.when(value > threshold, F.lit(-1)).otherwise(F.lit(1))


def permutation_importance(
    df: DataFrame,
    forest: Forest,
    key: str,
    threshold: float,
    label: str = "label",
    repeats: int = 5,
    slot_rows: int = 100_000,
    seed: int = 42,
) -> DataFrame:
    """Mean drop of F1 when one feature is shuffled, over all rows. ``key`` identifies a row.

    In each repeat the rows are dealt into slots of about ``slot_rows`` by a hash and put into a
    random order there. Every row takes the feature of the row after it, the last one that of the
    first: a random permutation from one sort per repeat, without numbering the table. The
    features share the order; each of them is scored with the others unchanged.
    """
    from goldseam.operators.metrics import confusion

    names = list(forest.features)
    rows = df.select(key, label, *[F.col(n).cast("double").alias(n) for n in names])
    slots = max(1, math.ceil(df.count() / slot_rows))
    tried = rows.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))).withColumns(
        {
            "_slot": F.pmod(F.xxhash64(F.lit(seed), key, "repeat"), F.lit(slots)),
            "_draw": F.xxhash64(F.lit(seed + 1), key, "repeat"),
        }
    )
    by = Window.partitionBy("repeat", "_slot").orderBy("_draw", key)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = F.struct(*names)
    # Spread by number, not by size: scoring is costly per row.
    spread = tried.repartition(max(repeats * slots, 1), "repeat", "_slot")
    mixed = spread.withColumn(
        "_other", F.coalesce(F.lead(values).over(by), F.first(values).over(whole))
    )
    # The unchanged rows are scored once, in the first repeat.
    trials = F.array(*[F.lit(n) for n in ["", *names]])
    each = mixed.withColumn("feature", F.explode(trials)).filter("feature <> '' or repeat = 0")
    swapped = each.withColumns(
        {n: F.when(F.col("feature") == n, F.col(f"_other.{n}")).otherwise(F.col(n)) for n in names}
    )
    scored = swapped.withColumn("_score", score_column(forest))
    flagged = scored.withColumn("prediction", (F.col("_score") > threshold).cast("int"))
    f1 = confusion(flagged, label, "prediction", ["feature", "repeat"])
    # One row per trial from here on.
    everything = Window.partitionBy(F.lit(0))
    base = F.max(F.when(F.col("feature") == "", F.col("f1"))).over(everything)
    return (
        f1.withColumn("_base", base)
        .filter("feature <> ''")
        .groupBy("feature")
        .agg(
            F.avg(F.col("_base") - F.col("f1")).alias("importance"),
            F.stddev_pop("f1").alias("importance_std"),
        )
    )


def evaluate(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "score",
    latency: str | None = None,
) -> DataFrame:
    """One row of model metrics: precision, recall, F1, AUC and latency percentiles."""
    from goldseam.operators import metrics as M

    result = M.confusion(df, label, prediction)
    result = result.withColumn("auc_roc", M.roc_auc(df, label, score).scalar())
    if latency:
        wanted = {"latency_p50_ms": 0.5, "latency_p95_ms": 0.95, "latency_p99_ms": 0.99}
        found = exact_quantiles(df, [], latency, list(wanted.values())).select("quantiles").scalar()
        result = result.withColumns({n: found[i] for i, n in enumerate(wanted)})
    return result
