"""Metrics: histograms, quantiles, classification scores, curves and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldseam.functions import columns as X
from goldseam.operators.ordered import exact_quantiles, row_at, running_sums
from goldseam.session import materialize


def bucket_counts(
    df: DataFrame, value: str, bounds: Sequence[float], keys: Sequence[str] = ()
) -> DataFrame:
    """Cumulative bucket counts (keys, le, cum_count), the last bound being +Inf (null).

    One conditional count per bound in a single aggregate; rows are not multiplied.
    """
    limits = [float(b) for b in bounds]
    counts = df.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= b).alias(f"_b{i}") for i, b in enumerate(limits)],
        F.count(value).alias("_all"),
    )
    entries = [
        F.struct(F.lit(b).alias("le"), F.col(f"_b{i}").alias("cum_count"))
        for i, b in enumerate(limits)
    ]
    entries.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("_all").alias("cum_count")))
    return counts.select(*keys, F.inline(F.array(*entries)))


def bucket_quantile(buckets: DataFrame, q: float, keys: Sequence[str] = ()) -> DataFrame:
    """Quantile interpolated inside the bucket it falls into.

    The first bucket starts at zero; in the open bucket the highest bound is returned.
    """
    place = F.coalesce("le", F.lit(float("inf")))
    listed = buckets.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(place.alias("le"), "cum_count"))).alias("b")
    )
    total = F.element_at("b", -1)["cum_count"]
    rank = total * F.lit(float(q))
    hit = F.filter("b", lambda x: x["cum_count"] >= F.col("_rank"))[0]
    below = F.filter("b", lambda x: x["le"] < F.col("_hit.le"))
    top = F.element_at(F.filter("b", lambda x: x["le"] < float("inf")), -1)["le"]
    steps = listed.withColumn("_total", total).withColumn("_rank", rank).withColumn("_hit", hit)
    steps = steps.withColumn("_below", F.try_element_at(below, F.lit(-1)))
    low = F.coalesce(F.col("_below.le"), F.lit(0.0))
    before = F.coalesce(F.col("_below.cum_count"), F.lit(0))
    inside = X.ratio(F.col("_rank") - before, F.col("_hit.cum_count") - before)
    interpolated = low + (F.col("_hit.le") - low) * inside
    value = (
        F.when(F.col("_total") == 0, None)
        .when(F.col("_hit.le") == float("inf"), top)
        .otherwise(interpolated)
    )
    return steps.select(*keys, value.alias("value"))


def percentiles(
    df: DataFrame, value: str, probabilities: dict[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated percentiles as named columns."""
    found = exact_quantiles(df, keys, value, list(probabilities.values()))
    named = [F.col("quantiles")[i].alias(n) for i, n in enumerate(probabilities)]
    return found.select(*keys, *named)


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", keys: Sequence[str] = ()
) -> DataFrame:
    """Confusion matrix with precision, recall and F1 (zero where undefined)."""
    yes, said = F.col(label) == 1, F.col(prediction) == 1
    counts = df.groupBy(*keys).agg(
        F.count_if(yes & said).alias("tp"),
        F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"),
        F.count_if(~yes & ~said).alias("tn"),
    )
    return add_scores(counts)


def add_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 from tp, fp and fn."""
    zero = F.lit(0.0)
    return counts.withColumns(
        {
            "precision": F.coalesce(X.ratio("tp", F.col("tp") + F.col("fp")), zero),
            "recall": F.coalesce(X.ratio("tp", F.col("tp") + F.col("fn")), zero),
            "f1": F.coalesce(
                X.ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")), zero
            ),
        }
    )


def _score_steps(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, with counts of the higher scores."""
    steps = df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )
    return running_sums(steps, keys, ["-score"], {"tp": "pos", "fp": "neg"})


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()
) -> DataFrame:
    """Area under the ROC curve, ties counted half; zero with a single class."""
    steps = _score_steps(df, label, score, keys)
    # Each negative of this score is beaten by the higher positives and half of its own.
    wins = F.col("neg").cast("double") * (F.col("tp") - F.col("pos") / 2)
    return steps.groupBy(*keys).agg(
        F.coalesce(
            X.ratio(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg")), F.lit(0.0)
        ).alias("auc_roc")
    )


def pr_curve(
    df: DataFrame, label: str = "label", score: str = "score", keys: Sequence[str] = ()
) -> DataFrame:
    """Precision and recall at every distinct threshold, highest first."""
    steps = _score_steps(df, label, score, keys)
    positives = df.filter(F.col(label) == 1).groupBy(*keys).agg(F.count(F.lit(1)).alias("_p"))
    if keys:
        joined = steps.join(positives, list(keys), "left")
    else:
        joined = steps.withColumn("_p", positives.select("_p").scalar())
    return joined.select(
        *keys,
        F.col("score").alias("threshold"),
        "tp",
        "fp",
        X.ratio("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(X.ratio("tp", "_p"), F.lit(0.0)).alias("recall"),
    )


def value_range(df: DataFrame, value: str) -> tuple[float, float]:
    """Minimum and maximum, from one aggregate; zeros for an empty table."""
    row = df.agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi")).first()
    return (row["lo"] or 0.0, row["hi"] or 0.0)


def equal_width_histogram(
    df: DataFrame,
    value: str,
    bins: int = 50,
    by: str | None = None,
    density: bool = False,
) -> DataFrame:
    """Counts in equal bins between minimum and maximum, the last bin closed.

    With ``by`` every class uses the same edges; with ``density`` each class integrates
    to one.
    """
    rows = df.filter(F.col(value).isNotNull())
    low, high = value_range(rows, value)
    width = F.lit(((high - low) if high > low else 1.0) / bins)
    index = F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).cast("int")
    keys = [F.col(by)] if by else []
    counts = rows.groupBy(*keys, index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = counts.withColumn("bin_start", low + F.col("bin") * width)
    edges = edges.withColumn("bin_end", low + (F.col("bin") + 1) * width)
    if density:
        whole = Window.partitionBy(by) if by else Window.partitionBy(F.lit(0))
        share = X.ratio("n", F.sum("n").over(whole))
        edges = edges.withColumn("density", share / width)
    return edges


def drift(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    value: str,
    buckets: int = 10,
    min_rows: int = 1,
    threshold: float = 0.2,
) -> DataFrame:
    """Population stability index per key between two samples in long form.

    Edges are exact quantiles of the expected sample. Values outside the edges fall in no
    bin but count in the total, and an empty bin counts as 1e-6.
    """
    steps = [i / buckets for i in range(buckets + 1)]
    edges = exact_quantiles(expected, keys, value, steps, "edges").withColumn(
        "edges", F.array_distinct("edges")
    )
    # Written out, so that Spark knows the true size of this small table when it joins.
    edges = materialize(edges, "edges")
    a = expected.select(*keys, F.col(value).cast("double").alias("_v"), F.lit(1).alias("_e"))
    b = actual.select(*keys, F.col(value).cast("double").alias("_v"), F.lit(0).alias("_e"))
    both = a.unionByName(b).filter("_v is not null")
    placed = both.join(edges, list(keys)) if keys else both.withColumn(
        "edges", edges.select("edges").scalar()
    )
    last = F.element_at("edges", -1)
    above = F.size(F.filter("edges", lambda e: e <= F.col("_v")))
    index = (
        F.when(F.col("_v") == last, F.size("edges") - 1)
        .when((above >= 1) & (F.col("_v") < last), above)
        .otherwise(F.lit(0))
    )
    counts = placed.groupBy(*keys, index.alias("_bin"), F.size("edges").alias("_edges")).agg(
        F.sum("_e").alias("_ne"), F.sum(1 - F.col("_e")).alias("_na")
    )
    packed = counts.groupBy(*keys).agg(
        F.max("_edges").alias("_edges"),
        F.sum("_ne").alias("expected_rows"),
        F.sum("_na").alias("actual_rows"),
        F.map_from_entries(F.collect_list(F.struct("_bin", F.struct("_ne", "_na")))).alias("_m"),
    )

    def share(cell: Column, name: str, total: str) -> Column:
        part = F.coalesce(X.ratio(F.coalesce(cell[name], F.lit(0)), total), F.lit(0.0))
        return F.when(part == 0, F.lit(1e-6)).otherwise(part)

    def term(bin_number: Column) -> Column:
        cell = F.try_element_at("_m", bin_number)
        e, c = share(cell, "_ne", "expected_rows"), share(cell, "_na", "actual_rows")
        return (c - e) * F.ln(c / e)

    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.greatest(F.col("_edges") - 1, F.lit(1))), term),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    psi = F.when(F.col("_edges") < 2, F.lit(0.0)).otherwise(total)
    enough = (F.col("expected_rows") >= min_rows) & (F.col("actual_rows") > 0)
    return (
        packed.filter(enough)
        .withColumn("psi", psi)
        .withColumn("drifted", F.col("psi") >= threshold)
        .select(*keys, "expected_rows", "actual_rows", "psi", "drifted")
    )


def drift_summary(per_feature: DataFrame, view: str = "view") -> DataFrame:
    """Drifted features per view."""
    return per_feature.groupBy(view).agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if("drifted").alias("drifted_features"),
        F.bool_or("drifted").alias("has_drift"),
    )


def overall_status(stale_views: Column, drifted_views: Column) -> Column:
    return (
        F.when(stale_views > 0, "CRITICAL").when(drifted_views > 0, "WARNING").otherwise("OK")
    )


def _literal(value: object, kind: T.DataType) -> Column:
    """A collected value as a literal; wall-clock times must not pass through a time zone."""
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(str(value)).cast(kind)
    return F.lit(value).cast(kind)


def chronological_split(
    df: DataFrame,
    order: Sequence[str],
    train_ratio: float = 0.70,
    validation_ratio: float = 0.15,
    output: str = "split",
) -> DataFrame:
    """Label rows train, validation or test by their place in the total order.

    Only the two border rows are searched for; labelling compares each row with them, so
    the wide rows are never sorted or moved.
    """
    total = df.count()
    n_train = int(total * train_ratio)
    n_validation = int(total * validation_ratio)
    borders = row_at(df, order, {"train": n_train, "validation": n_train + n_validation})
    names = [name.lstrip("-") for name in order]
    ends = {
        row["_at"]: row.asDict() for row in borders.collect()
    }

    def upto(border: str) -> Column:
        if border not in ends:
            return F.lit(False)
        found = F.lit(True)
        for name, spec in reversed(list(zip(names, order))):
            value, edge = F.col(name), _literal(ends[border][name], df.schema[name].dataType)
            # Nulls sort first in ascending and last in descending order.
            if spec.startswith("-"):
                before = (value > edge) | (value.isNotNull() & edge.isNull())
            else:
                before = (value < edge) | (value.isNull() & edge.isNotNull())
            found = F.coalesce(before, F.lit(False)) | (value.eqNullSafe(edge) & found)
        return found

    label = (
        F.when(upto("train"), "train").when(upto("validation"), "validation").otherwise("test")
    )
    return df.withColumn(output, label)
