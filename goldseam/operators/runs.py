"""Model runs: compare, pick the best, decide on promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.functions import columns as X


def recent_runs(runs: DataFrame, n: int, model_type: str | None = None) -> DataFrame:
    """The latest ``n`` runs, optionally of one model type."""
    chosen = runs if model_type is None else runs.filter(F.col("model_type") == model_type)
    return chosen.orderBy(F.desc("start_time"), "run_id").limit(n)


def scored_runs(runs: DataFrame, latency_weight: float = 0.2) -> DataFrame:
    score = X.composite_score("f1", "latency_p95_ms", latency_weight)
    return runs.withColumn("composite_score", score)


def best_run(runs: DataFrame, latency_weight: float = 0.2) -> DataFrame:
    """The winner by composite score, one row."""
    return scored_runs(runs, latency_weight).orderBy(F.desc("composite_score"), "run_id").limit(1)


def promotion_gate(
    runs: DataFrame,
    production_f1: Column,
    min_f1: float = 0.85,
    max_p95_ms: float = 50.0,
    min_precision: float = 0.80,
    min_recall: float | None = None,
) -> DataFrame:
    """Failures and verdict per run. ``production_f1`` is null before the first deploy.

    Missing metrics fail their threshold. The recall threshold is checked on request.
    """
    f1 = F.coalesce("f1", F.lit(0.0))
    tests = {
        "f1": f1 < min_f1,
        "latency_p95": F.coalesce("latency_p95_ms", F.lit(9999.0)) > max_p95_ms,
        "precision": F.coalesce("precision", F.lit(0.0)) < min_precision,
    }
    if min_recall is not None:
        tests["recall"] = F.coalesce("recall", F.lit(0.0)) < min_recall
    tests["production"] = f1 < F.coalesce(production_f1, F.lit(float("-inf")))
    failures = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tests.items()]))
    return runs.withColumn("failures", F.concat_ws(",", failures)).withColumn(
        "promoted", F.col("failures") == ""
    )


def staleness(trained_at: Column, now: Column, max_days: int = 30) -> Column:
    """Whether a model is older than allowed."""
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(trained_at.cast("timestamp"))
    return age > max_days * 86_400 * 1_000_000
