"""The model loop: split, scale, fit two detectors, evaluate, pick and gate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.operators import features as FE
from goldseam.operators import forest as FO
from goldseam.operators import metrics as M
from goldseam.operators import neighbors as N
from goldseam.operators import runs as RU
from goldseam.schemas import MODEL_FEATURES
from goldseam.session import materialize


@dataclass(frozen=True)
class Settings:
    """The defaults of the training job."""

    features: tuple[str, ...] = MODEL_FEATURES
    contamination: float = 0.05
    trees: int = 100
    max_samples: int = 256
    neighbors: int = 20
    seed: int = 42
    train_ratio: float = 0.70
    validation_ratio: float = 0.15
    fit_on_all: bool = False


def prepare(df: DataFrame, key: str, time: str, settings: Settings = Settings()) -> DataFrame:
    """Scaled features, label and split. Scaling is fitted on the training part by default."""
    matrix = FE.feature_matrix(df, settings.features, keep=[key, time])
    split = M.chronological_split(
        matrix, [time, key], settings.train_ratio, settings.validation_ratio
    )
    fit_on = None if settings.fit_on_all else F.col("split") == "train"
    return FE.standardize(split, settings.features, fit_on)


def train(
    df: DataFrame, key: str, time: str, started: Column, settings: Settings = Settings()
) -> DataFrame:
    """One run row per detector with its metrics on the test part."""
    rows = materialize(prepare(df, key, time, settings), "prepared")
    fitted, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")

    nodes, seen = FO.fit_forest(
        fitted, settings.features, key, settings.trees, settings.max_samples, settings.seed
    )
    forest = FO.Forest.collect(nodes, settings.features, seen, settings.trees)
    known = fitted.select(FO.score_column(forest).alias("score"))
    limit = FO.threshold_of(known, "score", settings.contamination)
    timed = materialize(
        test.select("label", FO.timed_score_column(forest).alias("_s")).select("label", "_s.*"),
        "scored",
    )
    judged = timed.withColumn("prediction", (F.col("score") > limit).cast("int"))
    first = FO.evaluate(judged, latency="latency_ms").withColumn("model_type", F.lit("isolation_forest"))

    vec = N.vector(settings.features)
    model = N.LocalOutlierFactor(fitted.select(key, vec.alias("vec")), "vec", key, settings.neighbors)
    border = model.threshold(settings.contamination)
    novel = model.score(test.select(key, vec.alias("vec")), "vec", key)
    joined = materialize(test.select(key, "label").join(novel, key), "scored")
    named = joined.withColumnRenamed("lof", "score")
    judged = named.withColumn("prediction", (F.col("score") > border).cast("int"))
    empty = F.lit(None).cast("double")
    second = FO.evaluate(judged).withColumns(
        {
            "latency_p50_ms": empty,
            "latency_p95_ms": empty,
            "latency_p99_ms": empty,
            "model_type": F.lit("lof"),
        }
    )
    runs = first.unionByName(second)
    stamp = F.date_format(started, "yyyyMMddHHmmss")
    return runs.withColumns(
        {"run_id": F.concat_ws("-", "model_type", stamp), "start_time": started}
    )


def decide(
    runs: DataFrame, production: DataFrame | None = None, **thresholds: float
) -> DataFrame:
    """The best run with its failures and whether it may go to production."""
    before = F.lit(None).cast("double")
    if production is not None:
        newest = production.orderBy(F.desc("start_time")).limit(1)
        before = newest.select("f1").scalar()
    return RU.promotion_gate(RU.best_run(runs), before, **thresholds)
