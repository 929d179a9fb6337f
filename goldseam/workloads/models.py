"""Detector, neighbour and model-metric queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam import schemas as S
from goldseam.functions import columns as X
from goldseam.operators import features as FE
from goldseam.operators import forest as FO
from goldseam.operators import neighbors as N
from goldseam.session import materialize
from goldseam.sources import outputs as OUT
from goldseam.workloads.binding import TX_SQL, r6, transactions
from goldseam.workloads.checks import _LABELLED_SQL, labelled
from goldseam.workloads.features import model_matrix
from goldseam.workloads.registry import query, table

FEATURES = ["value", "hour"]

# Two hand-written trees over (value, hour): tree, node, feature, threshold, left, right, size, depth.
FIXED_NODES = [
    (0, 0, 0, 20.0, 1, 2, 8, 0),
    (0, 1, 1, 6.0, 3, 4, 6, 1),
    (0, 2, -1, 0.0, -1, -1, 2, 1),
    (0, 3, -1, 0.0, -1, -1, 1, 2),
    (0, 4, -1, 0.0, -1, -1, 5, 2),
    (1, 0, 1, 18.0, 1, 2, 8, 0),
    (1, 1, 0, 5.0, 3, 4, 7, 1),
    (1, 2, -1, 0.0, -1, -1, 1, 1),
    (1, 3, -1, 0.0, -1, -1, 4, 2),
    (1, 4, -1, 0.0, -1, -1, 3, 2),
]
_NODES_SQL = ", ".join(str(n) for n in FIXED_NODES)
_PATH_SQL = (
    "case when size <= 1 then 0.0 when size = 2 then 1.0 else 2 * (ln(size - 1.0) + 0.5772156649015329) "
    "- 2 * (size - 1.0) / size end"
)


def points(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "value", F.hour("ts").cast("double").alias("hour"), "event_type"
    )


@query(
    "iforest_score",
    f"""with recursive n(tree, node, feature, threshold, l, r, size, depth) as (values {_NODES_SQL}),
      w as (select event_id, value, cast(hour(ts) as double) as hour, t.tree, 0 as node from events,
          (values (0), (1)) t(tree)
        union all select event_id, value, hour, w.tree,
          case when (case when feature = 0 then value else hour end) <= threshold then l else r end
        from w join n on n.tree = w.tree and n.node = w.node where feature >= 0),
      p as (select event_id, avg(depth + {_PATH_SQL}) as path from w join n on n.tree = w.tree and n.node = w.node
        where feature < 0 group by event_id)
    select event_id, round(power(2, -path / (2 * (ln(7.0) + 0.5772156649015329) - 2 * 7.0 / 8)), 6) as score from p""",
)
def iforest_score(spark: SparkSession, folder: str) -> DataFrame:
    """Scores from a hand-written forest."""
    nodes = spark.createDataFrame(FIXED_NODES, FO.NODE_DDL)
    forest = FO.Forest.collect(nodes, FEATURES, 8, 2)
    return points(spark, folder).select("event_id", r6(FO.score_column(forest)).alias("score"))


@query(
    "iforest_nodes",
    """select cast(i as int) as tree, least(256, (select count(*) from events)) as rows, true as bounded
    from range(100) t(i)""",
)
def iforest_nodes(spark: SparkSession, folder: str) -> DataFrame:
    """Each tree fitted on the model matrix: rows seen, and whether its size is in bounds."""
    nodes, _ = FO.fit_forest(model_matrix(spark, folder), S.MODEL_FEATURES, "transaction_id")
    trees = nodes.groupBy("tree").agg(
        F.count(F.lit(1)).alias("nodes"),
        F.max("depth").alias("depth"),
        F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("rows"),
    )
    bounded = (F.col("nodes") <= 2 * F.col("rows") - 1) & (F.col("depth") <= 8)
    return trees.select("tree", "rows", bounded.alias("bounded"))


def fitted(spark: SparkSession, folder: str) -> tuple[DataFrame, FO.Forest]:
    """The standardised matrix and a forest fitted on it."""
    matrix = FE.standardize(model_matrix(spark, folder), S.MODEL_FEATURES)
    nodes, rows = FO.fit_forest(matrix, S.MODEL_FEATURES, "transaction_id")
    return matrix, FO.Forest.collect(nodes, S.MODEL_FEATURES, rows)


@query("iforest_anomalies")
def iforest_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    """Score, prediction and risk of every row from a fitted forest."""
    matrix, forest = fitted(spark, folder)
    scored = materialize(matrix.select("transaction_id", FO.score_column(forest).alias("score")), "scores")
    limit = FO.threshold_of(scored, "score", 0.05)
    return scored.withColumns(
        {
            "prediction": FO.predict_column("score", limit),
            "risk_level": X.risk_level(X.clip(F.col("score") / 0.5, 0.0, 1.0)),
        }
    )


@query("permutation_importance")
def permutation_importance(spark: SparkSession, folder: str) -> DataFrame:
    matrix, forest = fitted(spark, folder)
    scored = matrix.select("transaction_id", FO.score_column(forest).alias("score"))
    limit = FO.threshold_of(scored, "score", 0.05)
    return FO.permutation_importance(matrix, forest, "transaction_id", limit)


_KNN = """d as (select a.vec_id as q, b.vec_id as p, list_distance(a.e, b.e) as dist from x a, x b where a.vec_id <> b.vec_id),
  k as (select * from d qualify row_number() over (partition by q order by dist, p) <= 20),
  kd as (select q, max(dist) as kdist from k group by q),
  lrd as (select k.q, 1 / (avg(greatest(kd.kdist, k.dist)) + 1e-10) as lrd from k join kd on kd.q = k.p group by k.q)"""


@query(
    "lof_scores",
    f"""with x as (select vec_id, cast(embedding as double[]) as e from embeddings), {_KNN}
    select k.q as vec_id, round(avg(o.lrd) / any_value(s.lrd), 6) as lof from k join lrd o on o.q = k.p
    join lrd s on s.q = k.q group by k.q""",
)
def lof_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Outlier factor of every embedding among all of them."""
    rows = table(spark, folder, "embeddings")
    return N.LocalOutlierFactor(rows, "embedding", "vec_id", 20).train_scores().withColumn("lof", r6("lof"))


@query(
    "lof_novelty",
    """with x as (select vec_id, cast(embedding as double[]) as e, label from embeddings),
    d as (select a.vec_id as q, a.label as ql, b.vec_id as p, list_distance(a.e, b.e) as dist from x a, x b where a.vec_id <> b.vec_id and b.label % 2 = 0),
    k as (select * from d qualify row_number() over (partition by q order by dist, p) <= 20),
    kd as (select q, max(dist) as kdist from k where ql % 2 = 0 group by q),
    lrd as (select k.q, 1 / (avg(greatest(kd.kdist, k.dist)) + 1e-10) as lrd from k join kd on kd.q = k.p group by k.q)
    select k.q as vec_id, round(avg(o.lrd) / any_value(s.lrd), 6) as lof from k join lrd o on o.q = k.p
    join lrd s on s.q = k.q where k.ql % 2 = 1 group by k.q""",
)
def lof_novelty(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings with an odd label scored against a model fitted on those with an even one."""
    rows = table(spark, folder, "embeddings")
    model = N.LocalOutlierFactor(rows.filter("label % 2 = 0"), "embedding", "vec_id", 20)
    return model.score(rows.filter("label % 2 = 1"), "embedding", "vec_id").withColumn("lof", r6("lof"))


@query(
    "model_metrics",
    f"""with {_LABELLED_SQL}, c as (select count(*) filter (where label = 1 and prediction = 1) as tp,
        count(*) filter (where label = 0 and prediction = 1) as fp,
        count(*) filter (where label = 1 and prediction = 0) as fn from l),
      r as (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as rk from l),
      a as (select (sum(rk) filter (where label = 1) - count(*) filter (where label = 1)
        * (count(*) filter (where label = 1) + 1) / 2.0) / (count(*) filter (where label = 1)
        * count(*) filter (where label = 0)) as auc from r)
    select round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall,
      round(2 * tp / (2 * tp + fp + fn), 6) as f1, round(auc, 6) as auc_roc,
      (select round(quantile_cont(score, 0.5), 6) from l) as latency_p50_ms,
      (select round(quantile_cont(score, 0.95), 6) from l) as latency_p95_ms,
      (select round(quantile_cont(score, 0.99), 6) from l) as latency_p99_ms from c, a""",
)
def model_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled(spark, folder).withColumn("latency", F.col("score"))
    found = FO.evaluate(rows, latency="latency")
    names = ("precision", "recall", "f1", "auc_roc", "latency_p50_ms", "latency_p95_ms", "latency_p99_ms")
    return found.select(*[r6(n).alias(n) for n in names])


@query(
    "prediction_log",
    f"""with {TX_SQL} select transaction_id as key, transaction_id, round(least(value / 100, 1), 6) as anomaly_score,
      value / 100 >= 0.4 as is_anomaly, case when value / 100 >= 0.7 then 'high' when value / 100 >= 0.4 then 'medium'
      else 'low' end as risk_level, round(value, 3) as latency_ms, cast(hour("timestamp") as double) as hour_of_day,
      true as logged from tx""",
)
def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    """Key and JSON record of each prediction."""
    rows = transactions(spark, folder)
    score = X.clip(F.col("value") / 100, 0.0, 1.0)
    vector = FE.serving_vector(
        rows.withColumns(
            {
                "avg_ticket_30d": F.col("value"),
                "avg_amount_last_24h": F.col("value"),
                "transactions_last_1h": F.lit(0),
            }
        )
    )
    judged = vector.withColumns(
        {
            "anomaly_score": score,
            "is_anomaly": X.risk_flag(score),
            "risk_level": X.risk_level(score),
            "model_version": F.lit("1"),
            "latency_ms": F.col("value"),
        }
    )
    records = OUT.prediction_records(judged, S.MODEL_FEATURES)
    fields = (
        "transaction_id string, anomaly_score double, is_anomaly boolean, risk_level string, "
        "latency_ms double, features struct<hour_of_day: double>, logged_at string"
    )
    read = records.select("key", F.from_json("value", fields).alias("v"))
    return read.select(
        "key",
        *[f"v.{n}" for n in ("transaction_id", "anomaly_score", "is_anomaly", "risk_level", "latency_ms")],
        "v.features.hour_of_day",
        F.col("v.logged_at").isNotNull().alias("logged"),
    )
