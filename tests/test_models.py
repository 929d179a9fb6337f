"""Detectors, neighbours, metrics, drift and the model loop against plain numpy."""

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from goldseam.operators import features as FE
from goldseam.operators import forest as FO
from goldseam.operators import metrics as M
from goldseam.operators import neighbors as N
from goldseam.operators import runs as RU
from goldseam.plans import modeling
from goldseam.schemas import MODEL_FEATURES


@pytest.fixture(scope="module")
def cloud(spark):
    """400 normal points and 10 far ones."""
    rng = np.random.default_rng(3)
    values = np.vstack([rng.normal(0, 1, (400, 3)), rng.normal(8, 1, (10, 3))])
    rows = [(i, *map(float, v), int(i >= 400)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, label int")


def test_forest_shape_and_ranking(cloud):
    nodes, seen = FO.fit_forest(cloud, ["a", "b", "c"], "id", trees=50)
    assert seen == 256
    leaves = nodes.filter("feature < 0").groupBy("tree").agg(F.sum("size").alias("n"), F.max("depth").alias("d"))
    rows = leaves.collect()
    assert len(rows) == 50
    assert all(r["n"] <= 256 and r["d"] <= 8 for r in rows)
    forest = FO.Forest.collect(nodes, ["a", "b", "c"], seen)
    scored = cloud.withColumn("score", FO.score_column(forest))
    assert M.roc_auc(scored).first()["auc_roc"] > 0.99
    ends = scored.agg(F.min("score"), F.max("score")).first()
    assert 0 < ends[0] < ends[1] < 1
    limit = FO.threshold_of(scored, "score", 0.05)
    share = scored.filter(FO.predict_column("score", limit) == -1).count() / 410
    assert share == pytest.approx(0.05, abs=0.01)


def test_forest_is_repeatable(cloud):
    def rows():
        nodes, _ = FO.fit_forest(cloud, ["a", "b", "c"], "id", trees=5)
        return sorted(map(tuple, nodes.collect()))

    assert rows() == rows()


@pytest.mark.parametrize("trees, samples", [(4, 20), (40, 20), (4, 300)])
def test_every_tree_gets_its_rows_at_any_size(cloud, trees, samples):
    drawn = FO.sample_per_tree(cloud.select("id", "a"), "id", trees, samples, 410, 1)
    sizes = [r["count"] for r in drawn.groupBy("tree").count().collect()]
    assert sizes == [samples] * trees
    assert drawn.groupBy("tree", "id").count().filter("count > 1").count() == 0


def test_oversized_node_table_is_refused(spark):
    nodes = spark.createDataFrame([(0, i, -1, 0.0, -1, -1, 1, 0) for i in range(9)], FO.NODE_DDL)
    with pytest.raises(ValueError):
        FO.Forest.collect(nodes, ["a"], 2, trees=2)


def brute_lof(train, rows, k, same):
    """Local outlier factor of ``rows`` (the training rows themselves if ``same``)."""

    def nearest(points, skip):
        d = np.sqrt(((points[:, None] - train[None]) ** 2).sum(-1))
        if skip:
            np.fill_diagonal(d, np.inf)
        order = np.argsort(d, axis=1, kind="stable")[:, :k]
        return order, np.take_along_axis(d, order, 1)

    order, dist = nearest(train, True)
    kdist = dist[:, -1]
    lrd = 1 / (np.maximum(kdist[order], dist).mean(1) + 1e-10)
    if same:
        return lrd[order].mean(1) / lrd
    o, d = nearest(rows, False)
    own = 1 / (np.maximum(kdist[o], d).mean(1) + 1e-10)
    return lrd[o].mean(1) / own


@pytest.mark.parametrize("copies", [0, 150])
def test_lof_matches_brute_force(spark, copies, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(5)
    values = np.vstack([rng.normal(0, 1, (200, 2)), rng.normal(6, 0.2, (100, 2)), np.full((copies, 2), 2.5)])
    fresh = rng.normal(1, 3, (60, 2))
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "id long, v array<double>")
    other = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(fresh)], "id long, v array<double>")
    model = N.LocalOutlierFactor(frame, "v", "id", 20)
    got = {r["id"]: r["lof"] for r in model.train_scores().collect()}
    want = brute_lof(values, values, 20, True)
    assert len(got) == len(values)
    assert np.allclose([got[i] for i in range(300)], want[:300], rtol=1e-6)
    for i in range(300, 300 + copies):
        assert got[i] == pytest.approx(1.0)
    new = {r["id"]: r["lof"] for r in model.score(other, "v", "id").collect()}
    assert np.allclose([new[i] for i in range(60)], brute_lof(values, fresh, 20, False), rtol=1e-6)


def test_lof_of_long_vectors_writes_no_row_per_query_and_cell(spark, monkeypatch):
    written, real = [], N.materialize

    def counted(df, label="cut"):
        out = real(df, label)
        written.append(out.count())
        return out

    monkeypatch.setattr(N, "materialize", counted)
    values = np.random.default_rng(7).normal(0, 1, (900, 32))
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "id long, v array<double>")
    got = {r["id"]: r["lof"] for r in N.LocalOutlierFactor(frame, "v", "id", 5).train_scores().collect()}
    assert np.allclose([got[i] for i in range(900)], brute_lof(values, values, 5, True), rtol=1e-6)
    assert max(written) <= 900 * 5


def test_novelty_of_long_vectors_writes_no_row_per_query_and_cell(spark, monkeypatch):
    written, real = [], N.materialize

    def counted(df, label="cut"):
        out = real(df, label)
        written.append(out.count())
        return out

    rng = np.random.default_rng(8)
    values, fresh = rng.normal(0, 1, (400, 24)), rng.normal(1e4, 1, (300, 24))
    rows = [[(f"k{i:03d}", [float(x) for x in v]) for i, v in enumerate(part)] for part in (values, fresh)]
    old, new = (spark.createDataFrame(part, "id string, v array<double>") for part in rows)
    model = N.LocalOutlierFactor(old, "v", "id", 5)
    monkeypatch.setattr(N, "materialize", counted)
    got = {r["id"]: r["lof"] for r in model.score(new, "v", "id").collect()}
    assert np.allclose([got[f"k{i:03d}"] for i in range(300)], brute_lof(values, fresh, 5, False), rtol=1e-6)
    assert max(written) <= 300 * 5


def test_novelty_searches_once_for_each_set_of_rows(spark, monkeypatch):
    searches, real = {}, N.materialize

    def counted(df, label="cut"):
        searches[label] = df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
        return real(df, label)

    monkeypatch.setattr(N, "materialize", counted)
    rng = np.random.default_rng(9)
    values, fresh = rng.normal(0, 1, (200, 4)), rng.normal(0, 2, (50, 4))
    values[0], values[1], fresh[0], fresh[1] = 0.0, -0.0, -0.0, 0.0
    old, new = (
        spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(part)] + [(None, None)], "id long, v array<double>")
        for part in (values, fresh)
    )
    model = N.LocalOutlierFactor(old, "v", "id", 5)
    trained = {r["id"]: r["lof"] for r in model.train_scores().collect()}
    assert np.allclose([trained[i] for i in range(200)], brute_lof(values, values, 5, True), rtol=1e-6)
    got = model.score(new, "v", "id")
    assert "Aggregate [v" not in got._jdf.queryExecution().optimizedPlan().toString()
    got = {r["id"]: r["lof"] for r in got.collect()}
    assert np.allclose([got[i] for i in range(50)], brute_lof(values, fresh, 5, False), rtol=1e-6)
    assert searches["neighbors"] == searches["novel"] == 1


def test_neighbours_with_equal_distances_and_vectors_without_numbers(spark):
    grid = [[float(x), float(y), 0.0] for x in range(12) for y in range(12)]
    odd = [None, [float("nan"), 0.0, 0.0], [float("inf"), 1.0, 1.0], [None, 1.0, 1.0]]
    points = spark.createDataFrame([(i, v, 1) for i, v in enumerate(grid + odd)], "pid long, vec array<double>, w long")
    found = N.nearest_neighbors(points.selectExpr("pid as qid", "vec"), N.Cells(points, 7), exclude_self=True)
    got = {(r["qid"], r["place"]): r["pid"] for r in found.collect()}
    values = np.array(grid)
    d = ((values[:, None] - values[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1, kind="stable")[:, :7]
    assert got == {(q, n + 1): p for q, row in enumerate(want.tolist()) for n, p in enumerate(row)}


def psi(expected, actual, buckets=10):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, buckets + 1)))
    if len(edges) < 2:
        return 0.0
    e = np.histogram(expected, edges)[0] / len(expected)
    a = np.histogram(actual, edges)[0] / len(actual)
    e, a = np.where(e == 0, 1e-6, e), np.where(a == 0, 1e-6, a)
    return float(((a - e) * np.log(a / e)).sum())


def test_drift(spark, plan):
    rng = np.random.default_rng(1)
    first = {"same": rng.normal(0, 1, 500), "moved": rng.normal(0, 1, 500), "flat": np.zeros(500)}
    second = {"same": rng.normal(0, 1, 400), "moved": rng.normal(2, 1, 400), "flat": np.zeros(400)}

    def frame(parts):
        rows = [(n, float(v)) for n, values in parts.items() for v in values]
        return spark.createDataFrame(rows, "feature string, value double")

    got = {r["feature"]: r for r in M.drift(frame(first), frame(second), ["feature"], "value").collect()}
    for name in first:
        assert got[name]["psi"] == pytest.approx(psi(first[name], second[name]))
    assert got["moved"]["drifted"] and not got["same"]["drifted"] and got["flat"]["psi"] == 0.0


def test_confusion_and_single_class(spark):
    none = spark.createDataFrame([(0, 0, 0.1)], "label int, prediction int, score double")
    row = M.confusion(none).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert M.roc_auc(none).first()["auc_roc"] == 0.0


def test_histogram_quantile(spark):
    values = [(float(v),) for v in [1, 2, 3, 4, 20, 30, 2000]]
    buckets = M.bucket_counts(spark.createDataFrame(values, "v double"), "v", [5, 50, 1000])
    assert [r["cum_count"] for r in buckets.collect()] == [4, 6, 6, 7]
    assert M.bucket_quantile(buckets, 0.5).first()["value"] == pytest.approx(4.375)
    assert M.bucket_quantile(buckets, 0.99).first()["value"] == 1000.0


def test_gate_and_best(spark):
    rows = [("a", 0.9, 20.0, 0.85, 0.8), ("b", 0.95, 90.0, 0.7, 0.9), ("c", None, None, None, None)]
    runs = spark.createDataFrame(rows, "run_id string, f1 double, latency_p95_ms double, precision double, recall double")
    got = {r["run_id"]: r["failures"] for r in RU.promotion_gate(runs, F.lit(0.92)).collect()}
    assert got == {"a": "production", "b": "latency_p95,precision", "c": "f1,latency_p95,precision,production"}
    first = RU.promotion_gate(runs, F.lit(None).cast("double")).filter("promoted").collect()
    assert [r["run_id"] for r in first] == ["a"]
    assert RU.best_run(runs).first()["run_id"] == "a"


def test_standardize(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(map(tuple, FE.standardize(df, ["a", "b"]).collect())) == [(-1.0, 0.0), (1.0, 0.0)]


def test_split_sizes(spark):
    df = spark.range(1000).withColumn("ts", F.col("id"))
    got = {r["split"]: r["count"] for r in M.chronological_split(df, ["ts"]).groupBy("split").count().collect()}
    assert got == {"train": 700, "validation": 150, "test": 150}


def test_model_loop(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        odd = i % 20 == 7
        amount = float(rng.normal(9_000 if odd else 1_000, 200))
        rows.append((i, datetime(2024, 1, 1 + i // 24, i % 24), amount, float(rng.integers(0, 24)), odd))
    df = spark.createDataFrame(rows, "id long, ts timestamp, amount_brl double, hour_of_day double, is_anomaly boolean")
    settings = modeling.Settings(trees=30)
    runs = modeling.train(df, "id", "ts", F.lit(datetime(2024, 2, 1)), settings)
    got = {r["model_type"]: r for r in runs.collect()}
    assert set(got) == {"isolation_forest", "lof"}
    for row in got.values():
        for name in ("precision", "recall", "f1", "auc_roc"):
            assert 0.0 <= row[name] <= 1.0
    assert got["isolation_forest"]["auc_roc"] > 0.9
    verdict = modeling.decide(runs, min_f1=0.0, min_precision=0.0).first()
    assert verdict["promoted"] in (True, False)
    assert list(MODEL_FEATURES)[0] in modeling.prepare(df, "id", "ts").columns


def test_permutation_importance_finds_the_feature(cloud):
    noisy = cloud.withColumns({"b": F.rand(1), "c": F.rand(2)})
    nodes, seen = FO.fit_forest(noisy, ["a", "b", "c"], "id", trees=40)
    forest = FO.Forest.collect(nodes, ["a", "b", "c"], seen)
    limit = FO.threshold_of(noisy.select(FO.score_column(forest).alias("s")), "s", 0.03)
    got = {r["feature"]: r["importance"] for r in FO.permutation_importance(noisy, forest, "id", limit, repeats=2).collect()}
    assert max(got, key=got.get) == "a"


def test_permutation_importance_of_all_rows_in_slots(cloud):
    noisy = cloud.withColumns({"b": F.rand(1), "c": F.lit(1.0)})
    nodes, seen = FO.fit_forest(noisy, ["a", "b", "c"], "id", trees=40)
    forest = FO.Forest.collect(nodes, ["a", "b", "c"], seen)
    limit = FO.threshold_of(noisy.select(FO.score_column(forest).alias("s")), "s", 0.03)
    rows = FO.permutation_importance(noisy, forest, "id", limit, repeats=2, slot_rows=50).collect()
    got = {r["feature"]: r for r in rows}
    assert set(got) == {"a", "b", "c"}
    assert max(got, key=lambda n: got[n]["importance"]) == "a"
    assert got["c"]["importance"] == 0.0 and got["c"]["importance_std"] == 0.0
