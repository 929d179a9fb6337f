"""Both plans of the ordered operators against brute force, with one key holding most rows."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from goldseam.operators import features as FE
from goldseam.operators import joins as J
from goldseam.operators import metrics as M
from goldseam.operators import monitoring as MO
from goldseam.operators import ordered as O

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def data():
    """600 rows: key 'hot' has most of them, many at the very same time; some keys have one."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        key = "hot" if i % 10 < 7 else f"k{rng.randint(0, 40)}"
        minutes = 500 if i % 5 == 0 else rng.randint(0, 60 * 24 * 9)
        value = round(rng.random() * 100, 2)
        rows.append((i, key, START + timedelta(minutes=minutes), value, rng.choice("abcde")))
    return pd.DataFrame(rows, columns=["id", "key", "ts", "value", "item"])


@pytest.fixture(scope="module")
def frame(spark, data):
    df = spark.createDataFrame(data).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return df.withColumn("value", F.col("value").cast("decimal(10,2)"))


def ordered(data):
    return data.sort_values(["key", "ts", "id"])


@pytest.mark.parametrize("reach", [1, 5, 200])
def test_rolling_looks_back_over_chunks(frame, data, plan, reach):
    def compute(rows, window):
        frame_ = window.rowsBetween(-reach, 0)
        return rows.withColumns(
            {"s": F.sum("value").over(frame_), "n": F.count("value").over(frame_)}
        )

    got = O.rolling(frame, ["key"], ["ts", "id"], reach, compute).toPandas().set_index("id")
    assert list(got.columns) == ["key", "ts", "value", "item", "s", "n"]
    rows = ordered(data)
    want = rows.groupby("key")["value"].rolling(reach + 1, min_periods=1).sum().to_numpy()
    have = got.loc[rows["id"], "s"].astype(float).to_numpy()
    assert np.allclose(have, want)
    assert len(got) == len(data)


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("include", [True, False])
def test_running_sums(frame, data, plan, keys, include):
    got = O.running_sums(frame, keys, ["ts", "id"], {"c": "value"}, include).toPandas()
    got = got.set_index("id")["c"].astype(float)
    rows = ordered(data) if keys else data.sort_values(["ts", "id"])
    want = rows.groupby("key")["value"].cumsum() if keys else rows["value"].cumsum()
    if not include:
        want = want - rows["value"]
    assert np.allclose(got.loc[rows["id"]].to_numpy(), want.to_numpy())


def test_running_sums_descending(frame, data, plan):
    got = O.running_sums(frame, [], ["-ts", "-id"], {"c": "value"}).toPandas().set_index("id")
    rows = data.sort_values(["ts", "id"], ascending=False)
    assert np.allclose(got.loc[rows["id"], "c"].astype(float), rows["value"].cumsum())


def test_running_last(frame, data, plan):
    sparse = frame.withColumn("seen", F.when(F.col("id") % 9 == 0, F.col("id")))
    got = O.running_last(sparse, ["key"], ["ts", "id"], "seen", "last").toPandas().set_index("id")
    rows = ordered(data).assign(seen=lambda d: d["id"].where(d["id"] % 9 == 0))
    want = rows.groupby("key")["seen"].ffill()
    pd.testing.assert_series_equal(
        got.loc[rows["id"], "last"].astype(float).reset_index(drop=True),
        want.astype(float).reset_index(drop=True),
        check_names=False,
    )


def test_row_at(frame, data, plan):
    got = {r["_at"]: r["id"] for r in O.row_at(frame, ["ts", "id"], {"a": 1, "b": 420, "c": 600}).collect()}
    rows = data.sort_values(["ts", "id"])["id"].to_list()
    assert got == {"a": rows[0], "b": rows[419], "c": rows[599]}


@pytest.mark.parametrize("keys", [["key"], []])
def test_exact_quantiles(frame, data, plan, keys):
    wanted = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = O.exact_quantiles(frame, keys, "value", wanted).toPandas()
    if keys:
        for key, values in data.groupby("key")["value"]:
            have = got.loc[got["key"] == key, "quantiles"].iloc[0]
            assert np.allclose(have, np.quantile(values, wanted))
    else:
        assert np.allclose(got["quantiles"].iloc[0], np.quantile(data["value"], wanted))


@pytest.mark.parametrize("hours,cells", [(1, 1), (24, 24), (24, 1), (30, 7)])
def test_span_totals(frame, data, plan, hours, cells):
    got = O.span_totals(frame, ["key"], "ts", hours * 3600, "value", ("n", "s"), cells).toPandas()
    assert len(got) == len(data.drop_duplicates(["key", "ts"]))
    for row in got.itertuples():
        inside = data[
            (data["key"] == row.key)
            & (data["ts"] <= row.ts)
            & (data["ts"] >= row.ts - timedelta(hours=hours))
        ]
        assert row.n == len(inside)
        assert float(row.s) == pytest.approx(inside["value"].sum())


def test_distinct_over_span(frame, data, plan):
    got = FE.distinct_over_span(frame, "key", "ts", "item", 7 * 86_400, "n").toPandas()
    for row in got.itertuples():
        inside = data[
            (data["key"] == row.key)
            & (data["ts"] <= row.ts)
            & (data["ts"] >= row.ts - timedelta(days=7))
        ]
        assert row.n == inside["item"].nunique()


def test_as_of_join_with_hot_key(frame, data, plan):
    left = frame.filter("id % 2 = 0").select("id", "key", "ts")
    right = frame.filter("id % 2 = 1").select("key", F.col("ts").alias("fts"), F.col("id").alias("fid"))
    got = J.as_of_join(left, right, ["key"], "ts", "fts", ["fid"], 86_400, ["fid"], ["id"])
    got = got.toPandas().set_index("id")
    assert len(got) == (data["id"] % 2 == 0).sum()
    odd = data[data["id"] % 2 == 1]
    for row in data[data["id"] % 2 == 0].itertuples():
        known = odd[(odd["key"] == row.key) & (odd["ts"] <= row.ts)]
        known = known[known["ts"] == known["ts"].max()]
        if len(known) and row.ts - known["ts"].iloc[0] <= timedelta(days=1):
            assert got.loc[row.id, "fts"] == known["ts"].iloc[0]
            assert got.loc[row.id, "fid"] in known["id"].to_list()
        else:
            assert pd.isna(got.loc[row.id, "fid"])


def test_history_zscore(frame, data, plan):
    got = FE.history_zscore(frame, "key", "ts", "value", "id").toPandas().set_index("id")
    rows = ordered(data)
    for _, group in rows.groupby("key"):
        values = group["value"].to_numpy()
        for i, number in enumerate(group["id"]):
            z = got.loc[number, "z_score"]
            spread = values[:i].std(ddof=1) if i >= 2 else 0.0
            if i < 2 or spread == 0:
                assert pd.isna(z)
            else:
                assert z == pytest.approx((values[i] - values[:i].mean()) / spread)


def test_rate_changes(frame, data, plan):
    got = FE.rate_changes(frame, "key", "ts", "value", "id").toPandas().set_index("id")
    for _, group in ordered(data).groupby("key"):
        changes = []
        values = group["value"].to_list()
        for i, number in enumerate(group["id"]):
            if i > 0:
                changes.append((values[i] - values[i - 1]) / values[i - 1] * 100)
            recent = changes[-20:] if i >= 20 else changes
            flag = False
            if len(recent) >= 5:
                spread = np.std(recent, ddof=1)
                flag = spread > 0 and abs(changes[-1] - np.mean(recent)) > 2 * spread
            assert bool(got.loc[number, "is_anomaly"]) == flag


def test_curves_agree(spark, frame, data, plan):
    rows = frame.select((F.col("item") == "a").cast("int").alias("label"), F.floor("value").alias("score"))
    labels, scores = (data["item"] == "a").to_numpy(), np.floor(data["value"].to_numpy())
    wins = [
        (p > n) + 0.5 * (p == n) for p in scores[labels] for n in scores[~labels]
    ]
    assert M.roc_auc(rows).first()["auc_roc"] == pytest.approx(np.mean(wins))
    curve = M.pr_curve(rows).toPandas()
    for row in curve.itertuples():
        assert row.tp == (labels & (scores >= row.threshold)).sum()
        assert row.fp == (~labels & (scores >= row.threshold)).sum()


def test_chronological_split(frame, data, plan):
    got = M.chronological_split(frame, ["ts", "id"]).toPandas().set_index("id")["split"]
    rows = data.sort_values(["ts", "id"])["id"].to_list()
    assert (got.loc[rows[:420]] == "train").all()
    assert (got.loc[rows[420:510]] == "validation").all()
    assert (got.loc[rows[510:]] == "test").all()


def test_ingestion_gaps(frame, data):
    got = MO.ingestion_gaps(frame, "ts", 3_600).toPandas()
    times = sorted(data["ts"])
    want = [(a, b) for a, b in zip(times, times[1:]) if b - a > timedelta(hours=1)]
    assert sorted(zip(got["gap_start"], got["gap_end"])) == want


def test_pattern_features(frame, data, plan):
    got = FE.pattern_features(frame, "key", "ts", "value", "item").toPandas()
    assert len(got) == len(data.drop_duplicates(["key", "ts"]))
    for row in got.sample(60, random_state=1).itertuples():
        mine = data[(data["key"] == row.key) & (data["ts"] <= row.event_timestamp)]
        hour = mine[mine["ts"] >= row.event_timestamp - timedelta(hours=1)]
        day = mine[mine["ts"] >= row.event_timestamp - timedelta(days=1)]
        week = mine[mine["ts"] >= row.event_timestamp - timedelta(days=7)]
        assert row.transactions_last_1h == len(hour)
        assert row.avg_amount_last_24h == pytest.approx(day["value"].mean())
        assert row.distinct_currencies_last_7d == week["item"].nunique()
        assert row.night_transaction_ratio == pytest.approx((mine["ts"].dt.hour < 6).mean())


def test_profile_numeric(frame, data, plan):
    from goldseam.operators import quality as Q

    got = Q.profile_numeric(frame, ["id", "value"]).toPandas().set_index("column_name")
    for name in ("id", "value"):
        assert got.loc[name, "p25"] == pytest.approx(data[name].quantile(0.25))
        assert got.loc[name, "p75"] == pytest.approx(data[name].quantile(0.75))
        assert got.loc[name, "stddev"] == pytest.approx(data[name].std())


def test_volume_rank(spark, plan):
    from goldseam.operators import gold as G

    rows = [("a", 5), ("b", 7), ("c", 5), ("d", 1), ("e", 9)]
    frame_ = spark.createDataFrame(rows, "user_id string, total_volume_brl long")
    got = {r["user_id"]: (r["volume_rank"], r["dense_rank"]) for r in G.volume_rank(frame_).collect()}
    assert got == {"e": (1, 1), "b": (2, 2), "a": (3, 3), "c": (3, 3), "d": (5, 4)}


def test_null_keys_and_early_times_are_kept(spark, plan):
    start = datetime(1969, 12, 31, 20)
    rows = [(i, None if i % 2 else "a", start + timedelta(minutes=20 * i), i, "xy"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, key string, ts timestamp, value int, item string")
    got = O.span_totals(df, ["key"], "ts", 7_200, "value", ("n", "s"), 2).toPandas()
    assert len(got) == 60
    assert sorted(got["n"]) == sorted([min(i // 2 + 1, 4) for i in range(60)])
    assert len(FE.pattern_features(df, "key", "ts", "value", "item").collect()) == 60
    medians = {r["key"]: r["quantiles"][0] for r in O.exact_quantiles(df, ["key"], "value", [0.5]).collect()}
    assert medians == {"a": 29.0, None: 30.0}
    last = O.running_last(df.withColumn("v", F.when(F.col("id") < 2, F.col("id"))), ["key"], ["ts"], "v", "last")
    assert {(r["key"], r["last"]) for r in last.collect()} == {("a", 0), (None, 1)}


def test_full_cells_are_split(frame, data, spark, monkeypatch):
    monkeypatch.setattr(O, "GROUP_ROWS", 3)
    spark.conf.set("goldseam.maxGroupRows", "0")
    try:
        got = O.span_totals(frame, ["key"], "ts", 30 * 3600, "value", ("n", "s"), 7).toPandas()
    finally:
        spark.conf.unset("goldseam.maxGroupRows")
    assert len(got) == len(data.drop_duplicates(["key", "ts"]))
    for row in got.itertuples():
        inside = data[
            (data["key"] == row.key)
            & (data["ts"] <= row.ts)
            & (data["ts"] >= row.ts - timedelta(hours=30))
        ]
        assert row.n == len(inside)


def test_null_items_and_values(spark, plan):
    """Null items, values and times give the same rows and types under both plans."""
    from goldseam.operators import features, ordered

    rows = [("a", f"2024-01-01 0{h}:00:00", None if h % 2 else "USD", None if h < 3 else 1.25) for h in range(6)]
    rows += [(None, "2024-01-01 05:00:00", "EUR", 2.0), ("b", "2024-01-02 00:00:00", None, None)]
    df = spark.createDataFrame(rows, "k string, t string, c string, v double").selectExpr(
        "k", "CAST(t AS timestamp) AS t", "c", "v", "CAST(v AS decimal(10,2)) AS d"
    )
    kinds = features.distinct_over_span(df, "k", "t", "c", 3600, "n")
    got = sorted(((r.k, r.t.hour, r.n) for r in kinds.collect()), key=repr)
    want = [("a", h, 1) for h in range(6)] + [(None, 5, 1), ("b", 0, 0)]
    assert got == sorted(want, key=repr)
    totals = ordered.span_totals(df, ["k"], "t", 3600, "v", ("n", "s"), cells=1)
    sums = {(r.k, r.t.hour): (r.n, r.s) for r in totals.collect()}
    assert sums["a", 1] == (0, None) and sums["a", 3] == (1, 1.25) and sums["b", 0] == (0, None)
    running = ordered.running_sums(df, ["k"], ["t"], {"s": "d"})
    assert running.schema["s"].dataType.simpleString() == "decimal(20,2)"


def test_split_with_null_times(spark, plan):
    rows = [(i, None if i < 5 else f"2024-01-01 0{i}:00:00") for i in range(10)]
    df = spark.createDataFrame(rows, "id long, t string").selectExpr("id", "CAST(t AS timestamp) AS t")
    got = {r.id: r.split for r in M.chronological_split(df, ["t", "id"]).collect()}
    assert [got[i] for i in range(10)] == ["train"] * 7 + ["validation"] + ["test"] * 2
    down = {r.id: r.split for r in M.chronological_split(df, ["-t", "id"]).collect()}
    assert [i for i in range(10) if down[i] == "train"] == [0, 1, 5, 6, 7, 8, 9]


def test_refresh_of_an_empty_store(spark):
    from goldseam.operators import features

    rows = spark.sql("SELECT 'u' AS k, timestamp'2024-01-01' AS t, 1 AS x")
    got = features.refresh_online(rows.where("false"), rows, ["k"], "t", F.lit("2025-01-01").cast("timestamp"))
    assert got.count() == 1


@pytest.mark.parametrize("listed", [20_000, 60, 4])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_selection_of_quantiles(spark, monkeypatch, listed, keys):
    """Bounds are moved together until few values are left, also around ties and far apart values."""
    import numpy as np

    monkeypatch.setattr(O, "LISTED", listed)
    rng = np.random.default_rng(listed)
    heavy = [5.0] * 3000 + list(rng.normal(5, 1e-9, 500)) + [float("-inf"), float("inf")]
    wide = list(10.0 ** rng.integers(-300, 300, 2000) * rng.choice([-1.0, 1.0], 2000))
    rows = [("a", float(v), -float(v)) for v in heavy + wide] + [(None, float(i), None) for i in range(7)] + [("one", 2.5, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "k string, v double, w double").repartition(5)
    wanted = [0.0, 0.01, 0.25, 0.5, 0.731, 0.99, 1.0]
    got = O.select_quantiles(df, keys, ["v", "w"], wanted).collect()
    plain = df.groupBy(*keys).agg(*[F.percentile(c, F.array(*[F.lit(p) for p in wanted])).alias(c) for c in "vw"])
    want = {r["k"] if keys else 0: r for r in plain.collect()}
    assert len(got) == len(want)
    for r in got:
        expected = want[r["k"] if keys else 0]
        for column, have in (("v", r["q_0"]), ("w", r["q_1"])):
            assert have == (expected[column] or [None] * len(wanted)), (r, expected)
