"""Streams must equal their batch twins, also over restarts and repeated batches."""

import inspect
import json
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldseam.operators import features as FE
from goldseam.session import new_path
from goldseam.sources import inputs as IN
from goldseam.streaming import changes as CH
from goldseam.streaming import ingest as IG
from goldseam.streaming import stateful as ST

GOOD = {
    "transaction_id": "1",
    "user_id": "u",
    "timestamp": "2024-01-15T10:00:00Z",
    "transaction_type": "BUY",
    "currency": "USD",
    "amount_brl": 10.0,
    "amount_foreign": 2.0,
    "exchange_rate": 5.0,
    "spread_pct": 0.5,
}


def land(spark, path, rows, ddl):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)


def test_dead_letters_and_restart(spark):
    source, good, dead, mark = (new_path(spark, n) for n in ("in", "good", "dead", "mark"))
    schema = T.StructType([T.StructField("value", T.StringType())])

    def run():
        stream = IN.file_stream(spark, source, schema)
        IG.run_available(IG.split_sink(stream, good, dead), mark)

    bad = ["not-json", "{broken", "", "null"]
    land(spark, source, [(json.dumps(GOOD),)] + [(t,) for t in bad], "value string")
    run()
    run()
    land(spark, source, [(json.dumps({**GOOD, "transaction_id": "2"}),)], "value string")
    run()
    rows = spark.read.parquet(good)
    assert sorted(r["transaction_id"] for r in rows.collect()) == ["1", "2"]
    assert {"ingestion_timestamp", "source_system", "batch_id"} <= set(rows.columns)
    assert sorted(r["_raw"] for r in spark.read.parquet(dead).collect()) == sorted(bad)


def test_raw_sink_by_event_day(spark):
    source, base, mark = (new_path(spark, n) for n in ("in", "raw", "mark"))
    land(spark, source, [(json.dumps(GOOD),), ("{broken",)], "value string")
    stream = IN.file_stream(spark, source, T.StructType([T.StructField("value", T.StringType())]))
    IG.run_available(IG.json_sink(stream, base), mark)
    assert IN.read_raw(spark, base, "2024-01-15").count() == 1
    assert IN.read_raw(spark, base, "2024-01-16").count() == 0


def test_rate_anomalies_equal_the_batch(spark, plan):
    source, out, state, mark = (new_path(spark, n) for n in ("in", "out", "state", "mark"))
    ddl = "pair string, ts timestamp, rate double, id long"
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(240):
        rate = 5 + (i * 37 % 11) / 100 + (3.0 if i % 53 == 50 else 0.0)
        rows.append(("hot" if i % 4 else f"p{i % 3}", start + timedelta(minutes=i), rate, i))
    schema = spark.createDataFrame(rows[:1], ddl).schema
    for first in range(0, 240, 60):
        land(spark, source, rows[first : first + 60], ddl)
        stream = IN.file_stream(spark, source, schema)
        IG.run_available(ST.rate_anomaly_sink(stream, "pair", "ts", "rate", "id", out, state), mark)
    got = {r["id"]: r["is_anomaly"] for r in spark.read.parquet(out).collect()}
    batch = FE.rate_changes(spark.createDataFrame(rows, ddl), "pair", "ts", "rate", "id")
    want = {r["id"]: r["is_anomaly"] for r in batch.collect()}
    assert got == want and any(want.values())


def rate_rows():
    start = datetime(2024, 1, 1)
    rows = []
    for i in range(300):
        rate = None if i % 41 == 7 else 0.0 if i % 67 == 9 else 5 + (i * 37 % 11) / 100 + (3.0 if i % 53 == 50 else 0.0)
        rows.append(("hot" if i % 4 else f"p{i % 3}", start + timedelta(minutes=i), rate, i))
    return rows


def test_keyed_state_out_of_order_restart_and_late(spark):
    source, out, mark = (new_path(spark, n) for n in ("in", "out", "mark"))
    ddl = "pair string, ts timestamp, rate double, id long"
    rows = rate_rows()
    landing = sorted(rows, key=lambda r: r[3] + r[3] * 7 % 13)  # up to 12 minutes late
    late = [("hot", rows[10][1], 99.0, 1000), ("new", rows[20][1], 1.0, 1001)]
    end = ("none", datetime(2200, 1, 1), 0.0, -1)
    schema = spark.createDataFrame(rows[:1], ddl).schema
    dropped = 0
    for part in (landing[:90], landing[90:200], [], landing[200:] + late, [end]):
        if part:
            land(spark, source, part, ddl)
        flags = ST.rolling_rate_flags(IN.file_stream(spark, source, schema), "pair", "ts", "rate", "id", "20 minutes")
        dropped += ST.late_rows(IG.run_available(ST.append_sink(flags, out), mark))
    got = spark.read.parquet(out).collect()
    batch = FE.rate_changes(spark.createDataFrame(rows, ddl), "pair", "ts", "rate", "id")
    want = {r["id"]: r["is_anomaly"] for r in batch.collect()}
    assert len(got) == len(rows) and {r["id"]: r["is_anomaly"] for r in got} == want and any(want.values())
    assert dropped == len(late)


class Handle:
    """State of one key in memory, with the number of timers and of state entries written."""

    def __init__(self):
        self.timers, self.most, self.entries = [], 0, 0

    def registerTimer(self, at):
        self.timers.append(at)
        self.most = max(self.most, len(self.timers))

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getListState(self, name, schema):
        return self.State(self)

    getValueState = getListState

    def getMapState(self, name, key, value):
        return self.State(self)

    class State:
        def __init__(self, handle):
            self.handle, self.rows, self.map, self.value = handle, [], {}, None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value if self.value is not None else iter(self.rows)

        def update(self, value):
            self.value = value

        def clear(self):
            self.rows, self.value = [], None

        def put(self, rows):
            self.rows = list(rows)

        def appendList(self, rows):
            self.handle.entries += len(rows)
            self.rows += rows

        def updateValue(self, key, value):
            self.handle.entries += 1
            self.map[key] = value

        def removeKey(self, key):
            del self.map[key]

        def iterator(self):
            return iter(list(self.map.items()))


class Watermark:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return int(self.at.value // 1_000_000)


def test_a_pair_keeps_one_timer_and_few_state_entries():
    rng = np.random.default_rng(3)
    start = pd.Timestamp("2024-01-01")
    frame = pd.DataFrame({"ts": start + pd.to_timedelta(np.arange(4000), "s"), "rate": 5 + rng.normal(0, 1, 4000).round(3)})
    frame = frame.assign(id=np.arange(4000)).sample(frac=1.0, random_state=1)
    kinds = inspect.signature(ST.RollingRates.__init__).parameters
    asked = {"pair": "pair", "time": "ts", "rate": "rate", "tiebreak": "id", "kind": pa.int64(), "window_rows": 20, "min_rows": 5, "deviations": 2.0}
    judge, handle = ST.RollingRates(*[asked.get(n) for n in kinds if n != "self"]), Handle()
    judge.init(handle)
    list(judge.handleInputRows(("a",), iter(frame.iloc[i : i + 100] for i in range(0, 4000, 100)), None))
    assert handle.most == 1 and handle.entries <= 4
    got = []
    for at in (start + pd.Timedelta(seconds=1500), start + pd.Timedelta(days=1)):
        handle.timers.pop()
        got += list(judge.handleExpiredTimer(("a",), Watermark(at), None))
    assert not handle.timers
    out = pd.concat(got)
    change, flag = ST.rolling_flags(frame.sort_values("ts")["rate"].to_numpy(), 20, 5, 2.0)
    assert out["id"].tolist() == list(range(4000))
    assert out["is_anomaly"].tolist() == flag.tolist() and flag.any()
    assert np.allclose(out["pct_change"][1:], change[1:])


def test_feedback_streams_with_late_and_missing_labels(spark):
    sources = [new_path(spark, n) for n in ("predictions", "labels")]
    out, mark = new_path(spark, "out"), new_path(spark, "mark")
    kinds = ("id long, predicted_at timestamp", "id long, label int, labelled_at timestamp")
    start, hour, end = datetime(2024, 1, 1), timedelta(hours=1), datetime(2200, 1, 1)
    predictions = [(i, start + i * hour) for i in range(12)] + [(3, start + 5 * hour), (None, start)]
    labels = [(i, i % 2, start + (i + i % 5) * hour) for i in range(0, 12, 2)] + [(3, 7, start + 5 * hour), (None, 1, start)]
    labels += [(6, 9, start + 6.5 * hour), (99, 1, start)]
    schemas = [spark.createDataFrame([], k).schema for k in kinds]
    steps = [(predictions[:6], []), ([], labels[:4]), (predictions[6:], labels[4:]), ([(-1, end)], [(-2, None, end)])]
    for step in steps:
        for rows, source, ddl in zip(step, sources, kinds):
            land(spark, source, rows, ddl)
        streams = [IN.file_stream(spark, s, k) for s, k in zip(sources, schemas)]
        joined = ST.prediction_feedback(*streams, ["id"], "predicted_at", "labelled_at", "2 hours", "30 hours")
        IG.run_available(ST.append_sink(joined, out), mark)
    got = sorted([(r["id"], r["predicted_at"], r["label"]) for r in spark.read.parquet(out).collect()], key=repr)
    want = []
    for i, at in predictions:
        met = [x for j, x, when in labels if j is not None and i == j and at <= when <= at + 2 * hour]
        want += [(i, at, x) for x in met or [None]]
    assert got == sorted(want, key=repr)


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("price", T.DecimalType(10, 2))])


def change(op, before, after, lsn):
    body = {"op": op, "before": before, "after": after, "ts_ms": lsn, "source": {"lsn": lsn}}
    return (json.dumps({"schema": {}, "payload": body}),)


@pytest.mark.parametrize("keep,want", [(False, {1: "2.50", 2: "9.00"}), (True, {1: "2.50"})])
def test_changes(spark, keep, want):
    source, log, mark = (new_path(spark, n) for n in ("in", "log", "mark"))
    schema = T.StructType([T.StructField("value", T.StringType())])
    first = [
        change("r", None, {"id": 1, "price": "1.00"}, 1),
        change("r", None, {"id": 2, "price": "9.00"}, 2),
        change("u", {"id": 1, "price": "1.00"}, {"id": 1, "price": "2.00"}, 3),
    ]
    second = [
        change("u", {"id": 1, "price": "2.00"}, {"id": 1, "price": "2.50"}, 5),
        change("d", {"id": 2, "price": "9.00"}, None, 6),
        (None,),
    ]
    for rows in (first, second):
        land(spark, source, rows, "value string")
        stream = IN.file_stream(spark, source, schema)
        IG.run_available(CH.change_sink(stream, ROW, ["id"], log, keep), mark)
    state = CH.apply_latest(spark.read.parquet(log).drop("_batch"), ["id"])
    assert {r["id"]: str(r["price"]) for r in state.collect()} == want


def test_repeats_are_dropped_across_batches(spark):
    source, out, mark = (new_path(spark, n) for n in ("in", "out", "mark"))
    ddl = "id long, ts timestamp"
    when = datetime(2024, 1, 1)
    for rows in ([(1, when), (1, when), (2, when)], [(2, when), (3, when)]):
        land(spark, source, rows, ddl)
        stream = IN.file_stream(spark, source, spark.createDataFrame(rows, ddl).schema)
        IG.run_available(ST.append_sink(IG.drop_repeats(stream, "id", "ts"), out), mark)
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_late_rows_are_dropped(spark):
    source, out, mark = (new_path(spark, n) for n in ("in", "out", "mark"))
    ddl = "ts timestamp, c string, amount double"
    day = datetime(2024, 1, 1)
    batches = [
        [(day + timedelta(minutes=m), "USD", 1.0) for m in (5, 30, 200)],
        [(day + timedelta(minutes=10), "USD", 100.0), (day + timedelta(minutes=600), "USD", 1.0)],
    ]
    for rows in batches:
        land(spark, source, rows, ddl)
        stream = IN.file_stream(spark, source, spark.createDataFrame(rows, ddl).schema)
        IG.run_available(ST.append_sink(ST.hourly_volume(stream, "ts", "c", "amount"), out), mark)
    got = {r["window_start"].hour: r["volume"] for r in spark.read.parquet(out).collect()}
    assert got == {0: 2.0, 3: 1.0}


def test_rates_and_topics(spark):
    source, out, mark = (new_path(spark, n) for n in ("in", "out", "mark"))
    ddl = "topic string, value string, off long, ts timestamp"
    rows = [("a", f"v{i}", i, datetime(2024, 1, 1)) for i in range(5)] + [("b", "w", 1, datetime(2024, 1, 1))]
    land(spark, source, rows, ddl)
    stream = IN.file_stream(spark, source, spark.createDataFrame(rows, ddl).schema)
    IG.run_available(ST.table_sink(ST.topic_counts(stream, "topic", "value", "off"), out), mark)
    got = {r["topic"]: (r["messages"], r["last_message"]) for r in spark.read.parquet(out).collect()}
    assert got == {"a": (5, "v4"), "b": (1, "w")}


def test_message_rate_stream(spark):
    source, out, mark = (new_path(spark, n) for n in ("in", "out", "mark"))
    ddl = "ts timestamp"
    day = datetime(2024, 1, 1)
    rows = [(day + timedelta(seconds=s),) for s in (5, 61, 62, 300, 301, 900)]
    for part in (rows[:3], rows[3:], [(day + timedelta(days=1),)]):
        land(spark, source, part, ddl)
        stream = IN.file_stream(spark, source, spark.createDataFrame(rows, ddl).schema)
        IG.run_available(ST.append_sink(ST.message_rate(stream, "ts"), out), mark)
    got = {r["window_start"]: (r["window_end"], r["msg_per_sec"]) for r in spark.read.parquet(out).collect()}
    want = {}
    for k in range(-5, 20):
        start, end = day + timedelta(minutes=k), day + timedelta(minutes=k + 5)
        n = sum(start <= t < end for (t,) in rows)
        if n:
            want[start] = (end, n / 300)
    assert got == want
