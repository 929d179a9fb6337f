"""Windowed and stateful streams: volumes, rates, topic counts, rolling anomalies, scoring."""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from goldseam.functions import columns as X
from goldseam.operators.features import rate_changes, serving_vector
from goldseam.operators.forest import Forest, score_column
from goldseam.operators.ordered import sort_columns
from goldseam.sources.outputs import overwrite_partitions, prediction_records, replace_table


def hourly_volume(
    stream: DataFrame, time: str, currency: str, amount: str, late: str = "1 hour"
) -> DataFrame:
    """Closed hourly windows per currency; rows later than the watermark are dropped."""
    windowed = stream.withWatermark(time, late).groupBy(F.window(time, "1 hour").alias("w"), currency)
    totals = windowed.agg(F.sum(amount).alias("volume"), F.count(F.lit(1)).alias("transactions"))
    return totals.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        currency,
        "volume",
        "transactions",
    )


def message_rate(stream: DataFrame, time: str, late: str = "1 hour") -> DataFrame:
    """Messages per second over five minutes, every minute."""
    counts = (
        stream.withWatermark(time, late)
        .groupBy(F.window(time, "5 minutes", "1 minute").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.select(
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        (F.col("n") / 300.0).alias("msg_per_sec"),
    )


def topic_counts(stream: DataFrame, topic: str, value: str, offset: str) -> DataFrame:
    """Running count and last message per topic (complete mode)."""
    return stream.groupBy(topic).agg(
        F.count(F.lit(1)).alias("messages"), F.max_by(value, offset).alias("last_message")
    )


def table_sink(stream: DataFrame, path: str) -> DataStreamWriter:
    """Replace a small result table with every micro-batch (complete mode)."""

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_table(batch, f"{path}/version={batch_id}")

    return stream.writeStream.outputMode("complete").foreachBatch(write)


def append_sink(stream: DataFrame, path: str) -> DataStreamWriter:
    return stream.writeStream.format("parquet").outputMode("append").option("path", path)


def rate_anomaly_sink(
    stream: DataFrame,
    pair: str,
    time: str,
    rate: str,
    tiebreak: str,
    output_path: str,
    state_path: str,
    window_rows: int = 20,
) -> DataStreamWriter:
    """Flag rates in time order, across micro-batches.

    The state is the last ``window_rows + 1`` rates of each pair, a table per batch. A
    batch puts its rows behind those of the previous state and runs the batch operator, so
    the work of a hot pair is split like there, and repeating a batch gives the same files.
    """
    kept = window_rows + 1
    columns = [pair, time, rate, tiebreak]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = batch.select(*columns).withColumn("_old", F.lit(False))
        rows = fresh
        if batch_id > 0:
            old = spark.read.schema(batch.select(*columns).schema).parquet(
                f"{state_path}/batch={batch_id - 1}"
            )
            rows = fresh.unionByName(old.withColumn("_old", F.lit(True)))
        flagged = rate_changes(rows, pair, time, rate, tiebreak, window_rows)
        result = flagged.filter(~F.col("_old")).drop("_old").withColumn("_batch", F.lit(batch_id))
        overwrite_partitions(result, output_path, ["_batch"])
        newest = Window.partitionBy(pair).orderBy(*sort_columns([time, tiebreak], flip=True))
        tails = rows.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= kept)
        tails.select(*columns).write.mode("overwrite").parquet(
            f"{state_path}/batch={batch_id}"
        )

    return stream.writeStream.foreachBatch(write)


#: Rows of a chunk of waiting rows, at least, if so many come in together; rows given out at once, at most.
CHUNK_ROWS = 50_000


class RollingRates(StatefulProcessor):
    """Per pair: rows that the watermark has not passed, and the last rates before them.

    Rows wait in chunks until the watermark has passed them, so they are judged in time order
    however they came in. A pair has one event-time timer, at its oldest waiting row. A chunk is an
    entry of a map state with its first and last time; one that the watermark has not reached stays
    as it is. Judged rows leave the last ``window_rows + 1`` rates behind. State per pair is bounded
    by the rows within the watermark's delay. Later rows than that are dropped by Spark and counted
    in the query's progress.
    """

    def __init__(
        self, pair: str, time: str, rate: str, tiebreak: str, kind: pa.DataType, window_rows: int, min_rows: int, deviations: float
    ):
        self.pair, self.time, self.rate, self.tiebreak = pair, time, rate, tiebreak
        self.schema = pa.schema([("time", pa.int64()), ("rate", pa.float64()), ("tiebreak", kind)])
        self.window_rows, self.min_rows, self.deviations = window_rows, min_rows, deviations

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "number long", "first long, last long, data binary")
        # Chunks made so far, and the time of the timer in milliseconds.
        self.mark = handle.getValueState("mark", "made long, timer long")
        self.tail = handle.getListState("tail", T.StructType([T.StructField("rate", T.DoubleType())]))

    def _keep(self, number: int, rows: pa.Table) -> int:
        """Store rows as one chunk; its first time in microseconds."""
        first, last = (bound.as_py() for bound in pc.min_max(rows["time"]).values())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema) as out:
            out.write_table(rows)
        self.chunks.updateValue((number,), (first, last, sink.getvalue().to_pybytes()))
        return first

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        made, timer = self.mark.get() if self.mark.exists() else (0, None)
        firsts, parts, waiting = [], [], 0
        for frame in itertools.chain(rows, [None]):
            if frame is not None and len(frame):
                times = frame[self.time].astype("datetime64[us]").astype("int64")
                columns = [times, frame[self.rate].astype(float), frame[self.tiebreak]]
                arrays = [pa.array(c, f.type, from_pandas=f.name == "tiebreak") for c, f in zip(columns, self.schema)]
                parts.append(pa.Table.from_arrays(arrays, schema=self.schema))
                waiting += len(frame)
            if parts and (frame is None or waiting >= CHUNK_ROWS):
                firsts.append(self._keep(made, pa.concat_tables(parts)))
                made, parts, waiting = made + 1, [], 0
        if firsts:
            self._wake(made, timer, min(firsts))
        return iter(())

    def _wake(self, made: int, timer: int | None, first: int) -> None:
        """Have a timer right behind the oldest waiting row, and no other."""
        at = first // 1_000 + 1
        if timer is None or at < timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(at)
            timer = at
        self.mark.update((made, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1_000
        made = self.mark.get()[0] if self.mark.exists() else 0
        ready, left, reached = [], [], []
        for (number,), (first, last, data) in self.chunks.iterator():
            if first >= passed:
                left.append(first)
                continue
            rows = pa.ipc.open_stream(data).read_all()
            reached.append((number, rows.filter(pc.greater_equal(rows["time"], passed)) if last >= passed else None))
            ready.append(rows.filter(pc.less(rows["time"], passed)) if last >= passed else rows)
        for number, rest in reached:
            if rest is None:
                self.chunks.removeKey((number,))
            else:
                left.append(self._keep(number, rest))
        if left:
            self._wake(made, None, min(left))
        else:
            self.mark.clear()
        if not ready:
            return
        rows = pa.concat_tables(ready).to_pandas(integer_object_nulls=True)
        del ready
        rows = rows.sort_values(["time", "tiebreak"], kind="stable")
        old = [np.nan if row[0] is None else row[0] for row in self.tail.get()]
        rates = np.array([*old, *rows["rate"]], float)
        change, flag = rolling_flags(rates, self.window_rows, self.min_rows, self.deviations)
        self.tail.put([(None if np.isnan(x) else float(x),) for x in rates[-self.window_rows - 1 :]])
        change, flag = change[len(old) :], flag[len(old) :]
        for at in range(0, len(rows), CHUNK_ROWS):
            some = slice(at, at + CHUNK_ROWS)
            part = rows.iloc[some]
            out = {self.pair: key[0], self.tiebreak: part["tiebreak"].array, self.time: part["time"].to_numpy().astype("datetime64[us]")}
            yield pd.DataFrame({**out, "pct_change": change[some], "is_anomaly": flag[some]}, index=range(len(part)))

    def close(self) -> None:
        pass


def rolling_flags(rates: np.ndarray, window_rows: int, min_rows: int, deviations: float) -> tuple[np.ndarray, np.ndarray]:
    """Percentage changes of rates in time order, and whether each lies outside the given number of
    deviations from the mean of the last ``window_rows`` changes, itself included."""
    before = np.concatenate([[np.nan], rates[:-1]])
    before[before == 0] = np.nan
    change = (rates - before) / before * 100
    padded = np.concatenate([np.full(window_rows - 1, np.nan), change])
    flags = np.zeros(len(change), bool)
    for at in range(0, len(change), 4096):
        part = padded[at : at + 4096 + window_rows - 1]
        frames = np.lib.stride_tricks.sliding_window_view(part, window_rows)
        n = np.count_nonzero(~np.isnan(frames), axis=1)
        some = np.flatnonzero(n >= max(2, min_rows))
        frames, now = frames[some], frames[some, -1]
        mean, spread = np.nanmean(frames, axis=1), np.nanstd(frames, axis=1, ddof=1)
        # A missing change compares as false.
        flags[at + some] = (spread > 0) & (np.abs(now - mean) > deviations * spread)
    return change, flags


def rolling_rate_flags(
    stream: DataFrame,
    pair: str,
    time: str,
    rate: str,
    tiebreak: str,
    late: str,
    window_rows: int = 20,
    min_rows: int = 5,
    deviations: float = 2.0,
) -> DataFrame:
    """``pair, tiebreak, time, pct_change, is_anomaly`` of a stream, with keyed state in the state store.

    A row comes out when the watermark, ``late`` behind the newest row, has passed it. The flags equal
    those of the batch operator over all rows that were not late, in whatever order they came in.
    Null times and rows later than the watermark are not judged. A pair is worked on by one task, as
    each row needs those before it; ``rate_anomaly_sink`` splits a hot pair.
    """
    rows = stream.select(pair, F.col(time).cast("timestamp").alias(time), F.col(rate).cast("double").alias(rate), tiebreak)
    rows = rows.where(F.col(time).isNotNull())
    kind = rows.schema[tiebreak].dataType
    out = T.StructType().add(pair, rows.schema[pair].dataType).add(tiebreak, kind).add(time, T.TimestampType())
    out = out.add("pct_change", T.DoubleType()).add("is_anomaly", T.BooleanType())
    processor = RollingRates(pair, time, rate, tiebreak, to_arrow_type(kind), window_rows, min_rows, deviations)
    keyed = rows.withWatermark(time, late).groupBy(pair)
    return keyed.transformWithStateInPandas(processor, out, "Append", "EventTime")


def late_rows(query: StreamingQuery) -> int:
    """Rows that the stateful operators of a query dropped as later than the watermark."""
    operators = [o for p in query.recentProgress for o in p["stateOperators"]]
    return sum(o["numRowsDroppedByWatermark"] for o in operators)


def prediction_feedback(
    predictions: DataFrame,
    labels: DataFrame,
    keys: Sequence[str],
    predicted_at: str,
    labelled_at: str,
    within: str,
    late: str,
) -> DataFrame:
    """Two streams joined: each prediction with its labels of the ``within`` after it, or with none.

    Both sides carry a watermark ``late`` behind their newest row. With the interval it bounds the
    state: a prediction without a label comes out, its label columns null, and is dropped when the
    watermark has passed the end of its interval; a label when no prediction can reach it any more.
    """
    left = predictions.withWatermark(predicted_at, late).alias("p")
    right = labels.withWatermark(labelled_at, late)
    for key in keys:
        right = right.withColumnRenamed(key, f"_label_{key}")
    on = [F.col(k) == F.col(f"_label_{k}") for k in keys]
    on.append(F.col(labelled_at) >= F.col(predicted_at))
    on.append(F.col(labelled_at) <= F.col(predicted_at) + F.expr(f"interval {within}"))
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    return left.join(right, condition, "leftOuter").drop(*[f"_label_{k}" for k in keys])


def score_stream(
    stream: DataFrame,
    users: DataFrame,
    forest: Forest,
    keys: Sequence[str] = ("user_id",),
    model_version: str = "1",
) -> DataFrame:
    """Join each event with its newest features, score it, and form the prediction record."""
    from goldseam.schemas import MODEL_FEATURES

    vector = serving_vector(stream.join(users, list(keys), "left"))
    scored = vector.withColumn("anomaly_score", X.clip(score_column(forest) / 0.5, 0.0, 1.0))
    judged = scored.withColumns(
        {
            "is_anomaly": X.risk_flag("anomaly_score"),
            "risk_level": X.risk_level("anomaly_score"),
            "model_version": F.lit(model_version),
            "latency_ms": F.lit(None).cast("double"),
        }
    )
    return prediction_records(judged, MODEL_FEATURES)
