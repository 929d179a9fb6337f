"""Change-data capture: unwrap the envelope and keep the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from goldseam.operators.refine import latest_per_key
from goldseam.sources.outputs import overwrite_partitions


def envelope(row: T.StructType) -> T.StructType:
    """Schema of a change message whose decimals come as strings."""
    fields = []
    for f in row.fields:
        text = isinstance(f.dataType, T.DecimalType)
        fields.append(T.StructField(f.name, T.StringType() if text else f.dataType, True))
    state = T.StructType(fields)
    payload = T.StructType(
        [
            T.StructField("before", state, True),
            T.StructField("after", state, True),
            T.StructField("op", T.StringType(), True),
            T.StructField("ts_ms", T.LongType(), True),
            T.StructField("source", T.StructType([T.StructField("lsn", T.LongType(), True)]), True),
        ]
    )
    return T.StructType([T.StructField("payload", payload, True)])


def unwrap(messages: DataFrame, row: T.StructType, keep_deletes: bool = False) -> DataFrame:
    """New row states with ``_op``, ``_ts_ms`` and ``_lsn``.

    Tombstones (null values) are dropped. Deletes have no new state and are dropped too,
    unless ``keep_deletes`` asks for their old state.
    """
    parsed = messages.filter("value is not null").withColumn(
        "_m", F.from_json("value", envelope(row)).getField("payload")
    )
    state = F.col("_m.after")
    if keep_deletes:
        state = F.coalesce(state, F.when(F.col("_m.op") == "d", F.col("_m.before")))
    present = parsed.withColumn("_state", state).filter("_state is not null")
    columns = [F.col(f"_state.{f.name}").cast(f.dataType).alias(f.name) for f in row.fields]
    return present.select(
        *columns,
        F.col("_m.op").alias("_op"),
        F.col("_m.ts_ms").alias("_ts_ms"),
        F.col("_m.source.lsn").alias("_lsn"),
    )


def apply_latest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Live rows: the newest change per key, deletes removed."""
    newest = latest_per_key(changes, keys, ["_ts_ms", "_lsn"])
    return newest.filter("_op <> 'd'").drop("_op", "_ts_ms", "_lsn")


def change_sink(
    stream: DataFrame, row: T.StructType, keys: Sequence[str], log_path: str, keep_deletes: bool = False
) -> DataStreamWriter:
    """Append each micro-batch, reduced to the newest change per key, to a change log.

    The batch number partitions the log, so a repeated batch replaces itself. Readers use
    ``apply_latest`` on the log.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = latest_per_key(unwrap(batch, row, keep_deletes), keys, ["_ts_ms", "_lsn"])
        overwrite_partitions(changes.withColumn("_batch", F.lit(batch_id)), log_path, ["_batch"])

    return stream.writeStream.foreachBatch(write)
