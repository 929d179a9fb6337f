"""Stream ingest: parse, add metadata, split good rows from dead letters, write by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from goldseam.schemas import RAW_TRANSACTION
from goldseam.sources.inputs import parse_values, split_values
from goldseam.sources.outputs import overwrite_partitions


def add_ingest_metadata(df: DataFrame, source: str = "debezium-cdc") -> DataFrame:
    """Ingest time, source system and a batch id per message."""
    return df.withColumns(
        {
            "ingestion_timestamp": F.current_timestamp(),
            "source_system": F.lit(source),
            "batch_id": F.uuid(),
        }
    )


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process everything that is there and stop; a rerun goes on from the checkpoint."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def json_sink(
    stream: DataFrame,
    base: str,
    time: str = "timestamp",
    schema: T.StructType = RAW_TRANSACTION,
    records_per_file: int = 100_000,
) -> DataStreamWriter:
    """Good rows with ingest metadata as JSON files by event day.

    The file sink tracks its own batches, so a restart neither loses nor repeats rows.
    """
    good, _ = split_values(parse_values(stream, schema))
    dated = add_ingest_metadata(good).withColumn("event_date", F.to_date(time))
    return (
        dated.writeStream.format("json")
        .outputMode("append")
        .option("path", base)
        .option("maxRecordsPerFile", records_per_file)
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .partitionBy("event_date")
    )


def split_sink(
    stream: DataFrame, good_path: str, dead_path: str, schema: T.StructType = RAW_TRANSACTION
) -> DataStreamWriter:
    """Good rows to one table, unparseable ones with text and error to another.

    Each micro-batch replaces its own folder, so repeating a batch after a failure gives
    the same tables.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_values(batch, schema).persist()
        good, bad = split_values(parsed)
        stamped = F.lit(batch_id).alias("_batch")
        overwrite_partitions(add_ingest_metadata(good).select("*", stamped), good_path, ["_batch"])
        overwrite_partitions(bad.select("*", stamped), dead_path, ["_batch"])
        parsed.unpersist()

    return stream.writeStream.foreachBatch(write)


def drop_repeats(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """First arrival per key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
