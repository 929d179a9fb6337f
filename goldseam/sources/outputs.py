"""Sinks: partitioned JSON, idempotent partition overwrite, full replace, layer tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldseam.schemas import BRONZE_AUDIT


def write_raw_json(
    df: DataFrame, base: str, day: str = "event_date", records_per_file: int = 1_000_000
) -> None:
    """Append newline JSON in one folder per day.

    Rows are balanced per day before the write. A day with much data gets many writers
    (adaptive execution splits it) and a small one gets one file.
    """
    balanced = df.hint("rebalance", F.col(day))
    writer = balanced.write.mode("append").partitionBy(day)
    writer.option("maxRecordsPerFile", records_per_file).option(
        "timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    ).json(base)


def overwrite_partitions(df: DataFrame, path: str, partitions: Sequence[str]) -> int:
    """Replace exactly the partitions that ``df`` holds, and return the rows written."""
    seen = Observation("written")
    counted = df.hint("rebalance", *[F.col(p) for p in partitions]).observe(
        seen, F.count(F.lit(1)).alias("rows")
    )
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)
    return int(seen.get["rows"])


def replace_partitions(df: DataFrame, path: str, partition: str, values: Iterable[object]) -> int:
    """Replace the partitions of ``values`` and those that ``df`` holds, and return the rows written.

    Partitions of ``values`` without a row are removed. Which partitions have rows is seen while
    they are written, so ``df`` is computed once; the driver gets one value per partition.
    """
    seen = Observation("partitions")
    counted = df.hint("rebalance", F.col(partition)).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(partition).alias("held"),
        F.count_if(F.col(partition).isNull()).alias("unknown"),
    )
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition).parquet(path)
    found = seen.get
    held = {*found["held"], *([None] if found["unknown"] else [])}
    drop_partitions(df.sparkSession, path, partition, set(values) - held)
    return int(found["rows"])


def drop_partitions(spark: SparkSession, path: str, partition: str, values: Iterable[object]) -> None:
    """Remove whole partitions of one column; missing ones are no error. None is the null partition."""
    for value in values:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else str(value)
        delete_folder(spark, f"{path.rstrip('/')}/{partition}={name}")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_folder(spark: SparkSession, path: str) -> None:
    store, place = _file_system(spark, path)
    store.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    store, place = _file_system(spark, path)
    return store.exists(place)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder was completed."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def replace_table(df: DataFrame, path: str) -> int:
    """Replace a whole table; the row count comes from the same pass."""
    seen = Observation("replaced")
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(path)
    return int(seen.get["rows"])


def without_audit(df: DataFrame, columns: Sequence[str] = BRONZE_AUDIT) -> DataFrame:
    """Drop the load columns of the previous layer, where present."""
    return df.drop(*columns)


def bucket_of(column: str | Column, buckets: int = 16) -> Column:
    return F.pmod(F.hash(column), F.lit(buckets))


def add_layout(
    df: DataFrame, time: str = "timestamp", bucket_by: str | None = None, buckets: int = 16
) -> DataFrame:
    """Partition columns of a layer table: the day, and optionally a bucket of a column."""
    laid = df.withColumn("date", F.col(time).cast("date"))
    return laid.withColumn("bucket", bucket_of(bucket_by, buckets)) if bucket_by else laid


# Columns and partitioning of the layer tables.
LAYER_TABLES = {
    "bronze.transactions": (
        "transaction_id STRING, user_id STRING, timestamp TIMESTAMP, transaction_type STRING, "
        "currency STRING, amount_brl DECIMAL(15,2), amount_foreign DECIMAL(15,4), "
        "exchange_rate DECIMAL(10,4), spread_pct DECIMAL(5,3), fee_brl DECIMAL(10,2), "
        "status STRING, channel STRING, device STRING, is_anomaly BOOLEAN, "
        "anomaly_score DECIMAL(5,4), _bronze_loaded_at TIMESTAMP, _source_file STRING, "
        "_batch_id STRING, date DATE",
        ("date",),
    ),
    "silver.transactions": (
        "transaction_id STRING, user_id STRING, timestamp TIMESTAMP, transaction_type STRING, "
        "currency STRING, amount_brl DECIMAL(15,2), amount_foreign DECIMAL(15,4), "
        "exchange_rate DECIMAL(10,4), spread_pct DECIMAL(5,3), fee_brl DECIMAL(10,2), "
        "status STRING, channel STRING, device STRING, is_anomaly BOOLEAN, "
        "anomaly_score DECIMAL(5,4), amount_usd DECIMAL(15,2), day_of_week INT, hour_of_day INT, "
        "is_business_hours BOOLEAN, year_month INT, _silver_loaded_at TIMESTAMP, date DATE, "
        "bucket INT",
        ("date", "bucket"),
    ),
    "gold.daily_volume": (
        "date DATE, currency STRING, total_volume_brl DECIMAL(18,2), transaction_count LONG, "
        "avg_amount DOUBLE, min_amount DECIMAL(15,2), max_amount DECIMAL(15,2), "
        "p95_amount DOUBLE, volume_change_pct DOUBLE, ma7_volume_brl DOUBLE",
        ("date",),
    ),
    "gold.user_summary": (
        "user_id STRING, total_transactions LONG, total_volume_brl DECIMAL(18,2), "
        "avg_transaction_brl DOUBLE, first_transaction_at TIMESTAMP, "
        "last_transaction_at TIMESTAMP",
        (),
    ),
    "gold.hourly_rates": (
        "hour_bucket LONG, currency STRING, avg_rate DOUBLE, min_rate DECIMAL(10,4), "
        "max_rate DECIMAL(10,4), volatility DOUBLE, transaction_count LONG",
        (),
    ),
    "gold.anomaly_summary": (
        "date DATE, total_transactions LONG, total_anomalies LONG, anomaly_rate DOUBLE",
        ("date",),
    ),
}


def create_layer(spark: SparkSession, layer: str, location: str | None = None) -> list[str]:
    """Create a layer's database and tables where they are missing."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{place}")
    made = []
    for name, (columns, partitions) in LAYER_TABLES.items():
        if name.startswith(f"{layer}."):
            by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by}")
            made.append(name)
    return made


def prediction_records(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Key and JSON value of the prediction log, scores rounded as logged."""
    record = F.struct(
        "transaction_id",
        "user_id",
        "currency",
        F.col("amount_brl").cast("double").alias("amount_brl"),
        F.struct(*[F.col(f).cast("double").alias(f) for f in features]).alias("features"),
        F.round("anomaly_score", 6).alias("anomaly_score"),
        "is_anomaly",
        "risk_level",
        "model_version",
        F.round("latency_ms", 3).alias("latency_ms"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("logged_at"),
    )
    return df.select(F.col("transaction_id").alias("key"), F.to_json(record).alias("value"))
