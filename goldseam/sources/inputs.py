"""Scans: raw JSON by day, tables, feature files, object listings and topics."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldseam.schemas import RAW_TRANSACTION

CORRUPT = "_corrupt_record"


def yesterday() -> str:
    return (datetime.now(timezone.utc) - timedelta(days=1)).strftime("%Y-%m-%d")


def read_raw(
    spark: SparkSession,
    base: str,
    first_day: str | date | None = None,
    last_day: str | date | None = None,
    schema: T.StructType = RAW_TRANSACTION,
) -> DataFrame:
    """Raw JSON of one day (default yesterday) or of an inclusive range of days.

    The days are a filter on the folder partition, so only their files are listed and
    read. Lines that do not parse keep their text in ``_corrupt_record``.
    """
    start = str(first_day or yesterday())
    end = str(last_day or start)
    fields = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    fields = fields.add("event_date", "date").add(CORRUPT, "string")
    frame = spark.read.schema(fields).option("columnNameOfCorruptRecord", CORRUPT).json(base)
    return frame.filter(F.col("event_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def parse_values(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Add ``data`` (typed record) and ``error`` (null for good rows) to JSON texts.

    An empty text and a literal null give no record and no corrupt text either, so both
    signs of failure are tested.
    """
    fields = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    fields = fields.add(CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("data", F.from_json(value, fields, options))
    corrupt = F.col("data").getField(CORRUPT).isNotNull()
    required = [f.name for f in schema.fields if not f.nullable]
    lacking = F.concat_ws(",", *[F.when(F.col(f"data.{n}").isNull(), F.lit(n)) for n in required])
    error = F.when(F.col("data").isNull() | corrupt, F.lit("malformed")).when(
        lacking != "", F.concat(F.lit("missing "), lacking)
    )
    return parsed.withColumn("error", error)


def split_values(parsed: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Good rows as typed columns, bad rows as raw text with the error."""
    rest = [c for c in parsed.columns if c not in (value, "data", "error")]
    good = parsed.filter("error is null").select(*rest, "data.*").drop(CORRUPT)
    bad = parsed.filter("error is not null").select(
        *rest, F.col(value).alias("_raw"), F.col("error").alias("_error")
    )
    return good, bad


@dataclass(frozen=True)
class FeatureSource:
    """A columnar feature table with its event-time column."""

    path: str
    timestamp: str = "event_timestamp"
    created: str | None = None

    def load(
        self, spark: SparkSession, start: datetime | None = None, end: datetime | None = None
    ) -> DataFrame:
        frame = spark.read.parquet(self.path)
        if start is not None:
            frame = frame.filter(F.col(self.timestamp) >= F.lit(start))
        if end is not None:
            frame = frame.filter(F.col(self.timestamp) <= F.lit(end))
        return frame


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table by catalog name, or by path when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def training_frame(
    spark: SparkSession, path: str, end: datetime, lookback_days: int = 90, time: str = "timestamp"
) -> DataFrame:
    """The training window before ``end``."""
    start = end - timedelta(days=lookback_days)
    return FeatureSource(path, time).load(spark, start, end)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path, size and change time of every file below a folder; contents are not read."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return listed.select(
        F.col("path").alias("full_path"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("last_modified"),
    )


def with_source_file(df: DataFrame, column: str = "_source_file") -> DataFrame:
    return df.withColumn(column, F.col("_metadata.file_path"))


def kafka_stream(
    spark: SparkSession, servers: str, topics: list[str], oldest: bool = True, group: str | None = None
) -> DataFrame:
    """A topic as a stream of (topic, key, value, offset, timestamp) with text values.

    Needs the Kafka connector of the Spark distribution on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest" if oldest else "latest")
    )
    if group:
        reader = reader.option("kafka.group.id", group)
    return reader.load().select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "offset",
        "timestamp",
    )


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    format: str = "parquet",
    files_per_trigger: int | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """A folder of files as a stream."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)
