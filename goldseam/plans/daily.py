"""The daily job: raw to bronze to silver to gold, with a quality gate after each layer."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldseam.operators import gold as G
from goldseam.operators import quality as Q
from goldseam.operators import refine as R
from goldseam.sources import inputs as IN
from goldseam.sources import outputs as OUT


def _path(lake: str, layer: str, name: str) -> str:
    return f"{lake.rstrip('/')}/{layer}/{name}"


def load_bronze(
    spark: SparkSession, raw: str, lake: str, first_day: str, last_day: str | None = None
) -> int:
    """Deduplicate the raw rows of some days and replace their partitions.

    Rows that did not parse go to a quarantine table and take no part in deduplication.
    """
    read = IN.with_source_file(IN.read_raw(spark, raw, first_day, last_day))
    broken = F.col(IN.CORRUPT).isNotNull() | F.col("transaction_id").isNull()
    bad = read.filter(broken).select(IN.CORRUPT, "_source_file", "event_date")
    OUT.overwrite_partitions(bad, _path(lake, "bronze", "quarantine"), ["event_date"])
    good = read.filter(~broken).drop(IN.CORRUPT)
    newest = R.latest_per_key(good, ["transaction_id"], ["timestamp", "_source_file"])
    audited = R.add_audit(newest, "_source_file").withColumnRenamed("event_date", "date")
    return OUT.overwrite_partitions(audited, _path(lake, "bronze", "transactions"), ["date"])


def _days(df: DataFrame, first_day: str, last_day: str | None) -> DataFrame:
    ends = [F.lit(d).cast("date") for d in (first_day, last_day or first_day)]
    return df.filter(F.col("date").between(*ends))


def load_silver(spark: SparkSession, lake: str, first_day: str, last_day: str | None = None) -> int:
    """Clean and enrich the given days only; other partitions are not read."""
    bronze = _days(spark.read.parquet(_path(lake, "bronze", "transactions")), first_day, last_day)
    silver = OUT.without_audit(R.enrich(R.clean(bronze.withColumnRenamed("date", "_day"))))
    laid = silver.withColumn("date", F.col("_day")).drop("_day")
    return OUT.overwrite_partitions(laid, _path(lake, "silver", "transactions"), ["date"])


def event_days(
    spark: SparkSession, lake: str, first_day: str, last_day: str | None = None
) -> set[date | None]:
    """The days on which the silver rows loaded for some days happened; none without a table."""
    try:
        silver = spark.read.parquet(_path(lake, "silver", "transactions"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    days = _days(silver, first_day, last_day).select(F.to_date("timestamp").alias("day")).distinct()
    return {row["day"] for row in days.collect()}


def _happened_on(days: Iterable[date | None]) -> Column:
    """Rows of some days, as ranges of the time column that Parquet statistics can skip by."""
    found, time = F.lit(False), F.col("timestamp")
    known = {d for d in days if d is not None}
    for day in sorted(known):
        if day - timedelta(1) in known:
            continue
        end = day + timedelta(1)
        while end in known:
            end += timedelta(1)
        found |= (time >= F.lit(day).cast("timestamp")) & (time < F.lit(end).cast("timestamp"))
    return found | time.isNull() if None in days else found


#: User totals are kept in this many parts; a load rewrites the parts of the users that it touches.
USER_BUCKETS = 64


def _on_days(days: Iterable[date | None]) -> Column:
    known = [d for d in days if d is not None]
    found = F.col("date").isin(known) if known else F.lit(False)
    found = F.coalesce(found, F.lit(False))
    return found | F.col("date").isNull() if None in days else found


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """A table with known columns, also if it has no row; None if it was never written."""
    return spark.read.schema(schema).parquet(path) if OUT.exists(spark, path) else None


def _finish_users(spark: SparkSession, lake: str) -> None:
    """Carry out a user refresh that is prepared in full; also after a break, as often as needed."""
    ready = _path(lake, "gold", "_user_refresh")
    if not OUT.is_written(spark, f"{ready}/done"):
        return
    parts = {r["kind"]: r for r in spark.read.parquet(f"{ready}/done").collect()}
    for name, column in (("user_days", "date"), ("user_totals", "bucket")):
        values = parts[name]["days" if column == "date" else "buckets"]
        OUT.replace_partitions(spark.read.parquet(f"{ready}/{name}"), _path(lake, "gold", name), column, values)
    OUT.delete_folder(spark, ready)


def refresh_users(spark: SparkSession, lake: str, silver: DataFrame, days: Iterable[date | None]) -> None:
    """Move the totals per user from the former rows of some days to ``silver``, all their rows now.

    The former daily totals are taken back and the new ones added, so only the parts of
    ``gold/user_totals`` that hold a changed user are read and rewritten, and older days are read
    only for users whose first or last row was taken back. A step that breaks can be run again: the
    new rows are prepared beside the tables first, and putting them in place can be repeated.
    """
    _finish_users(spark, lake)
    days = set(days)
    ready = _path(lake, "gold", "_user_refresh")

    def prepared(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{ready}/{name}")
        return spark.read.schema(df.schema).parquet(f"{ready}/{name}")

    after = prepared(G.user_days(silver), "user_days")
    fresh = G.user_totals(after)
    bucket = OUT.bucket_of("user_id", USER_BUCKETS)
    known = _stored(spark, _path(lake, "gold", "user_days"), after.schema)
    totals = _stored(
        spark, _path(lake, "gold", "user_totals"), fresh.withColumn("bucket", bucket).schema
    )
    kept = known.filter(~_on_days(days)) if known is not None else None
    everything = after if kept is None else kept.unionByName(after)
    if totals is None or known is None:
        changed = G.user_totals(everything)
        buckets = list(range(USER_BUCKETS))
    else:
        changes = prepared(G.user_changes(known.filter(_on_days(days)), after), "changes")
        buckets = sorted(r["b"] for r in changes.select(bucket.alias("b")).distinct().collect())
        touched = totals.filter(F.col("bucket").isin(buckets)).drop("bucket")
        changed = prepared(G.apply_user_changes(touched, changes), "moved")
        if changed.filter("_open").isEmpty():
            changed = changed.drop("_open")
        else:
            changed = G.look_up_extremes(changed, everything)
    prepared(changed.withColumn("bucket", bucket), "user_totals")
    done = [("user_days", sorted(days, key=str), None), ("user_totals", None, buckets)]
    prepared(spark.createDataFrame(done, "kind string, days array<date>, buckets array<int>"), "done")
    _finish_users(spark, lake)


def user_summary(spark: SparkSession, lake: str) -> DataFrame:
    """The user summary from the kept totals, without a shuffle."""
    return G.summary_of_totals(spark.read.parquet(_path(lake, "gold", "user_totals")))


def load_gold(
    spark: SparkSession,
    lake: str,
    first_day: str,
    last_day: str | None = None,
    also: Iterable[date | None] = (),
) -> dict[str, int]:
    """Refresh the four aggregates for all days on which the rows loaded for some days happened.

    A row may arrive in a later day's load than the day it happened on. So every day that a
    loaded row touches, and every day of ``also`` (those that replaced rows touched), is computed
    anew from all of silver's rows of that day; a day on which no row is left goes. User totals
    move by the differences (``refresh_users``); the trend is combined from rows per day and
    currency.
    """

    def at(name: str) -> str:
        return _path(lake, "gold", name)

    days = event_days(spark, lake, first_day, last_day) | set(also)
    silver = spark.read.parquet(_path(lake, "silver", "transactions")).filter(_happened_on(days))
    OUT.replace_partitions(G.daily_base(silver), at("daily_base"), "date", days)
    refresh_users(spark, lake, silver, days)
    hourly = G.hourly_rates(silver).withColumn(
        "date", F.to_date((F.expr("hour_bucket div 100")).cast("string"), "yyyyMMdd")
    )
    base = _stored(spark, at("daily_base"), G.daily_base(silver).schema)
    trend = G.daily_trend(base if base is not None else G.daily_base(silver))
    return {
        "daily_volume": OUT.replace_table(trend, at("daily_volume")),
        "user_summary": OUT.replace_table(user_summary(spark, lake), at("user_summary")),
        "hourly_rates": OUT.replace_partitions(hourly, at("hourly_rates"), "date", days),
        "anomaly_summary": OUT.replace_partitions(
            G.anomaly_summary(silver), at("anomaly_summary"), "date", days
        ),
    }


def run(
    spark: SparkSession, raw: str, lake: str, first_day: str | None = None, last_day: str | None = None
) -> dict:
    """Load all layers for some days (default yesterday) and return the row counts."""
    start = first_day or IN.yesterday()
    counts: dict = {"bronze": load_bronze(spark, raw, lake, start, last_day)}
    bronze = _days(spark.read.parquet(_path(lake, "bronze", "transactions")), start, last_day)
    Q.raise_if_failed(Q.run_all(bronze, Q.bronze_suite(), "bronze.transactions"))
    replaced = event_days(spark, lake, start, last_day)
    counts["silver"] = load_silver(spark, lake, start, last_day)
    silver = _days(spark.read.parquet(_path(lake, "silver", "transactions")), start, last_day)
    R.validate_silver(silver)
    Q.raise_if_failed(Q.run_all(silver, Q.silver_suite(), "silver.transactions"))
    counts["gold"] = load_gold(spark, lake, start, last_day, replaced)
    return counts
