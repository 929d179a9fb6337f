"""Gold aggregates. Each groups once with partial aggregation; windows run on the groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldseam.functions import columns as X
from goldseam.operators.ordered import exact_quantiles, join_whole, running_sums
from goldseam.schemas import ANOMALY_SUMMARY


def daily_base(
    df: DataFrame,
    time: str = "timestamp",
    currency: str = "currency",
    amount: str = "amount_brl",
    key: str = "transaction_id",
    percentile: float = 0.95,
    accuracy: int = 10_000,
) -> DataFrame:
    """Volume statistics per day and currency. A day depends on its own rows only."""
    return df.groupBy(F.to_date(time).alias("date"), F.col(currency).alias("currency")).agg(
        F.sum(F.col(amount)).cast("decimal(18,2)").alias("total_volume_brl"),
        F.count(key).alias("transaction_count"),
        F.avg(amount).cast("double").alias("avg_amount"),
        F.min(amount).alias("min_amount"),
        F.max(amount).alias("max_amount"),
        F.percentile_approx(amount, percentile, accuracy).cast("double").alias("p95_amount"),
    )


def daily_trend(base: DataFrame, average_rows: int = 7, calendar_days: bool = False) -> DataFrame:
    """Add the day-over-day change and the moving average to daily statistics.

    The average covers the last ``average_rows`` days that have data, or calendar days.
    """
    by_currency = Window.partitionBy("currency")
    by_day = by_currency.orderBy("date")
    if calendar_days:
        frame = by_currency.orderBy(F.unix_date("date")).rangeBetween(-(average_rows - 1), 0)
    else:
        frame = by_day.rowsBetween(-(average_rows - 1), 0)
    volume = F.col("total_volume_brl")
    return base.withColumns(
        {
            "volume_change_pct": X.change_pct(volume, F.lag(volume, 1).over(by_day)),
            "ma7_volume_brl": F.avg(volume).over(frame).cast("double"),
        }
    )


def daily_volume(
    df: DataFrame,
    time: str = "timestamp",
    currency: str = "currency",
    amount: str = "amount_brl",
    key: str = "transaction_id",
    average_rows: int = 7,
    calendar_days: bool = False,
) -> DataFrame:
    """Daily statistics with their trend."""
    return daily_trend(daily_base(df, time, currency, amount, key), average_rows, calendar_days)


def user_days(
    df: DataFrame,
    user: str = "user_id",
    time: str = "timestamp",
    amount: str = "amount_brl",
    key: str = "transaction_id",
) -> DataFrame:
    """Mergeable totals per user and day."""
    return df.groupBy(F.col(user).alias("user_id"), F.to_date(time).alias("date")).agg(
        F.count(key).alias("transactions"),
        F.sum(amount).alias("volume"),
        F.count(amount).alias("amounts"),
        F.min(time).alias("first_at"),
        F.max(time).alias("last_at"),
    )


def user_totals(days: DataFrame) -> DataFrame:
    """Totals per user from daily totals, mergeable with further ones."""
    return days.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.sum("transactions").alias("transactions"),
        F.sum("volume").alias("volume"),
        F.sum("amounts").alias("amounts"),
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


def summary_of_totals(totals: DataFrame) -> DataFrame:
    """The user summary from totals per user."""
    return totals.select(
        "user_id",
        F.col("transactions").alias("total_transactions"),
        F.col("volume").cast("decimal(18,2)").alias("total_volume_brl"),
        F.try_divide("volume", "amounts").cast("double").alias("avg_transaction_brl"),
        F.col("first_at").alias("first_transaction_at"),
        F.col("last_at").alias("last_transaction_at"),
    )


def combine_user_days(days: DataFrame) -> DataFrame:
    """The user summary from daily totals."""
    return summary_of_totals(user_totals(days))


def user_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Signed changes per user when daily totals ``before`` are replaced by ``after``.

    Sums and counts are differences. The extremes of both sides stand beside them, as a minimum
    cannot be taken back by subtraction. Users whose totals stay as they are have no row.
    """
    sign, old = F.col("_sign"), F.col("_sign") < 0
    signed = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    changes = signed.groupBy("user_id").agg(
        F.sum(sign).alias("d_days"),
        *[F.sum(F.col(c) * sign).alias(f"d_{c}") for c in ("transactions", "volume", "amounts")],
        F.min(F.when(old, F.col("first_at"))).alias("old_first"),
        F.max(F.when(old, F.col("last_at"))).alias("old_last"),
        F.min(F.when(~old, F.col("first_at"))).alias("new_first"),
        F.max(F.when(~old, F.col("last_at"))).alias("new_last"),
    )
    same = F.col("old_first").eqNullSafe(F.col("new_first")) & F.col("old_last").eqNullSafe(F.col("new_last"))
    for column in ("d_days", "d_transactions", "d_volume", "d_amounts"):
        same = same & (F.coalesce(F.col(column), F.lit(0)) == 0)
    return changes.filter(~same)


def apply_user_changes(totals: DataFrame, changes: DataFrame) -> DataFrame:
    """New totals of all users of both sides, and ``_open``: whether their extremes must be looked up.

    An extreme stays open only if the row that held it was taken back and no new row reaches it.
    Users without a day left are gone. Volumes are exact for decimals and whole numbers.
    """
    old, new = totals.alias("t"), changes.alias("c")
    both = old.join(new, F.col("t.user_id").eqNullSafe(F.col("c.user_id")), "full_outer")

    def moved(column: str) -> Column:
        now = F.coalesce(F.col(f"t.{column}"), F.lit(0)) + F.coalesce(F.col(f"c.d_{column}"), F.lit(0))
        return now.cast(totals.schema[column].dataType)

    first, last = F.col("t.first_at"), F.col("t.last_at")
    lost_first = (F.col("c.old_first") <= first) & ~F.coalesce(F.col("c.new_first") <= first, F.lit(False))
    lost_last = (F.col("c.old_last") >= last) & ~F.coalesce(F.col("c.new_last") >= last, F.lit(False))
    amounts = moved("amounts")
    return both.select(
        F.coalesce("t.user_id", "c.user_id").alias("user_id"),
        moved("days").alias("days"),
        moved("transactions").alias("transactions"),
        F.when(amounts != 0, moved("volume")).alias("volume"),
        amounts.alias("amounts"),
        F.least(first, "c.new_first").alias("first_at"),
        F.greatest(last, "c.new_last").alias("last_at"),
        F.coalesce(lost_first | lost_last, F.lit(False)).alias("_open"),
    ).filter("days > 0")


def look_up_extremes(totals: DataFrame, days: DataFrame) -> DataFrame:
    """Totals with the extremes of open users taken from the daily totals; ``_open`` is dropped."""
    ids = totals.filter("_open").select(F.col("user_id").alias("_user"))
    theirs = days.join(ids, F.col("user_id").eqNullSafe(F.col("_user")), "left_semi")
    found = theirs.groupBy(F.col("user_id").alias("_user")).agg(
        F.min("first_at").alias("_first"), F.max("last_at").alias("_last")
    )
    both = totals.join(found, F.col("_open") & F.col("user_id").eqNullSafe(F.col("_user")), "left")
    ends = {
        "first_at": F.when(F.col("_open"), F.col("_first")).otherwise(F.col("first_at")),
        "last_at": F.when(F.col("_open"), F.col("_last")).otherwise(F.col("last_at")),
    }
    return both.withColumns(ends).select(*[c for c in totals.columns if c != "_open"])


def user_summary(
    df: DataFrame,
    user: str = "user_id",
    time: str = "timestamp",
    amount: str = "amount_brl",
    key: str = "transaction_id",
    currency: str | None = None,
) -> DataFrame:
    """Totals per user, optionally with the number of distinct currencies."""
    extra = [F.count_distinct(currency).alias("distinct_currencies")] if currency else []
    return df.groupBy(F.col(user).alias("user_id")).agg(
        F.count(key).alias("total_transactions"),
        F.sum(amount).cast("decimal(18,2)").alias("total_volume_brl"),
        F.avg(amount).cast("double").alias("avg_transaction_brl"),
        F.min(time).alias("first_transaction_at"),
        F.max(time).alias("last_transaction_at"),
        *extra,
    )


def hourly_rates(
    df: DataFrame,
    time: str = "timestamp",
    currency: str = "currency",
    rate: str = "exchange_rate",
    key: str = "transaction_id",
    as_number: bool = True,
) -> DataFrame:
    """Rate statistics per hour and currency; the volatility of a single row is null."""
    bucket = X.hour_bucket(time, as_number).alias("hour_bucket")
    return df.groupBy(bucket, F.col(currency).alias("currency")).agg(
        F.avg(rate).cast("double").alias("avg_rate"),
        F.min(rate).alias("min_rate"),
        F.max(rate).alias("max_rate"),
        F.stddev(rate).alias("volatility"),
        F.count(key).alias("transaction_count"),
    )


def anomaly_summary(
    df: DataFrame, time: str = "timestamp", flag: str = "is_anomaly", key: str = "transaction_id"
) -> DataFrame:
    """Anomalies per day; an empty table of the same columns when there is no flag."""
    if flag not in df.columns:
        empty = df.sparkSession.range(0)
        return empty.select(*[F.lit(None).cast(t).alias(n) for n, t in ANOMALY_SUMMARY.items()])
    counts = df.groupBy(F.to_date(time).alias("date")).agg(
        F.count(key).alias("total_transactions"),
        F.sum(F.col(flag).cast("long")).alias("total_anomalies"),
    )
    return counts.withColumn("anomaly_rate", X.ratio("total_anomalies", "total_transactions"))


def anomalies_by_type(
    df: DataFrame, time: str, kind: str, flag: str = "is_anomaly"
) -> DataFrame:
    """Anomalies per day and type."""
    return df.groupBy(F.to_date(time).alias("date"), F.col(kind).alias("anomaly_type")).agg(
        F.count_if(F.col(flag)).alias("anomalies")
    )


def daily_median(df: DataFrame, time: str, currency: str, amount: str) -> DataFrame:
    """Exact median per day and currency."""
    rows = df.select(F.to_date(time).alias("date"), F.col(currency).alias("currency"), amount)
    found = exact_quantiles(rows, ["date", "currency"], amount, [0.5])
    return found.select("date", "currency", F.col("quantiles")[0].alias("median_amount"))


def volume_rank(summary: DataFrame, volume: str = "total_volume_brl") -> DataFrame:
    """Rank and dense rank of every user by volume.

    Ranks come from cumulative counts over distinct volumes, so no task holds all users.
    """
    steps = summary.groupBy(volume).agg(F.count(F.lit(1)).alias("_n"), F.lit(1).alias("_one"))
    above = running_sums(
        steps, [], [f"-{volume}"], {"_above": "_n", "_dense": "_one"}, include_current=False
    )
    ranks = above.select(
        volume,
        (F.col("_above") + 1).alias("volume_rank"),
        (F.col("_dense") + 1).alias("dense_rank"),
    )
    return join_whole(summary, ranks, [volume])


def top_users(summary: DataFrame, n: int, volume: str = "total_volume_brl") -> DataFrame:
    """The ``n`` users with the largest volume."""
    return summary.orderBy(F.desc(volume), "user_id").limit(n)
