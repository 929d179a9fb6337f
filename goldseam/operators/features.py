"""Feature views: producers, on-demand features, materialisation, serving vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldseam.functions import columns as X
from goldseam.operators.ordered import (
    SLIDING_ROWS,
    cell_of,
    fits_one_task,
    join_whole,
    micros,
    rolling,
    running_sums,
    span_totals,
)
from goldseam.operators.refine import latest_per_key
from goldseam.session import materialize

DAY = 86_400
HOUR = 3_600


def user_features(
    df: DataFrame,
    as_of: Column,
    user: str = "user_id",
    time: str = "timestamp",
    amount: str = "amount_brl",
    currency: str = "currency",
    side: str = "transaction_type",
    users: DataFrame | None = None,
    days: int = 30,
) -> DataFrame:
    """Statistics of the last ``days`` days before a moment, one row per user.

    ``users`` (user, registration_date, tier) adds the age of the account and the tier.
    Amounts are grouped by user and currency first, so the preferred currency needs no
    window over transactions.
    """
    start = as_of - F.make_dt_interval(F.lit(days))
    recent = df.filter((F.col(time) > start) & (F.col(time) <= as_of))
    per_currency = recent.groupBy(user, F.col(currency).alias("_cur")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(amount).alias("_v"),
        F.count_if(F.col(side) == "BUY").alias("_buy"),
        F.count_if(F.col(side) == "SELL").alias("_sell"),
        F.max(time).alias("_last"),
    )
    result = per_currency.groupBy(user).agg(
        F.sum("_n").alias("total_transactions_30d"),
        F.sum("_v").cast("double").alias("total_volume_30d"),
        X.ratio(F.sum("_v"), F.sum("_n")).alias("avg_ticket_30d"),
        # Most frequent first; equal counts resolve alphabetically.
        F.min_by("_cur", F.struct(-F.col("_n"), F.col("_cur"))).alias("preferred_currency"),
        F.sum("_buy").alias("transaction_count_buy"),
        F.sum("_sell").alias("transaction_count_sell"),
        F.max("_last").alias("event_timestamp"),
    )
    if users is None:
        return result
    age = F.datediff(F.to_date(as_of), F.to_date("registration_date"))
    return (
        result.join(users.select(user, "registration_date", "tier"), user, "left")
        .withColumn("days_since_registration", age.cast("long"))
        .drop("registration_date")
    )


def currency_features(
    hourly: DataFrame,
    currency: str = "currency",
    hour: str = "hour_start",
    rate: str = "rate",
    spread: str = "spread",
    volume: str = "volume",
) -> DataFrame:
    """Rate features per currency and hour, from a table with one row per currency-hour.

    A currency has at most one row per hour, so these windows stay small however many
    transactions lie behind an hour.
    """
    by = Window.partitionBy(currency).orderBy("_h")

    def past(hours: int) -> Column:
        frame = by.rangeBetween(Window.unboundedPreceding, -hours)
        return F.last(rate).over(frame)

    day = by.rangeBetween(-23, 0)
    week = by.rangeBetween(-(24 * 7 - 1), 0)
    rows = hourly.withColumn("_t", micros(hour)).withColumn("_h", cell_of("_t", HOUR * 1_000_000))
    return rows.select(
        currency,
        F.col(hour).alias("event_timestamp"),
        F.col(rate).alias("current_rate"),
        X.change_pct(rate, past(1)).alias("rate_change_1h"),
        X.change_pct(rate, past(24)).alias("rate_change_24h"),
        F.stddev(rate).over(week).alias("volatility_7d"),
        F.avg(spread).over(week).alias("avg_spread"),
        F.sum(volume).over(day).alias("volume_24h"),
    )


def span_changes(df: DataFrame, key: str, time: str, item: str, span_seconds: int) -> DataFrame:
    """``key, _t, _change``: where the number of distinct items in the last span goes up or down.

    An occurrence counts from its time to the earlier of its expiry, a microsecond after the span,
    and the item's next occurrence, which takes over. So each occurrence is +1 at its own time and -1
    at that end, and the running sum at a time is the number of distinct items in the span before it.
    """
    seen = df.select(key, F.col(item).alias("_item"), micros(time).alias("_t")).dropna(subset=["_item", "_t"]).distinct()

    def until_next(rows: DataFrame, window) -> DataFrame:
        return rows.withColumn("_next", F.lag("_t", 1).over(window))

    ends = rolling(seen, [key, "_item"], ["-_t"], 1, until_next)
    end = F.least(F.col("_t") + (span_seconds * 1_000_000 + 1), F.col("_next"))
    both = F.array(
        F.struct(F.col("_t"), F.lit(1).cast("long").alias("_change")),
        F.struct(end.alias("_t"), F.lit(-1).cast("long").alias("_change")),
    )
    changes = ends.select(key, F.inline(both))
    return changes.groupBy(key, "_t").agg(F.sum("_change").alias("_change")).where("_change <> 0")


def distinct_over_span(
    df: DataFrame, key: str, time: str, item: str, span_seconds: int, output: str
) -> DataFrame:
    """Distinct items of a key within [t - span, t], one row per (key, time).

    Null items do not count. Rows without a time are one more moment of their key.
    """
    points = df.select(key, time, micros(time).alias("_t"), F.lit(0).cast("long").alias("_change")).distinct()
    changes = span_changes(df, key, time, item, span_seconds)
    line = points.where("_t IS NOT NULL").unionByName(changes, allowMissingColumns=True)
    line = line.groupBy(key, "_t").agg(F.max(time).alias(time), F.sum("_change").alias("_change"))
    timed = running_sums(line, [key], ["_t"], {output: "_change"}).where(F.col(time).isNotNull())
    untimed = df.where(F.col(time).isNull()).groupBy(key, time).agg(F.count_distinct(item).alias(output))
    return timed.select(key, time, F.col(output).cast("long").alias(output)).unionByName(untimed)


def pattern_features(
    df: DataFrame,
    user: str = "user_id",
    time: str = "timestamp",
    amount: str = "amount_brl",
    currency: str = "currency",
    night_until: int = 6,
) -> DataFrame:
    """Rolling behaviour of a user at each of their event times."""
    night = F.when(F.hour(time) < night_until, 1).otherwise(0)
    if fits_one_task(df, [user], SLIDING_ROWS):
        return _patterns_in_one_pass(df, user, time, amount, currency, night)
    hour = span_totals(
        df, [user], time, HOUR, amount, ("transactions_last_1h", "_s1"), cells=1
    ).drop("_s1")
    day = span_totals(df, [user], time, DAY, amount, ("_n24", "_s24"), cells=24)
    kinds = distinct_over_span(df, user, time, currency, 7 * DAY, "distinct_currencies_last_7d")
    per_time = df.groupBy(user, time).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(night).alias("_night")
    )
    upto = running_sums(per_time, [user], [time], {"_all": "_n", "_nights": "_night"})
    joined = hour
    for part in (day, kinds, upto):
        joined = join_whole(joined, part, [user, time])
    return _pattern_columns(joined, user, time)


def _pattern_columns(df: DataFrame, user: str, time: str) -> DataFrame:
    return df.select(
        user,
        F.col(time).alias("event_timestamp"),
        "transactions_last_1h",
        X.ratio("_s24", "_n24").alias("avg_amount_last_24h"),
        "distinct_currencies_last_7d",
        X.ratio("_nights", "_all").alias("night_transaction_ratio"),
    )


def _patterns_in_one_pass(
    df: DataFrame, user: str, time: str, amount: str, currency: str, night: Column
) -> DataFrame:
    """All frames share one shuffle and one sort by user and time."""
    points = (
        df.withColumn("_t", micros(time))
        .groupBy(user, time, "_t")
        .agg(
            F.count(amount).alias("_n"),
            F.sum(amount).alias("_s"),
            F.count(F.lit(1)).alias("_rows"),
            F.sum(night).alias("_night"),
        )
    )
    # Rises and falls of the distinct currencies stand in the same line, so one sort serves all.
    changes = span_changes(df, user, time, currency, 7 * DAY)
    sums = [F.sum(c).alias(c) for c in ("_n", "_s", "_rows", "_night", "_change")]
    line_of = points.unionByName(changes, allowMissingColumns=True).groupBy(user, "_t")
    points = line_of.agg(F.max(time).alias(time), *sums)
    line = Window.partitionBy(user).orderBy("_t")
    hour, day = (line.rangeBetween(-s * 1_000_000, 0) for s in (HOUR, DAY))
    upto = line.rangeBetween(Window.unboundedPreceding, 0)
    framed = points.withColumns(
        {
            "transactions_last_1h": F.sum("_n").over(hour),
            "_n24": F.sum("_n").over(day),
            "_s24": F.sum("_s").over(day),
            "distinct_currencies_last_7d": F.coalesce(F.sum("_change").over(upto), F.lit(0).cast("long")),
            "_all": F.sum("_rows").over(upto),
            "_nights": F.sum("_night").over(upto),
        }
    )
    return _pattern_columns(framed.where("_rows IS NOT NULL"), user, time)


def user_history(
    df: DataFrame, user: str = "user_id", time: str = "timestamp", amount: str = "amount_brl"
) -> DataFrame:
    """Totals of a user's last 30 days at each of their event times."""
    totals = span_totals(
        df, [user], time, 30 * DAY, amount, ("total_transactions_30d", "total_volume_30d"), cells=30
    )
    return totals.select(
        user,
        F.col(time).alias("event_timestamp"),
        "total_transactions_30d",
        "total_volume_30d",
        X.ratio("total_volume_30d", "total_transactions_30d").alias("avg_ticket_30d"),
    )


def training_signals(rows: DataFrame) -> DataFrame:
    """Model inputs that come from the stored views, for rows with point-in-time features."""
    return rows.withColumns(
        {
            "velocity_1h": F.col("transactions_last_1h"),
            "z_score_amount": X.share_z("avg_amount_last_24h", "avg_ticket_30d"),
        }
    )


def average_over_span(
    df: DataFrame, keys: Sequence[str], time: str, value: str, span_seconds: int, output: str
) -> DataFrame:
    """Mean of the values within [t - span, t], one row per (key, time)."""
    totals = span_totals(df, keys, time, span_seconds, value, ("_n", "_s"), cells=24)
    return totals.select(*keys, time, X.ratio("_s", "_n").alias(output))


def history_zscore(
    df: DataFrame,
    user: str,
    time: str,
    amount: str,
    tiebreak: str,
    scale: int | None = None,
    output: str = "z_score",
) -> DataFrame:
    """Distance of an amount from the user's earlier amounts, in sample deviations.

    Sums of exact decimals are carried, so the variance does not lose digits. Amounts keep
    ``scale`` decimals: by default those of a decimal type, six at most, and four of a double.
    """
    if scale is None:
        kind = df.schema[amount].dataType
        scale = min(kind.scale, 6) if isinstance(kind, T.DecimalType) else 4
    fine = f"decimal(38,{min(2 * scale, 6)})"
    exact = F.col(amount).cast(f"decimal(18,{scale})")
    rows = df.withColumns(
        {"_x": exact, "_xx": (exact * exact).cast(f"decimal(36,{2 * scale})"), "_one": F.lit(1)}
    )
    sums = running_sums(
        rows, [user], [time, tiebreak], {"_n": "_one", "_s": "_x", "_ss": "_xx"}, False
    )
    count = F.col("_n").cast("decimal(18,0)")
    # n * sum of squares - square of the sum is exact; only the last steps are floating.
    spread = (count * F.col("_ss").cast(f"decimal(30,{2 * scale})")).cast(fine) - (
        F.col("_s").cast(f"decimal(18,{scale})") * F.col("_s").cast(f"decimal(18,{scale})")
    ).cast(fine)
    variance = F.try_divide(spread.cast("double"), (F.col("_n") * (F.col("_n") - 1)).cast("double"))
    mean = X.ratio("_s", "_n")
    z = X.history_z(exact.cast("double"), mean, F.sqrt(variance))
    return sums.withColumn(output, F.when(F.col("_n") >= 2, z)).drop(
        "_x", "_xx", "_one", "_n", "_s", "_ss"
    )


def on_demand(users: DataFrame, patterns: DataFrame, user: str = "user_id") -> DataFrame:
    """Signals computed from two feature views at request time."""
    joined = users.join(patterns, user)
    return joined.select(
        user,
        X.share_z("avg_amount_last_24h", "avg_ticket_30d").alias("z_score_amount"),
        X.night_by_ratio("night_transaction_ratio").alias("is_unusual_hour"),
        X.velocity_score("transactions_last_1h", "total_transactions_30d").alias("velocity_score"),
    )


def materialize_view(
    features: DataFrame,
    keys: Sequence[str],
    time: str,
    start: Column | None,
    end: Column,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Newest row per entity within a window; ``start`` is the previous high-water mark."""
    window = features.filter(F.col(time) <= end)
    if start is not None:
        window = window.filter(F.col(time) > start)
    return latest_per_key(window, keys, [time, *tiebreak])


def refresh_online(
    online: DataFrame, features: DataFrame, keys: Sequence[str], time: str, end: Column
) -> DataFrame:
    """Incremental refresh from the high-water mark of the stored table up to ``end``; an empty
    table is filled from all features."""
    mark = online.agg(F.max(time).alias("m")).scalar()
    fresh = features.filter((mark.isNull() | (F.col(time) > mark)) & (F.col(time) <= end))
    return latest_per_key(online.unionByName(fresh), keys, [time])


def view_freshness(views: DataFrame, now: Column, max_hours: float = 2.0) -> DataFrame:
    """FRESH, STALE or UNKNOWN per view from (view, last_updated)."""
    age = (micros(now) - micros("last_updated")) / F.lit(3_600_000_000.0)
    status = (
        F.when(F.col("last_updated").isNull(), "UNKNOWN")
        .when(age > max_hours, "STALE")
        .otherwise("FRESH")
    )
    return views.select("view", "last_updated", age.alias("hours_since_update"), status.alias("status"))


def serving_vector(
    df: DataFrame,
    time: str = "timestamp",
    amount: str = "amount_brl",
    spread: str = "spread_pct",
    monday_first: bool = True,
    first_hour: int = 8,
    last_hour: int = 18,
) -> DataFrame:
    """The model's input from a request and its features; a zero or missing spread is 0.01."""
    open_hours = X.business_hours(time, first_hour, last_hour)
    given = F.when(F.col(spread) != 0, F.col(spread).cast("double"))
    value = F.col(amount).cast("double")
    return df.withColumns(
        {
            "hour_of_day": F.hour(time).cast("double"),
            "day_of_week": X.day_of_week(time, monday_first).cast("double"),
            "is_business_hours": open_hours.cast("int").cast("double"),
            "spread_pct": F.coalesce(given, F.lit(0.01)),
            "velocity_1h": F.coalesce(F.col("transactions_last_1h").cast("double"), F.lit(0.0)),
            "z_score_amount": X.serving_z(value, "avg_ticket_30d", "avg_amount_last_24h"),
            "amount_brl": value,
        }
    )


def feature_matrix(
    df: DataFrame, features: Sequence[str], label: str = "is_anomaly", keep: Sequence[str] = ()
) -> DataFrame:
    """The model columns as doubles: absent columns and nulls become zero."""
    columns = [
        F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(f)
        if f in df.columns
        else F.lit(0.0).alias(f)
        for f in features
    ]
    target = F.coalesce(F.col(label).cast("int"), F.lit(0)) if label in df.columns else F.lit(0)
    return df.select(*keep, *columns, target.alias("label"))


def fit_moments(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per feature: one aggregate, one row to the driver."""
    row = df.agg(
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in features],
    ).first()
    return {f: (row[f"m_{f}"] or 0.0, row[f"s_{f}"] or 1.0) for f in features}


def apply_moments(df: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    scaled = {f: (F.col(f) - F.lit(m)) / F.lit(s) for f, (m, s) in moments.items()}
    return df.withColumns(scaled)


def standardize(
    df: DataFrame, features: Sequence[str], fit_on: Column | None = None
) -> DataFrame:
    """Zero mean and unit population deviation; constant columns only lose their mean.

    The moments are taken over all rows or over ``fit_on``.
    """
    base = df if fit_on is None else df.filter(fit_on)
    return apply_moments(df, fit_moments(base, features))


def rate_quotes(
    df: DataFrame, pair: str, time: str, rate: str, tiebreak: str, spread_share: float = 0.002
) -> DataFrame:
    """Change against the previous rate and a bid and ask half a spread around the rate."""

    def compute(rows: DataFrame, window) -> DataFrame:
        before = F.lag(rate, 1).over(window)
        half = before * spread_share / 2
        return rows.withColumns(
            {
                "pct_change": F.round(X.change_pct(rate, before), 6),
                "bid": F.round(F.col(rate) - half, 6),
                "ask": F.round(F.col(rate) + half, 6),
            }
        )

    return rolling(df, [pair], [time, tiebreak], 1, compute)


def _flag_changes(rows, window, change, window_rows, min_rows, deviations) -> DataFrame:
    """Flag changes more than some sample deviations from the last ones, itself included."""
    frame = window.rowsBetween(-(window_rows - 1), 0)
    count = F.count(change).over(frame)
    mean, spread = F.avg(change).over(frame), F.stddev(change).over(frame)
    far = F.abs(F.col(change) - mean) > F.lit(deviations) * spread
    flag = (count >= min_rows) & (spread > 0) & far
    return rows.withColumn("is_anomaly", F.coalesce(flag, F.lit(False)))


def rate_changes(
    df: DataFrame,
    pair: str,
    time: str,
    rate: str,
    tiebreak: str,
    window_rows: int = 20,
    min_rows: int = 5,
    deviations: float = 2.0,
) -> DataFrame:
    """Change against the previous rate and its rolling anomaly flag, in one ordered pass."""

    def compute(rows: DataFrame, window) -> DataFrame:
        changed = rows.withColumn("pct_change", X.change_pct(rate, F.lag(rate, 1).over(window)))
        return _flag_changes(changed, window, "pct_change", window_rows, min_rows, deviations)

    return rolling(df, [pair], [time, tiebreak], window_rows, compute)
