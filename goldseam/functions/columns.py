"""Column expressions: cleaning, derived columns, scores and simple formulas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip(value: str | Column, low: float, high: float) -> Column:
    """Bound a value, keeping nulls null."""
    bounded = F.least(F.greatest(_c(value), F.lit(low)), F.lit(high))
    return F.when(_c(value).isNotNull(), bounded)


def nonzero(value: str | Column, instead: float = 1.0) -> Column:
    """A divisor: zero is replaced."""
    return F.when(_c(value) == 0, F.lit(instead)).otherwise(_c(value))


def ratio(top: str | Column, bottom: str | Column) -> Column:
    """Division that gives null instead of an error when the divisor is zero."""
    return F.try_divide(_c(top).cast("double"), _c(bottom).cast("double"))


def change_pct(now: str | Column, before: str | Column) -> Column:
    """Relative change in percent, null without a usable base."""
    base = _c(before).cast("double")
    return F.try_divide((_c(now) - _c(before)).cast("double"), base) * 100


def day_of_week(time: str | Column, monday_first: bool = False) -> Column:
    """1 = Sunday by default, 1 = Monday for the serving vector."""
    return F.weekday(_c(time)) + 1 if monday_first else F.dayofweek(_c(time))


def business_hours(
    time: str | Column,
    first_hour: int = 9,
    last_hour: int = 17,
) -> Column:
    """Monday to Friday within the hours, both ends included."""
    hour = F.hour(_c(time))
    return (hour >= first_hour) & (hour <= last_hour) & (F.weekday(_c(time)) < 5)


def year_month(time: str | Column) -> Column:
    return F.year(_c(time)) * 100 + F.month(_c(time))


def hour_bucket(time: str | Column, as_number: bool = True) -> Column:
    """The hour as the number yyyymmddhh, or truncated to a timestamp."""
    value = _c(time)
    if not as_number:
        return F.date_trunc("hour", value)
    day = F.year(value) * 10_000 + F.month(value) * 100 + F.dayofmonth(value)
    return day.cast("long") * 100 + F.hour(value)


def usd_amount(amount: str | Column, rate: float = 5.0) -> Column:
    """Amount at a fixed rate, rounded half up to cents."""
    return F.round(_c(amount) / F.lit(rate), 2)


def risk_level(score: str | Column, high: float = 0.7, medium: float = 0.4) -> Column:
    value = _c(score)
    return F.when(value >= high, "high").when(value >= medium, "medium").otherwise("low")


def risk_flag(score: str | Column, medium: float = 0.4) -> Column:
    """Medium risk already counts as an anomaly."""
    return _c(score) >= medium


def score_from_raw(raw: str | Column, prediction: str | Column | None = None) -> Column:
    """Raw detector score to 0..1; without a score, 0.8 or 0.2 from the -1/+1 prediction."""
    scaled = clip(_c(raw) / F.lit(0.5), 0.0, 1.0)
    if prediction is None:
        return scaled
    return F.coalesce(scaled, F.when(_c(prediction) == -1, F.lit(0.8)).otherwise(F.lit(0.2)))


def min_max(value: str | Column, low: Column, high: Column) -> Column:
    return (_c(value) - low) / (high - low + F.lit(1e-9))


def outlier_to_label(prediction: str | Column) -> Column:
    """-1/+1 to 1/0."""
    return (_c(prediction) == -1).cast("int")


def iso_millis(text: str | Column) -> Column:
    """ISO-8601 text, read as UTC, to epoch milliseconds."""
    return F.unix_millis(F.try_to_timestamp(_c(text)))


def topic_table(topic: str | Column) -> Column:
    """Third part of a three-part topic name; other names stay as they are."""
    return F.regexp_replace(_c(topic), r"^([^.]+)\.([^.]+)\.([^.]+)$", "$3")


def to_number(text: str | Column) -> Column:
    """A number, or null where the text is not one."""
    return _c(text).try_cast("double")


def storage_usd(size_bytes: str | Column, usd_per_gib: float = 0.023) -> Column:
    """Monthly storage price of a number of bytes."""
    return _c(size_bytes) / F.lit(float(1 << 30)) * F.lit(usd_per_gib)


def job_usd(
    seconds: str | Column,
    nodes: int = 4,
    node_price: float = 0.052624,
    units: int = 16,
    unit_price: float = 0.0057785,
) -> Column:
    """Price of a job from its run time and hourly prices."""
    return _c(seconds) / F.lit(3600.0) * F.lit(nodes * node_price + units * unit_price)


def share_z(current: str | Column, average: str | Column) -> Column:
    """The on-demand view's score: recent average against the 30-day ticket, bounded to ±5."""
    mean = F.coalesce(_c(average), F.lit(0.0))
    spread = nonzero(F.coalesce(_c(current), mean))
    return clip((_c(current) - mean) / spread, -5.0, 5.0)


def serving_z(amount: str | Column, ticket: str | Column, recent: str | Column) -> Column:
    """The scoring service's score: 30 % of the recent average stands in for the spread."""
    spread = F.greatest(F.coalesce(_c(recent), _c(amount)) * 0.3, F.lit(1.0))
    return (_c(amount) - F.coalesce(_c(ticket), _c(amount))) / spread


def history_z(amount: str | Column, mean: str | Column, spread: str | Column) -> Column:
    """The catalog's score: distance from the user's own mean in standard deviations."""
    return F.try_divide(_c(amount) - _c(mean), _c(spread))


def velocity_score(last_hour: str | Column, last_month: str | Column) -> Column:
    """Transactions in the last hour against the daily norm, bounded to 0..20."""
    norm = nonzero(F.coalesce(_c(last_month), F.lit(0)) / F.lit(30.0))
    return clip(F.coalesce(_c(last_hour), F.lit(0)) / norm, 0.0, 20.0)


def night_by_ratio(ratio_column: str | Column, above: float = 0.5) -> Column:
    return F.coalesce(_c(ratio_column), F.lit(0.0)) > above


def night_by_hour(time: str | Column, first: int = 6, last: int = 23) -> Column:
    """The catalog's rule on the transaction's own hour."""
    hour = F.hour(_c(time))
    return (hour < first) | (hour > last)


def composite_score(f1: str | Column, p95_ms: str | Column, latency_weight: float = 0.2) -> Column:
    """F1 and latency in one figure; a missing or zero latency counts as 50 ms."""
    quality = F.coalesce(_c(f1), F.lit(0.0))
    slow = F.when(_c(p95_ms) != 0, _c(p95_ms)).otherwise(F.lit(50.0))
    speed = F.greatest(F.lit(0.0), F.lit(1.0) - slow / 100.0)
    return quality * (1 - latency_weight) + speed * latency_weight


def null_unless(condition: Column, value: str | Column) -> Column:
    return F.when(condition, _c(value))


def any_of(column: str | Column, allowed: Sequence[str]) -> Column:
    return _c(column).isin(*allowed)
