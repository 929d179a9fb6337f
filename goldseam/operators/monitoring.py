"""Operational metrics and alert rules. Rows are first reduced to time buckets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldseam.functions import columns as X
from goldseam.operators.ordered import cell_of, micros

HOUR = 3_600


def hourly_volume(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(F.date_trunc("hour", time).alias("hour")).agg(
        F.count(F.lit(1)).alias("n")
    )


def low_volume(hourly: DataFrame, share: float = 0.5) -> DataFrame:
    """Hours below a share of the mean of all earlier hours."""
    before = Window.partitionBy(F.lit(0)).orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    mean = F.avg("n").over(before)
    return hourly.select(
        "hour", "n", mean.alias("avg_n"), F.coalesce(F.col("n") < mean * share, F.lit(False)).alias("low")
    )


def ingestion_gaps(df: DataFrame, time: str, seconds: int = HOUR) -> DataFrame:
    """Gaps longer than a limit between consecutive rows.

    A gap longer than a bucket cannot lie inside one, so comparing the last row of each
    bucket with the first of the next is exact, and only bucket ends are ordered.
    """
    width = seconds * 1_000_000
    ends = (
        df.select(time, micros(time).alias("_t"))
        .groupBy(cell_of("_t", width).alias("_b"))
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    )
    line = Window.partitionBy(F.lit(0)).orderBy("_b")
    gaps = ends.select(
        F.col("_last").alias("gap_start"), F.lead("_first").over(line).alias("gap_end")
    )
    length = (micros("gap_end") - micros("gap_start")) / F.lit(1_000_000.0)
    return gaps.withColumn("gap_seconds", length).filter(F.col("gap_seconds") > seconds)


def islands(
    df: DataFrame, bucket: str, condition: Column, step_seconds: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Runs of consecutive buckets in which a condition holds."""
    times = df.filter(condition).withColumn("_t", micros(bucket))
    hits = times.withColumn("_i", cell_of("_t", step_seconds * 1_000_000))
    line = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy("_i")
    runs = hits.withColumn("_run", F.col("_i") - F.row_number().over(line))
    return runs.groupBy(*keys, "_run").agg(
        F.min(bucket).alias("run_start"),
        F.max(bucket).alias("run_end"),
        F.count(F.lit(1)).alias("buckets"),
    ).drop("_run")


def held_for(runs: DataFrame, buckets: int) -> DataFrame:
    """Runs that lasted long enough to fire."""
    return runs.filter(F.col("buckets") >= buckets)


def sla_compliance(df: DataFrame, duration: str | Column, limit: float, ended: str) -> DataFrame:
    """Share of runs within the limit and the end of the last one that was."""
    value = F.col(duration) if isinstance(duration, str) else duration
    met = value <= limit
    return df.agg(
        F.count(value).alias("runs"),
        F.avg(met.cast("int")).alias("compliance"),
        F.max(F.when(met, F.col(ended))).alias("last_success"),
    )


def detected_vs_injected(df: DataFrame, day: Column, detected: Column, injected: Column) -> DataFrame:
    return df.groupBy(day.alias("date")).agg(
        F.count_if(detected).alias("detected"),
        F.count_if(injected).alias("injected"),
        F.count_if(detected & injected).alias("both"),
    )


def topic_stats(df: DataFrame, topic: str, value: str, offset: str) -> DataFrame:
    """Messages per topic and the last one."""
    return df.groupBy(topic).agg(
        F.count(F.lit(1)).alias("messages"), F.max_by(value, offset).alias("last_message")
    )


def consumer_lag(offsets: DataFrame, group: str, topic: str, limit: int = 10_000) -> DataFrame:
    """Largest lag per group and topic from (latest, committed) per partition."""
    lag = F.col("latest") - F.col("committed")
    return offsets.groupBy(group, topic).agg(F.max(lag).alias("max_lag")).withColumn(
        "critical", F.col("max_lag") > limit
    )


def concept_drift(daily: DataFrame, day: str = "date", rows: int = 7) -> DataFrame:
    """F1 over the last days from daily tp, fp and fn."""
    frame = Window.partitionBy(F.lit(0)).orderBy(day).rowsBetween(-(rows - 1), 0)
    sums = {n: F.sum(n).over(frame) for n in ("tp", "fp", "fn")}
    f1 = X.ratio(sums["tp"] * 2, sums["tp"] * 2 + sums["fp"] + sums["fn"])
    return daily.select(
        day, *[c.alias(f"{n}_7d") for n, c in sums.items()], F.coalesce(f1, F.lit(0.0)).alias("f1_7d")
    )


@dataclass(frozen=True)
class AlertRule:
    """Fires when the value of a one-row metric is above (or below) a limit."""

    alert: str
    severity: str
    metric: str
    limit: float
    team: str = "data-engineering"
    #: How long the condition has to hold before the alert fires.
    held_seconds: int = 300


# Names, severities, limits and holding times of the alerts.
ALERT_RULES = (
    AlertRule("HighConsumerLag", "critical", "consumer_lag", 10_000),
    AlertRule("NoDataIngestion", "critical", "ingestion_age_seconds", 3_600),
    AlertRule("InferenceServiceCritical", "critical", "latency_p95_seconds", 0.5, "ml-engineering"),
    AlertRule("DataDriftDetected", "warning", "max_psi", 0.2, "ml-engineering", 900),
    AlertRule("ModelStaleness", "warning", "model_age_seconds", 2_592_000, "ml-engineering", 3_600),
    AlertRule("DataQualityDegraded", "warning", "failed_share", 0.05, held_seconds=600),
    AlertRule("LowTransactionVolume", "info", "low_volume", 0, held_seconds=1_800),
)

# Receivers by severity.
ALERT_ROUTES = (
    ("critical", "pagerduty-critical"),
    ("critical", "slack-data-alerts"),
    ("warning", "slack-data-alerts"),
    ("warning", "email-data-team"),
    ("info", "slack-data-alerts"),
)


def evaluate_alerts(metrics: dict[str, DataFrame], rules: Sequence[AlertRule] = ALERT_RULES) -> DataFrame:
    """One row per rule from one-row frames with a ``value`` column."""
    frames = []
    for rule in rules:
        if rule.metric not in metrics:
            continue
        value = F.col("value").cast("double")
        frames.append(
            metrics[rule.metric].select(
                F.lit(rule.alert).alias("alert"),
                F.lit(rule.severity).alias("severity"),
                F.lit(rule.team).alias("team"),
                F.coalesce(value > rule.limit, F.lit(False)).alias("fired"),
                value.alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def alert_timeline(
    series: DataFrame, rules: Sequence[AlertRule] = ALERT_RULES, step_seconds: int = 60
) -> DataFrame:
    """State of every alert and label set at each of its evaluations.

    ``series`` has one row (alert, labels, at, value) per evaluation, as a rollup gives them. The
    condition holds while the value exceeds the rule's limit; a null value, an evaluation left out
    (more than ``step_seconds`` between two) or an alert without a rule ends it. It is pending until
    it has held as long as the rule asks, then firing; the first evaluation after that without it is
    resolved, others are inactive. ``active_since`` is the start of the present run.
    """

    def of_rule(name: str) -> Column:
        known = [x for r in rules for x in (F.lit(r.alert), F.lit(float(getattr(r, name))))]
        return F.try_element_at(F.create_map(*known), F.col("alert"))

    line = Window.partitionBy("alert", "labels").orderBy("at")
    now = micros("at")
    marked = series.withColumns(
        {
            "_holds": F.coalesce(F.col("value") > of_rule("limit"), F.lit(False)),
            "_apart": now - F.lag(now).over(line) > step_seconds * 1_000_000,
        }
    )
    goes_on = F.lag("_holds").over(line) & ~F.col("_apart")
    began = F.col("_holds") & ~F.coalesce(goes_on, F.lit(False))
    since = F.last(F.when(began, F.col("at")), ignorenulls=True).over(line)
    marked = marked.withColumn("active_since", F.when(F.col("_holds"), since))
    held = micros("at") - micros("active_since") >= of_rule("held_seconds") * 1_000_000
    marked = marked.withColumn("_fires", F.col("_holds") & F.coalesce(held, F.lit(False)))
    state = (
        F.when(F.col("_fires"), "firing")
        .when(F.col("_holds"), "pending")
        .when(F.lag("_fires").over(line), "resolved")
        .otherwise("inactive")
    )
    return marked.withColumn("state", state).select(*series.columns, "active_since", "state")


def alert_states(
    series: DataFrame, now: Column, rules: Sequence[AlertRule] = ALERT_RULES, step_seconds: int = 60
) -> DataFrame:
    """One row per alert and label set: its state at ``now``, and how often and when last it fired.

    A label set that was not evaluated within ``step_seconds`` before ``now`` does not hold any more;
    it is resolved if it ever fired. The severity and team come from the rule.
    """
    timeline = alert_timeline(series, rules, step_seconds)
    fires = F.col("state") == "firing"
    last = timeline.groupBy("alert", "labels").agg(
        F.max_by(F.struct("at", "value", "active_since", "state"), "at").alias("_l"),
        F.count_distinct(F.when(fires, F.col("active_since"))).alias("times_fired"),
        F.max(F.when(fires, F.col("at"))).alias("last_fired"),
    )
    fresh = micros(now) - micros(F.col("_l.at")) <= step_seconds * 1_000_000
    active = fresh & F.col("_l.state").isin("firing", "pending")
    state = (
        F.when(active, F.col("_l.state"))
        .when(F.col("last_fired").isNotNull(), "resolved")
        .otherwise("inactive")
    )
    texts = {n: F.create_map(*[x for r in rules for x in (F.lit(r.alert), F.lit(getattr(r, n)))]) for n in ("severity", "team")}
    return last.select(
        "alert",
        "labels",
        *[F.try_element_at(m, F.col("alert")).alias(n) for n, m in texts.items()],
        state.alias("state"),
        F.col("_l.value").alias("value"),
        F.when(active, F.col("_l.active_since")).alias("active_since"),
        "times_fired",
        "last_fired",
    )


def route_alerts(alerts: DataFrame, routes: Sequence[tuple[str, str]] = ALERT_ROUTES) -> DataFrame:
    """Fired alerts with each receiver of their severity.

    An alert is silenced while the same alert fires at the next higher severity. Routes are
    a handful of constants, so they are expanded in place.
    """
    # Which severity silences which.
    silenced_by = {"warning": "critical", "info": "warning"}
    fired = alerts.filter("fired")
    above = F.lit(None).cast("string")
    for low, high in silenced_by.items():
        above = F.when(F.col("severity") == low, high).otherwise(above)
    louder = fired.select(F.col("alert").alias("_a"), F.col("severity").alias("_s")).distinct()
    kept = fired.withColumn("_above", above).join(
        louder, (F.col("alert") == F.col("_a")) & (F.col("_above") == F.col("_s")), "left_anti"
    )
    receivers = F.array(
        *[F.struct(F.lit(s).alias("s"), F.lit(r).alias("receiver")) for s, r in routes]
    )
    matching = F.filter(receivers, lambda x: x["s"] == F.col("severity"))
    routed = kept.select("alert", "severity", "value", F.explode(matching).alias("_route"))
    return routed.select("alert", "severity", "value", F.col("_route.receiver").alias("receiver"))
