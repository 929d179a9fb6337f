"""Joins: point in time, latest features, reference enrichment, orphan files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldseam.operators.ordered import micros, running_last
from goldseam.operators.refine import latest_per_key
from goldseam.schemas import FeatureView


def as_of_join(
    events: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    event_time: str,
    feature_time: str,
    columns: Sequence[str],
    ttl_seconds: int | None = None,
    feature_tiebreak: Sequence[str] = (),
    event_tiebreak: Sequence[str] = (),
) -> DataFrame:
    """For each event the latest feature row at or before it, if not older than the TTL.

    Both sides are stacked and the last feature row is carried forward: one shuffle on the
    key, no pair of rows is ever formed, and hot keys are spread by ``running_last``.
    """
    row = F.struct(F.col(feature_time).alias("_ft"), *columns)
    ties = [f"_tie{i}" for i in range(max(len(feature_tiebreak), len(event_tiebreak)))]

    def tie_columns(names: Sequence[str]) -> list:
        given = [F.col(n).cast("string").alias(t) for n, t in zip(names, ties)]
        return given + [F.lit(None).cast("string").alias(t) for t in ties[len(names) :]]

    right = features.select(
        *keys,
        micros(feature_time).alias("_t"),
        F.lit(0).alias("_side"),
        *tie_columns(feature_tiebreak),
        row.alias("_feature"),
    )
    left = events.select(
        *keys,
        micros(event_time).alias("_t"),
        F.lit(1).alias("_side"),
        *tie_columns(event_tiebreak),
        F.struct(*events.columns).alias("_event"),
    )
    both = right.unionByName(left, allowMissingColumns=True)
    order = ["_t", "_side", *ties]
    filled = running_last(both, keys, order, "_feature", "_last").filter("_side = 1")
    age = F.col("_t") - micros("_last._ft")
    valid = F.col("_last").isNotNull()
    if ttl_seconds is not None:
        valid = valid & (age <= ttl_seconds * 1_000_000)
    return filled.select(
        "_event.*",
        F.when(valid, F.col("_last._ft")).alias(feature_time),
        *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in columns],
    )


def historical_features(
    events: DataFrame,
    features: DataFrame,
    view: FeatureView,
    event_time: str = "event_timestamp",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Training rows with the values of a feature view (all or some of its columns) as they were
    known at each event. Rows without an entity or a time get none."""
    renamed = features.withColumnRenamed(view.timestamp, f"{view.name}_at")
    return as_of_join(
        events,
        renamed,
        view.entity,
        event_time,
        f"{view.name}_at",
        columns or view.features,
        view.ttl_seconds,
    )


def training_rows(
    events: DataFrame,
    views: Sequence[tuple[DataFrame, FeatureView, Sequence[str]]],
    event_time: str = "event_timestamp",
) -> DataFrame:
    """Events with features of several views, each as known at the event and within its own TTL."""
    for features, view, columns in views:
        events = historical_features(events, features, view, event_time, columns).drop(f"{view.name}_at")
    return events


def latest_features(
    features: DataFrame, keys: Sequence[str], time: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The online table: newest row per entity."""
    return latest_per_key(features, keys, [time, *tiebreak])


def with_latest(
    requests: DataFrame, online: DataFrame, keys: Sequence[str], defaults: dict[str, object]
) -> DataFrame:
    """Attach the newest features; missing values get their defaults (a value or a column)."""
    joined = requests.join(online, list(keys), "left")
    filled = {
        name: F.coalesce(name, value if not isinstance(value, (int, float, str)) else F.lit(value))
        for name, value in defaults.items()
    }
    return joined.withColumns(filled) if filled else joined


def with_reference(
    df: DataFrame, reference: DataFrame, key: str, reference_key: str, columns: Sequence[str]
) -> DataFrame:
    """Left join of a reference table.

    No broadcast is forced: Spark measures the reference and broadcasts it while it is
    below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise joins by sorting with
    skew handling.
    """
    small = reference.select(F.col(reference_key).alias(key), *columns)
    return df.join(small, key, "left")


def orphan_files(
    files: DataFrame,
    references: DataFrame,
    path: str = "full_path",
    key: str = "key",
    reference: str = "path",
    keep_suffixes: Sequence[str] = (".metadata.json", "version-hint.text"),
) -> DataFrame:
    """Listed files that no reference names by path or by key, metadata files excepted.

    The either-or becomes two equi anti joins.
    """
    known = references.select(F.col(reference).alias("_ref")).distinct()
    found = files
    for suffix in keep_suffixes:
        found = found.filter(~F.col(key).endswith(suffix))
    for column in (path, key):
        found = found.join(known, found[column] == known["_ref"], "left_anti")
    return found


def missing_members(expected: DataFrame, existing: DataFrame, column: str) -> DataFrame:
    """Expected values that do not exist."""
    return expected.select(column).distinct().join(
        existing.select(column).distinct(), column, "left_anti"
    )
