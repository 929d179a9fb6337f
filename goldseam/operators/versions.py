"""Versioned tables over a change log, and table maintenance.

A table keeps its history as rows ``(key, payload, _commit_id, _committed_at, _op)``,
partitioned by commit. Reading a version is a filter on the commit (pruned by partition)
and one grouping by key. A single writer per table is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldseam.functions import columns as X
from goldseam.operators.refine import latest_per_key

COMMIT, COMMITTED, OP = "_commit_id", "_committed_at", "_op"
META = (COMMIT, COMMITTED, OP)
TARGET_BYTES = 134_217_728
MIN_BYTES = 33_554_432


def _state(log: DataFrame, keys: Sequence[str], tiebreak: Sequence[str]) -> DataFrame:
    newest = latest_per_key(log, keys, [COMMIT, *tiebreak])
    return newest.filter(F.col(OP) != "delete")


def state_at_commit(
    log: DataFrame, keys: Sequence[str], commit: int | Column, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Live rows as of a commit."""
    return _state(log.filter(F.col(COMMIT) <= commit), keys, tiebreak)


def state_at_time(
    log: DataFrame, keys: Sequence[str], moment: Column, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Live rows as of a moment: the last commit at or before it."""
    return _state(log.filter(F.col(COMMITTED) <= moment), keys, tiebreak)


def current_state(
    log: DataFrame, keys: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    return _state(log, keys, tiebreak)


def rollback_changes(
    log: DataFrame, keys: Sequence[str], target: Column, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The changes that restore the state where ``target`` (a filter on the log) holds.

    Both versions of a key come out of one grouping over one scan. Appending the result as
    a new commit rolls back without losing later versions.
    """
    payload = [c for c in log.columns if c not in (*keys, *META)]
    row = F.struct(*payload, OP)
    place = F.struct(COMMIT, *tiebreak)
    pairs = log.groupBy(*keys).agg(
        F.max_by(row, place).alias("_now"),
        F.max_by(row, F.when(target, place)).alias("_then"),
    )
    live_now = F.col(f"_now.{OP}") != "delete"
    live_then = F.coalesce(F.col(f"_then.{OP}") != "delete", F.lit(False))
    same = F.lit(True)
    for name in payload:
        same = same & F.col(f"_now.{name}").eqNullSafe(F.col(f"_then.{name}"))
    action = F.when(live_then & ~(live_now & same), "upsert").when(~live_then & live_now, "delete")
    chosen = F.when(F.col("_undo") == "upsert", F.col("_then")).otherwise(F.col("_now"))
    return (
        pairs.withColumn("_undo", action)
        .filter("_undo is not null")
        .withColumn("_row", chosen)
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in payload], F.col("_undo").alias(OP))
    )


def append_commit(log: DataFrame, changes: DataFrame, moment: Column) -> DataFrame:
    """The log with ``changes`` as its next commit."""
    head = log.agg(F.max(COMMIT).alias("c")).scalar()
    stamped = changes.withColumn(COMMIT, head + 1).withColumn(COMMITTED, moment)
    return log.unionByName(stamped.select(*log.columns))


def incremental_read(log: DataFrame, after: int, upto: int | None = None) -> DataFrame:
    """Changes after one commit (exclusive) up to another (inclusive, default the last)."""
    changed = log.filter(F.col(COMMIT) > after)
    return changed if upto is None else changed.filter(F.col(COMMIT) <= upto)


def snapshots(log: DataFrame) -> DataFrame:
    """One row per commit with its parent and row counts by operation.

    The window runs over commits, not over rows.
    """
    commits = log.groupBy(COMMIT).agg(
        F.max(COMMITTED).alias("committed_at"),
        F.count_if(F.col(OP) != "delete").alias("added_rows"),
        F.count_if(F.col(OP) == "delete").alias("deleted_rows"),
    )
    in_order = Window.partitionBy(F.lit(0)).orderBy(COMMIT)
    operation = F.when(F.col("deleted_rows") == 0, "append").otherwise("overwrite")
    return commits.select(
        "committed_at",
        F.col(COMMIT).alias("snapshot_id"),
        F.lag(COMMIT).over(in_order).alias("parent_id"),
        operation.alias("operation"),
        "added_rows",
        "deleted_rows",
    ).orderBy(F.desc("committed_at"), F.desc("snapshot_id"))


def latest_commit(log: DataFrame) -> DataFrame:
    """The newest commit, one row."""
    newest = snapshots(log).select("snapshot_id", "committed_at")
    return newest.orderBy(F.desc("committed_at"), F.desc("snapshot_id")).limit(1)


def latest_commit_id(log: DataFrame) -> int:
    row = latest_commit(log).first()
    if row is None:
        raise ValueError("the table has no snapshots")
    return int(row["snapshot_id"])


def expire_plan(log: DataFrame, now: Column, days: int = 7, keep_last: int = 1) -> DataFrame:
    """Which commits are older than the retention and not among the last ``keep_last``."""
    listed = snapshots(log)
    newest_first = Window.partitionBy(F.lit(0)).orderBy(F.desc("committed_at"), F.desc("snapshot_id"))
    cutoff = now - F.make_dt_interval(F.lit(days))
    return (
        listed.withColumn("_place", F.row_number().over(newest_first))
        .withColumn("expired", (F.col("committed_at") < cutoff) & (F.col("_place") > keep_last))
        .select("snapshot_id", "committed_at", "expired")
    )


def squash(log: DataFrame, keys: Sequence[str], upto: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The log with all commits up to one replaced by their state; later reads are equal.

    Deletes at or before the commit leave no row, so expired data is gone from the result.
    """
    base = state_at_commit(log, keys, upto, tiebreak)
    stamped = base.withColumn(COMMIT, F.lit(upto).cast(log.schema[COMMIT].dataType))
    return stamped.unionByName(incremental_read(log, upto))


def compaction_plan(
    files: DataFrame,
    partition: str,
    size: str = "size",
    target: int = TARGET_BYTES,
    minimum: int = MIN_BYTES,
) -> DataFrame:
    """Per partition the small files, their bytes and the number of files to write."""
    small = F.col(size) < minimum
    plan = files.groupBy(partition).agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(small).alias("small_files"),
        F.sum(F.when(small, F.col(size)).otherwise(F.lit(0))).alias("small_bytes"),
    )
    wanted = F.greatest(F.ceil(F.col("small_bytes") / F.lit(target)), F.lit(1)).cast("long")
    return plan.withColumn("output_files", wanted).withColumn(
        "rewrite", F.col("small_files") > F.col("output_files")
    )


def files_wanted(files: DataFrame, partition: str, size: str = "size", target: int = TARGET_BYTES) -> DataFrame:
    """Number of right-sized files per partition."""
    total = F.sum(size) / F.lit(target)
    return files.groupBy(partition).agg(F.greatest(F.ceil(total), F.lit(1)).cast("int").alias("output_files"))


def compact(df: DataFrame, partition: str, wanted: DataFrame) -> DataFrame:
    """Rows laid out so that each partition is written as its wanted number of files.

    Rows are dealt in turn by their number within a task, so equal rows spread too and any column
    type may occur. ``wanted`` (partition, output_files) has a row per partition. Files are numbered through all
    partitions, and one shuffle sends each number to a task of its own.
    """
    total = wanted.agg(F.sum("output_files").alias("n")).first()["n"] or 1
    before = F.sum("output_files").over(Window.orderBy(partition)) - F.col("output_files")
    numbered = wanted.select(F.col(partition).alias("_part"), "output_files", before.alias("_before"))
    sliced = df.join(numbered, F.col(partition).eqNullSafe(F.col("_part"))).select(
        *df.columns,
        (F.col("_before") + F.pmod(F.monotonically_increasing_id(), F.col("output_files")))
        .cast("int")
        .alias("_slice"),
    )
    return sliced.repartitionById(int(total), F.col("_slice")).drop("_slice")


def reprocess_range(
    source: DataFrame, day: str, first: str, last: str, dry_run: bool = True
) -> DataFrame:
    """Rows of an inclusive range of days to rebuild, or the plan per day when dry.

    Write the result with dynamic partition overwrite; days outside the range stay.
    """
    inside = F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    chosen = source.filter(inside)
    if not dry_run:
        return chosen
    spine = date_spine(source.sparkSession, first, last, day)
    counts = chosen.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))
    return spine.join(counts, day, "left").select(
        day, F.coalesce("rows", F.lit(0)).alias("rows"), (F.coalesce("rows", F.lit(0)) > 0).alias("valid")
    )


def date_spine(spark, first: str, last: str, column: str = "date") -> DataFrame:
    """Every day of an inclusive range."""
    ends = [F.lit(d).cast("date") for d in (first, last)]
    return spark.range(1).select(F.explode(F.sequence(*ends)).alias(column))


def freshness_of_files(files: DataFrame, now: Column, max_minutes: float = 30.0) -> DataFrame:
    """fresh, stale or empty, by the newest file."""
    newest = files.agg(F.max("last_modified").alias("last_modified"))
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_modified").cast("timestamp"))) / F.lit(60_000_000.0)
    status = (
        F.when(F.col("last_modified").isNull(), "empty")
        .when(age <= max_minutes, "fresh")
        .otherwise("stale")
    )
    return newest.select(status.alias("status"), "last_modified", F.round(age, 1).alias("age_minutes"))


def share_failed(df: DataFrame, failed: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Checked and failed rows with the pass rate."""
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_records"), F.count_if(failed).alias("failed_records")
    )
    return counts.withColumn("pass_rate", F.lit(1.0) - X.ratio("failed_records", "total_records"))
