"""Table maintenance: expire old commits, find orphan files, compact small files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.operators import joins as J
from goldseam.operators import versions as V
from goldseam.sources import inputs as IN
from goldseam.sources import outputs as OUT


def expire(
    spark: SparkSession,
    path: str,
    new_path: str,
    keys: Sequence[str],
    now: Column,
    days: int = 7,
    tiebreak: Sequence[str] = (),
) -> int | None:
    """Write the log with expired commits squashed to ``new_path``; returns the last of them."""
    log = spark.read.parquet(path)
    plan = V.expire_plan(log, now, days)
    last = plan.filter("expired").agg(F.max("snapshot_id").alias("c")).first()["c"]
    if last is None:
        return None
    kept = V.squash(log, keys, int(last), tiebreak)
    OUT.overwrite_partitions(kept, new_path, [V.COMMIT])
    return int(last)


def find_orphans(spark: SparkSession, folder: str, references: DataFrame) -> DataFrame:
    """Files below a folder that no reference (path) names, largest first."""
    files = IN.list_files(spark, folder)
    key = F.regexp_replace("full_path", r"^[a-z0-9]+:/+[^/]+/", "")
    found = J.orphan_files(files.withColumn("key", key), references)
    return found.orderBy(F.desc("size"), "full_path")


def mark_orphans(
    files: DataFrame,
    references: DataFrame,
    now: Column,
    min_age_hours: float = 72.0,
    earlier: DataFrame | None = None,
) -> DataFrame:
    """First step of a removal: unreferenced files of some age, with the time of their first mark.

    A file younger than ``min_age_hours`` may belong to a write that is not committed yet. A file
    keeps its time from ``earlier`` marks if it has not changed; one that is referenced again or
    was written anew loses it.
    """
    key = F.regexp_replace("full_path", r"^[a-z0-9]+:/+[^/]+/", "")
    found = J.orphan_files(files.withColumn("key", key), references).filter(
        F.col("last_modified") <= _hours_before(now, min_age_hours)
    )
    marks = found.select("full_path", "size", "last_modified")
    if earlier is None:
        return marks.withColumn("marked_at", now)
    known = earlier.select("full_path", "size", "last_modified", F.col("marked_at").alias("_first"))
    both = marks.join(known, ["full_path", "size", "last_modified"], "left")
    return both.withColumn("marked_at", F.coalesce("_first", now)).drop("_first")


def _hours_before(now: Column, hours: float) -> Column:
    return F.timestamp_micros(F.unix_micros(now) - F.lit(int(hours * 3_600_000_000)))


def sweep_marks(
    marks: DataFrame,
    files: DataFrame,
    references: DataFrame,
    now: Column,
    grace_hours: float = 24.0,
) -> DataFrame:
    """Second step: delete what was marked long enough ago and still is an unreferenced, unchanged file.

    ``files`` and ``references`` are listed anew for this step. Comes back as (path, deleted), where
    a file counts as deleted if it is not there afterwards, so a repeated task counts the same.
    """
    due = marks.filter(F.col("marked_at") <= _hours_before(now, grace_hours))
    same = files.join(due, ["full_path", "size", "last_modified"], "left_semi")
    key = F.regexp_replace("full_path", r"^[a-z0-9]+:/+[^/]+/", "")
    return remove_files(J.orphan_files(same.withColumn("key", key), references))


def remove_files(files: DataFrame, path: str = "full_path") -> DataFrame:
    """Delete files in the tasks that hold their names; (path, deleted) comes back.

    ``deleted`` says that the file is gone, whichever attempt of the task removed it.
    """

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            done = []
            for name in batch["path"]:
                target = name.replace("s3a://", "s3://", 1)
                if target.startswith("file:/") and not target.startswith("file://"):
                    target = target.replace("file:", "file://", 1)
                store, place = fs.FileSystem.from_uri(target)
                try:
                    store.delete_file(place)
                    done.append(True)
                except FileNotFoundError:
                    done.append(True)
                except OSError:
                    done.append(False)
            yield pd.DataFrame({"path": batch["path"], "deleted": done})

    return files.select(F.col(path).alias("path")).mapInPandas(remove, "path string, deleted boolean")


def partition_text(path: Column | str, partition: str) -> Column:
    """The value of a partition column from a file's path, unescaped; null for the null partition."""
    place = F.col(path) if isinstance(path, str) else path
    raw = F.regexp_extract(place, rf"/{partition}=([^/]*)/", 1)
    # A plus sign stands for itself in these names.
    value = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
    return F.when(raw != "__HIVE_DEFAULT_PARTITION__", value)


def compact_table(
    spark: SparkSession,
    path: str,
    partition: str,
    target: int = V.TARGET_BYTES,
    minimum: int = V.MIN_BYTES,
) -> DataFrame | None:
    """Rewrite the partitions whose small files fit fewer large ones; returns the plan.

    Only the chosen partitions are read, and each is replaced as a whole. The rows are
    written to the shared folder first, since a partition cannot be read and replaced in
    one job.
    """
    from goldseam.session import materialize

    folder = F.regexp_extract("full_path", rf"/{partition}=([^/]*)/", 1)
    files = IN.list_files(spark, path, "*.parquet").withColumn("part", folder)
    plan = V.compaction_plan(files, "part", "size", target, minimum).filter("rewrite")
    plan = materialize(plan, "plan")
    if plan.isEmpty():
        return None
    table = spark.read.parquet(path)
    kind = table.schema[partition].dataType
    wanted = V.files_wanted(files.join(plan, "part", "left_semi"), "part", "size", target)
    value = partition_text(F.concat(F.lit(f"/{partition}="), F.col("part"), F.lit("/")), partition)
    wanted = materialize(
        wanted.select(value.cast(kind).alias(partition), "output_files"), "wanted"
    )
    chosen = wanted.select(F.col(partition).alias("_part"))
    held = materialize(
        table.join(chosen, F.col(partition).eqNullSafe(F.col("_part")), "left_semi"), "compact"
    )
    laid = V.compact(held, partition, wanted)
    laid.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition
    ).parquet(path)
    return plan


def run_all(
    spark: SparkSession,
    path: str,
    new_path: str,
    keys: Sequence[str],
    now: Column,
    references: DataFrame,
    partition: str = V.COMMIT,
    days: int = 7,
    execute: bool = False,
    marks: str | None = None,
    min_age_hours: float = 72.0,
    grace_hours: float = 24.0,
    clock: Column | None = None,
) -> dict:
    """Expire, then mark orphans (with ``execute`` sweep what is due), then compact.

    The marks are kept in the table ``marks`` between runs; without it every run marks anew, so only
    a grace time of zero deletes anything. ``clock`` is the time that files are judged by.
    """
    from goldseam.session import materialize

    clock = F.current_timestamp() if clock is None else clock
    last = expire(spark, path, new_path, keys, now, days)
    table = path if last is None else new_path
    orphans = find_orphans(spark, path, references)
    totals = orphans.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("b")).first()
    listed = IN.list_files(spark, path)
    earlier = spark.read.parquet(marks) if marks and OUT.is_written(spark, marks) else None
    marked = materialize(mark_orphans(listed, references, clock, min_age_hours, earlier), "marks")
    deleted = 0
    if execute:
        again = IN.list_files(spark, path)
        swept = materialize(sweep_marks(marked, again, references, clock, grace_hours), "swept")
        deleted = swept.filter("deleted").count()
        gone = swept.filter("deleted").withColumnRenamed("path", "full_path")
        marked = marked.join(gone, "full_path", "left_anti")
    if marks:
        OUT.replace_table(marked, marks)
    plan = compact_table(spark, table, partition)
    return {
        "expired_upto": last,
        "orphan_files": totals["n"],
        "orphan_bytes": totals["b"] or 0,
        "deleted": deleted,
        "compacted_partitions": 0 if plan is None else plan.count(),
    }
