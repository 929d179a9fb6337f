"""Session settings and the shared folder for files that jobs hand to each other."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long texts: a batch for a Python worker is bounded by its bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def create_session(
    app_name: str = "goldseam",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the settings the jobs rely on.

    Leave ``master`` and ``shuffle_partitions`` unset on a cluster: the submit command
    decides both, and adaptive execution coalesces what is too fine.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def active_session() -> SparkSession:
    """The running session, or a new one with the defaults."""
    return SparkSession.getActiveSession() or create_session()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the options results depend on, for a session that somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name in (
        "spark.sql.sources.partitionOverwriteMode",
        "spark.sql.streaming.stateStore.providerClass",
        "spark.sql.execution.arrow.maxBytesPerBatch",
    ):
        spark.conf.set(name, SETTINGS[name])
    return spark


_FOLDERS: dict[str, str] = {}


def _new_folder(spark: SparkSession) -> str:
    folder = tempfile.mkdtemp(prefix="goldseam-")
    _FOLDERS[spark.sparkContext.applicationId] = folder
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local") and "local-cluster" not in spark.sparkContext.master:
        # The setting cannot change in a running session, so the folder is remembered here.
        return _FOLDERS.get(spark.sparkContext.applicationId) or _new_folder(spark)
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/goldseam/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a columnar table, so a lost executor re-reads files instead of
    recomputing, and later column pruning still reaches the scan.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
