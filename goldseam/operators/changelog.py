"""A change log stored by commit and key bucket, so that a read opens only what it needs.

Below one folder lie ``rows`` (partitioned by commit and by a bucket of the key) and ``commits``
(commit and its time, a row each). A commit's row is written after its rows, and readers go by the
commits, so a write that broke is not seen and can be repeated. A single writer is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldseam.operators.versions import COMMIT, COMMITTED
from goldseam.sources import outputs as OUT

BUCKET = "_bucket"
BUCKETS = 16


def key_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def store_commits(log: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """Write the commits that ``log`` holds, whole ones, and return their rows.

    Repeating a commit replaces it. Keys need the types they have in later look-ups.
    """
    placed = log.withColumn(BUCKET, key_bucket(keys, buckets))
    rows = OUT.overwrite_partitions(placed, f"{path}/rows", [COMMIT, BUCKET])
    times = log.groupBy(COMMIT).agg(F.max(COMMITTED).alias(COMMITTED))
    OUT.overwrite_partitions(times, f"{path}/commits", [COMMIT])
    return rows


def commits(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/commits").withColumn(COMMIT, F.col(COMMIT).cast("long"))


def read_log(
    spark: SparkSession,
    path: str,
    after: int | None = None,
    upto: int | None = None,
    moment: Column | None = None,
    keys: DataFrame | None = None,
    buckets: int = BUCKETS,
    schema: StructType | None = None,
) -> DataFrame:
    """Rows of the commits after one and up to another, up to a moment, and of some keys.

    Bounds on commits, and the buckets of keys (a DataFrame of the key columns), are partition filters
    of the scan. A moment reaches it as a dynamic partition filter by the commits made by then. For
    ``state_at_commit`` and the like of ``versions``. With a ``schema`` no file is opened for it.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(f"{path}/rows").withColumn(COMMIT, F.col(COMMIT).cast("long"))
    known = commits(spark, path)
    if after is not None:
        rows, known = (t.filter(F.col(COMMIT) > after) for t in (rows, known))
    if upto is not None:
        rows, known = (t.filter(F.col(COMMIT) <= upto) for t in (rows, known))
    if moment is not None:
        known = known.filter(F.col(COMMITTED) <= moment)
    found = rows.join(known.select(COMMIT), COMMIT, "left_semi")
    if keys is not None:
        # At most one value per bucket comes to the driver.
        places = keys.select(key_bucket(keys.columns, buckets).alias("b")).distinct().collect()
        found = found.filter(F.col(BUCKET).isin([r["b"] for r in places]))
        found = found.join(keys.distinct(), keys.columns, "left_semi")
    return found.drop(BUCKET)
