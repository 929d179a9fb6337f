"""Small helpers of the operators: written tables, and pandas frames that keep whole numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from goldseam.session import new_path


#: Shuffle files of a query go when it is over; otherwise they stay until the driver collects garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` compactly to the shared folder and read it back: cuts the lineage with files
    that survive lost executors. Shuffle files of the write are removed with its end."""
    spark = df.sparkSession
    path = new_path(spark, label)
    before = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(SHUFFLES_GO) if before is None else spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, label: str) -> DataFrame:
    """``written`` in about as many files as the cluster has cores, for tables of keys and counts."""
    return written(df.coalesce(df.sparkSession.sparkContext.defaultParallelism), label)


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(schema))


def _frame(data: pa.RecordBatch | pa.Table) -> pd.DataFrame:
    """Whole numbers beside nulls stay whole numbers (as objects), not doubles."""
    return data.to_pandas(integer_object_nulls=True, date_as_object=True)


def map_frames(
    df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Like ``mapInPandas``, without turning 64-bit numbers into doubles where a batch has nulls."""
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in fn(_frame(batch) for batch in batches):
            yield from pa.Table.from_pandas(frame, arrow, preserve_index=False).to_batches()

    return df.mapInArrow(run, schema)


def apply_frames(
    grouped: GroupedData, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Like ``applyInPandas``, with whole numbers kept in the same way."""
    arrow = _arrow(schema)

    def run(group: pa.Table) -> pa.Table:
        return pa.Table.from_pandas(fn(_frame(group)), arrow, preserve_index=False)

    return grouped.applyInArrow(run, schema)


def ddl(df: DataFrame, *added: str, without: tuple[str, ...] = ()) -> str:
    """The columns of a frame and further ones as a schema string."""
    own = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name not in without]
    return ", ".join([*own, *added])
