"""Versioned-table and maintenance queries over a change log made from ``lineitem``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.operators import changelog as CL
from goldseam.operators import refine as R
from goldseam.operators import versions as V
from goldseam.session import new_path
from goldseam.sources import outputs as OUT
from goldseam.workloads.binding import TX_SQL, long, money, ntz, transactions
from goldseam.workloads.registry import query, table

KEYS = ["l_orderkey", "l_linenumber"]
TIES = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
TARGET = 2000 * 12 + 6

_LOG = """g as (select l_orderkey, cast(l_linenumber as bigint) as l_linenumber, l_partkey, l_suppkey, l_shipdate,
    l_extendedprice, year(l_shipdate) * 12 + month(l_shipdate) as _commit_id,
    cast(date_trunc('month', l_shipdate) as timestamp) as _committed_at,
    case when l_returnflag = 'R' then 'delete' else 'upsert' end as _op from lineitem)"""
_ORDER = "_commit_id desc, l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc"
_PICK = f"qualify row_number() over (partition by l_orderkey, l_linenumber order by {_ORDER}) = 1"
_COLS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice"


def change_log(spark: SparkSession, folder: str) -> DataFrame:
    """One commit per ship month; returned rows are deletes."""
    rows = table(spark, folder, "lineitem")
    return rows.select(
        "l_orderkey",
        long("l_linenumber").alias("l_linenumber"),
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_extendedprice",
        long(F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("_commit_id"),
        ntz(F.date_trunc("month", "l_shipdate")).alias("_committed_at"),
        F.when(F.col("l_returnflag") == "R", "delete").otherwise("upsert").alias("_op"),
    )


def _payload(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")


@query(
    "state_at_commit",
    f"with {_LOG}, s as (select * from g where _commit_id <= {TARGET} {_PICK}) select {_COLS} from s where _op <> 'delete'",
)
def state_at_commit(spark: SparkSession, folder: str) -> DataFrame:
    return _payload(V.state_at_commit(change_log(spark, folder), KEYS, TARGET, TIES))


@query(
    "state_at_time",
    f"""with {_LOG}, s as (select * from g where _committed_at <= timestamp '1999-03-15 12:00:00' {_PICK})
    select {_COLS} from s where _op <> 'delete'""",
)
def state_at_time(spark: SparkSession, folder: str) -> DataFrame:
    moment = F.expr("timestamp_ntz '1999-03-15 12:00:00'")
    return _payload(V.state_at_time(change_log(spark, folder), KEYS, moment, TIES))


_ROLLBACK = f"""{_LOG}, n as (select * from g {_PICK}), t as (select * from g where _commit_id <= {TARGET} {_PICK}),
  nl as (select * from n where _op <> 'delete'), tl as (select * from t where _op <> 'delete')"""


@query(
    "rollback_diff",
    f"""with {_ROLLBACK}
    select tl.l_orderkey, tl.l_linenumber, tl.l_partkey, tl.l_suppkey, tl.l_shipdate, tl.l_extendedprice, 'upsert' as _op
    from tl left join nl using (l_orderkey, l_linenumber)
    where nl.l_partkey is null or (tl.l_partkey, tl.l_suppkey, tl.l_shipdate, tl.l_extendedprice)
      <> (nl.l_partkey, nl.l_suppkey, nl.l_shipdate, nl.l_extendedprice)
    union all select {', '.join('nl.' + c.strip() for c in _COLS.split(','))}, 'delete' from nl
    anti join tl using (l_orderkey, l_linenumber)""",
)
def rollback_diff(spark: SparkSession, folder: str) -> DataFrame:
    log = change_log(spark, folder)
    return V.rollback_changes(log, KEYS, F.col("_commit_id") <= TARGET, TIES)


@query(
    "rollback_state",
    f"with {_ROLLBACK} select {_COLS} from tl",
)
def rollback_state(spark: SparkSession, folder: str) -> DataFrame:
    """The current state after the inverse changes were appended as a commit."""
    log = change_log(spark, folder)
    undo = V.rollback_changes(log, KEYS, F.col("_committed_at") < F.expr("timestamp_ntz '2000-07-01 00:00:00'"), TIES)
    after = V.append_commit(log, undo, F.expr("timestamp_ntz '2030-01-01 00:00:00'"))
    return _payload(V.current_state(after, KEYS, TIES))


@query(
    "incremental_read",
    f"with {_LOG} select {_COLS}, _commit_id, _op from g where _commit_id > {TARGET} and _commit_id <= {TARGET + 6}",
)
def incremental_read(spark: SparkSession, folder: str) -> DataFrame:
    changed = V.incremental_read(change_log(spark, folder), TARGET, TARGET + 6)
    return changed.drop("_committed_at")


def stored_log(spark: SparkSession, folder: str) -> str:
    """The change log, stored by commit and key bucket; returns its folder."""
    path = new_path(spark, "log")
    CL.store_commits(change_log(spark, folder), path, KEYS, buckets=4)
    return path


@query(
    "stored_incremental_read",
    f"with {_LOG} select {_COLS}, _commit_id, _op from g where _commit_id > {TARGET} and _commit_id <= {TARGET + 6}",
)
def stored_incremental_read(spark: SparkSession, folder: str) -> DataFrame:
    """Six commits of the stored log; no other is opened."""
    changed = CL.read_log(spark, stored_log(spark, folder), TARGET, TARGET + 6)
    return changed.select(*KEYS, "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "_commit_id", "_op")


@query(
    "stored_state_at_time",
    f"""with {_LOG}, s as (select * from g where _committed_at <= timestamp '1999-03-15 12:00:00' {_PICK})
    select {_COLS} from s where _op <> 'delete'""",
)
def stored_state_at_time(spark: SparkSession, folder: str) -> DataFrame:
    """Live rows as of a moment, from the commits that were made by then."""
    moment = F.expr("timestamp_ntz '1999-03-15 12:00:00'")
    log = CL.read_log(spark, stored_log(spark, folder), moment=moment)
    return _payload(V.current_state(log, KEYS, TIES))


_SNAPSHOTS = f"""{_LOG}, s as (select _commit_id as snapshot_id, max(_committed_at) as committed_at,
    count(*) filter (where _op <> 'delete') as added_rows, count(*) filter (where _op = 'delete') as deleted_rows
    from g group by 1)"""


@query(
    "snapshot_list",
    f"""with {_SNAPSHOTS} select committed_at, snapshot_id, lag(snapshot_id) over (order by snapshot_id) as parent_id,
      case when deleted_rows = 0 then 'append' else 'overwrite' end as operation, added_rows, deleted_rows from s""",
)
def snapshot_list(spark: SparkSession, folder: str) -> DataFrame:
    return V.snapshots(change_log(spark, folder))


@query(
    "latest_commit",
    f"with {_SNAPSHOTS} select snapshot_id, committed_at from s order by committed_at desc limit 1",
)
def latest_commit(spark: SparkSession, folder: str) -> DataFrame:
    return V.latest_commit(change_log(spark, folder))


@query(
    "expire_plan",
    f"""with {_SNAPSHOTS} select snapshot_id, committed_at, committed_at < timestamp '2002-01-01' - interval 365 day
      and row_number() over (order by committed_at desc) > 1 as expired from s""",
)
def expire_plan(spark: SparkSession, folder: str) -> DataFrame:
    now = F.expr("timestamp_ntz '2002-01-01 00:00:00'")
    return V.expire_plan(change_log(spark, folder), now, days=365)


@query(
    "expire_squash",
    f"""with {_LOG}, n as (select * from g {_PICK}) select {_COLS} from n where _op <> 'delete'""",
)
def expire_squash(spark: SparkSession, folder: str) -> DataFrame:
    """The current state is the same after old commits were squashed into one."""
    log = V.squash(change_log(spark, folder), KEYS, TARGET, TIES)
    return _payload(V.current_state(log, KEYS, TIES))


@query(
    "compaction_plan",
    """with f as (select source, n_chars * 100000 as size from documents)
    select source, count(*) as files, count(*) filter (where size < 33554432) as small_files,
      cast(coalesce(sum(size) filter (where size < 33554432), 0) as bigint) as small_bytes,
      greatest(cast(ceil(coalesce(sum(size) filter (where size < 33554432), 0) / 134217728.0) as bigint), 1) as output_files,
      count(*) filter (where size < 33554432) > greatest(cast(ceil(coalesce(sum(size)
        filter (where size < 33554432), 0) / 134217728.0) as bigint), 1) as rewrite
    from f group by source""",
)
def compaction_plan(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "documents").select("source", (F.col("n_chars") * 100_000).alias("size"))
    return V.compaction_plan(files, "source")


@query("compact_rewrite", "select event_type, event_id, value from events")
def compact_rewrite(spark: SparkSession, folder: str) -> DataFrame:
    """Rewriting into right-sized files leaves the rows as they are."""
    rows = table(spark, folder, "events").select("event_type", "event_id", "value")
    path = new_path(spark, "compact")
    sizes = rows.groupBy("event_type").agg((F.count(F.lit(1)) * 50_000).alias("size"))
    laid = V.compact(rows, "event_type", V.files_wanted(sizes, "event_type"))
    laid.write.partitionBy("event_type").parquet(path)
    return spark.read.parquet(path).select("event_type", "event_id", "value")


@query(
    "reprocess_range",
    f"""with {TX_SQL} select cast("timestamp" as date) as date, transaction_id, cast(amount_brl + case when
      cast("timestamp" as date) between date '2024-01-10' and date '2024-01-12' then 1 else 0 end as double) as amount_brl from tx""",
)
def reprocess_range(spark: SparkSession, folder: str) -> DataFrame:
    """Three days are rebuilt from a corrected source; the other days stay."""
    rows = OUT.add_layout(transactions(spark, folder)).select("date", "transaction_id", "amount_brl")
    path = new_path(spark, "reprocess")
    OUT.overwrite_partitions(rows, path, ["date"])
    corrected = rows.withColumn("amount_brl", (F.col("amount_brl") + 1).cast("decimal(15,2)"))
    rebuilt = V.reprocess_range(corrected, "date", "2024-01-10", "2024-01-12", dry_run=False)
    if OUT.overwrite_partitions(rebuilt, path, ["date"]) == 0:
        raise ValueError("nothing was rebuilt")
    return spark.read.parquet(path).select("date", "transaction_id", money("amount_brl").alias("amount_brl"))


@query(
    "reprocess_plan",
    f"""with {TX_SQL}, d as (select cast(unnest(generate_series(timestamp '2024-01-28', timestamp '2024-02-02',
      interval 1 day)) as date) as date),
      c as (select cast("timestamp" as date) as date, count(*) as n from tx group by 1)
    select d.date, coalesce(n, 0) as rows, coalesce(n, 0) > 0 as valid from d left join c on c.date = d.date""",
)
def reprocess_plan(spark: SparkSession, folder: str) -> DataFrame:
    rows = OUT.add_layout(transactions(spark, folder))
    return V.reprocess_range(rows, "date", "2024-01-28", "2024-02-02")


@query(
    "bronze_upsert",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice from lineitem
    qualify row_number() over (partition by l_orderkey, l_linenumber
      order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1""",
)
def bronze_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The later half of the rows is merged into the earlier half."""
    rows = table(spark, folder, "lineitem").select(*KEYS, *TIES)
    border = F.expr("timestamp_ntz '1999-01-01 00:00:00'")
    current = R.latest_per_key(rows.filter(F.col("l_shipdate") < border), KEYS, TIES)
    return R.merge_latest(current, rows.filter(F.col("l_shipdate") >= border), KEYS, TIES)
