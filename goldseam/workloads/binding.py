"""The given tables seen as the data model, in DataFrame form and as SQL.

Faults (missing values, malformed text, unlisted codes) are put in by expressions on the
id, the same in both forms, and every row of the table takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.workloads.registry import table

# A currency code per event type, one of them lower case, one not listed.
CODES = {"click": "usd", "view": "EUR", "purchase": "GBP", "signup": "JPY", "error": "ZZZ"}

_CASE = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in CODES.items()) + " end"

TX_SQL = f"""tx as (
  select cast(event_id as varchar) as transaction_id, cast(user_id as varchar) as user_id,
         ts as "timestamp", case when event_id % 2 = 0 then 'BUY' else 'SELL' end as transaction_type,
         {_CASE} as currency, cast(value as decimal(15,2)) as amount_brl,
         cast(value / 5 as decimal(15,4)) as amount_foreign,
         cast(1 + value / 100 as decimal(10,4)) as exchange_rate,
         cast((event_id % 50) / 1000.0 as decimal(5,3)) as spread_pct,
         event_type = 'error' as is_anomaly, event_id, event_type, value
  from events)"""

DIRTY_SQL = f"""{TX_SQL}, dirty as (
  select * replace (
    case when event_id % 97 = 0 then null when event_id % 89 = 0 then -amount_brl
         else amount_brl end as amount_brl,
    case when event_id % 83 = 0 then null else user_id end as user_id,
    case when event_id % 79 = 0 then null else "timestamp" end as "timestamp")
  from tx)"""


def money(column: str | Column) -> Column:
    """An exact decimal as a double."""
    return (F.col(column) if isinstance(column, str) else column).cast("double")


def r6(column: str | Column) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def long(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("long")


def ntz(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def code(column: str | Column = "event_type") -> Column:
    value = F.col(column) if isinstance(column, str) else column
    result = F.lit(None).cast("string")
    for kind, name in CODES.items():
        result = F.when(value == kind, F.lit(name)).otherwise(result)
    return result


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as transactions."""
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_id") % 2 == 0, "BUY").otherwise("SELL").alias("transaction_type"),
        code().alias("currency"),
        F.col("value").cast("decimal(15,2)").alias("amount_brl"),
        (F.col("value") / 5).cast("decimal(15,4)").alias("amount_foreign"),
        (1 + F.col("value") / 100).cast("decimal(10,4)").alias("exchange_rate"),
        (F.col("event_id") % 50 / 1000).cast("decimal(5,3)").alias("spread_pct"),
        (F.col("event_type") == "error").alias("is_anomaly"),
        "event_id",
        "event_type",
        "value",
    )


def dirty_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with missing and negative values."""
    number = F.col("event_id")
    amount = F.col("amount_brl")
    faulty = F.when(number % 97 == 0, None).when(number % 89 == 0, -amount).otherwise(amount)
    return transactions(spark, folder).withColumns(
        {
            "amount_brl": faulty.cast("decimal(15,2)"),
            "user_id": F.when(number % 83 != 0, F.col("user_id")),
            "timestamp": F.when(number % 79 != 0, F.col("timestamp")),
        }
    )


def raw_values(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions as JSON texts (event_id, value), some of them malformed."""
    record = F.struct(
        "transaction_id",
        "user_id",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "transaction_type",
        "currency",
        "amount_brl",
        "amount_foreign",
        "exchange_rate",
        "spread_pct",
        F.lit("completed").alias("status"),
        "is_anomaly",
    )
    number = F.col("event_id")
    text = (
        F.when(number % 97 == 0, "not-json")
        .when(number % 101 == 0, "{broken")
        .when(number % 103 == 0, "")
        .when(number % 107 == 0, "null")
        .otherwise(F.to_json(record))
    )
    rows = transactions(spark, folder)
    return rows.select("event_id", rows.timestamp.alias("ts"), text.alias("value"))


def half_up(total: str, count: str) -> str:
    """SQL of a mean of cents, rounded half up to six places in whole numbers."""
    return f"(cast({total} * 100 as bigint) * 20000 + {count}) // (2 * {count}) / 1000000.0"


FAULT_SQL = (
    "(event_id % 97 = 0 or event_id % 101 = 0 or event_id % 103 = 0 or event_id % 107 = 0)"
)
FAULT_TEXT_SQL = (
    "case when event_id % 97 = 0 then 'not-json' when event_id % 101 = 0 then '{broken' "
    "when event_id % 103 = 0 then '' when event_id % 107 = 0 then 'null' end"
)

RUNS_SQL = f"""{TX_SQL}, runs as (
  select cast(ts as date) as day, 'run-' || cast(cast(ts as date) as varchar) as run_id,
    case when day(ts) % 2 = 0 then 'lof' else 'isolation_forest' end as model_type,
    date_trunc('day', ts) as start_time,
    count(*) filter (where event_type = 'error' and value >= 5) as tp,
    count(*) filter (where event_type <> 'error' and value >= 5 and event_id % 10 = 0) as fp,
    count(*) filter (where event_type = 'error' and value < 5) as fn,
    quantile_cont(value, 0.95) as latency_p95_ms
  from events group by all),
scored as (
  select *, coalesce(tp / nullif(cast(tp + fp as double), 0), 0) as precision,
    coalesce(tp / nullif(cast(tp + fn as double), 0), 0) as recall,
    coalesce(2 * tp / nullif(cast(2 * tp + fp + fn as double), 0), 0) as f1
  from runs)"""
