"""Ingestion, cleaning, enrichment and gold queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam import schemas as S
from goldseam.functions import columns as X
from goldseam.functions.contracts import TRANSACTION_CONTRACT, USER_CONTRACT, with_violations
from goldseam.operators import features as FE
from goldseam.operators import gold as G
from goldseam.operators import joins as J
from goldseam.operators import refine as R
from goldseam.operators import versions as V
from goldseam.plans import daily as DA
from goldseam.session import new_path
from goldseam.sources import inputs as IN
from goldseam.sources import outputs as OUT
from goldseam.workloads.binding import (
    DIRTY_SQL,
    FAULT_SQL,
    FAULT_TEXT_SQL,
    TX_SQL,
    dirty_transactions,
    half_up,
    long,
    money,
    ntz,
    r6,
    raw_values,
    transactions,
)
from goldseam.workloads.registry import query, table

RAW_COLUMNS = ("transaction_id", "user_id", "timestamp", "currency", "amount_brl", "is_anomaly")
_VALID = ", ".join(f"'{c}'" for c in S.VALID_CURRENCIES)


def _typed(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        *extra,
        "transaction_id",
        "user_id",
        ntz("timestamp").alias("timestamp"),
        "currency",
        money("amount_brl").alias("amount_brl"),
        "is_anomaly",
    )


_TYPED_SQL = (
    'transaction_id, user_id, "timestamp", currency, cast(amount_brl as double) as amount_brl, '
    "is_anomaly"
)


@query(
    "raw_json_scan",
    f'with {TX_SQL} select cast("timestamp" as date) as event_date, {_TYPED_SQL} from tx '
    f"where not {FAULT_SQL}",
)
def raw_json_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Write the texts as JSON files per day, then scan all days with the typed schema."""
    base = new_path(spark, "raw")
    good, _ = IN.split_values(IN.parse_values(raw_values(spark, folder), S.RAW_TRANSACTION))
    OUT.write_raw_json(good.drop("event_id").withColumn("event_date", F.to_date("ts")).drop("ts"), base)
    read = IN.read_raw(spark, base, "1900-01-01", "2999-12-31")
    return _typed(read, "event_date")


@query(
    "schema_enforce",
    f"""with {TX_SQL} select event_id,
      case when {FAULT_SQL} then 'malformed' end as error,
      case when not {FAULT_SQL} then transaction_id end as transaction_id,
      case when not {FAULT_SQL} then user_id end as user_id,
      case when not {FAULT_SQL} then "timestamp" end as "timestamp",
      case when not {FAULT_SQL} then cast(amount_brl as double) end as amount_brl,
      case when not {FAULT_SQL} then cast(exchange_rate as double) end as exchange_rate
    from tx""",
)
def schema_enforce(spark: SparkSession, folder: str) -> DataFrame:
    parsed = IN.parse_values(raw_values(spark, folder), S.RAW_TRANSACTION)
    ok = F.col("error").isNull()
    return parsed.select(
        "event_id",
        "error",
        F.when(ok, F.col("data.transaction_id")).alias("transaction_id"),
        F.when(ok, F.col("data.user_id")).alias("user_id"),
        F.when(ok, ntz("data.timestamp")).alias("timestamp"),
        F.when(ok, money("data.amount_brl")).alias("amount_brl"),
        F.when(ok, money("data.exchange_rate")).alias("exchange_rate"),
    )


@query(
    "partition_overwrite",
    f"""with {TX_SQL} select cast("timestamp" as date) as date, transaction_id,
      cast(amount_brl as double) * case when day("timestamp") > 15 then 2 else 1 end as amount_brl
    from tx""",
)
def partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """A table by day, of which the second half of each month is then written again."""
    path = new_path(spark, "overwrite")
    rows = OUT.add_layout(transactions(spark, folder)).select("date", "transaction_id", "amount_brl")
    OUT.overwrite_partitions(rows, path, ["date"])
    late = rows.filter(F.dayofmonth("date") > 15)
    doubled = (F.col("amount_brl") * 2).cast("decimal(15,2)")
    OUT.overwrite_partitions(late.withColumn("amount_brl", doubled), path, ["date"])
    return spark.read.parquet(path).select("date", "transaction_id", money("amount_brl").alias("amount_brl"))


@query(
    "bucket_layout",
    f"""with {TX_SQL} select cast("timestamp" as date) as date, currency, count(*) as n, 1::bigint as buckets
    from tx group by 1, 2""",
)
def bucket_layout(spark: SparkSession, folder: str) -> DataFrame:
    """A table in the layer layout: each currency lies in one bucket of each day."""
    path = new_path(spark, "layout")
    rows = OUT.add_layout(transactions(spark, folder), bucket_by="currency")
    OUT.overwrite_partitions(rows, path, ["date", "bucket"])
    return spark.read.parquet(path).groupBy("date", "currency").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("bucket").alias("buckets")
    )


@query(
    "bronze_dedup",
    """select * from (
      select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice
      from lineitem
      qualify row_number() over (partition by l_orderkey, l_linenumber
        order by l_shipdate desc, l_partkey desc, l_suppkey desc, l_extendedprice desc) = 1)""",
)
def bronze_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"
    )
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]
    return R.latest_per_key(rows, ["l_orderkey", "l_linenumber"], order)


@query(
    "bronze_audit",
    """select event_id, 'events.parquet' as source_file, 'events' as batch_id, true as loaded from events""",
)
def bronze_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The audit columns, reduced to what does not depend on place and time."""
    audited = R.add_audit(table(spark, folder, "events"))
    return audited.select(
        "event_id",
        F.element_at(F.split("_source_file", "/"), -1).alias("source_file"),
        F.col("_batch_id").alias("batch_id"),
        F.col("_bronze_loaded_at").isNotNull().alias("loaded"),
    )


@query(
    "silver_clean",
    f"""with {DIRTY_SQL} select transaction_id, user_id, "timestamp", upper(currency) as currency,
      cast(amount_brl as double) as amount_brl from dirty
    where amount_brl > 0 and upper(currency) in ({_VALID}) and "timestamp" is not null
      and transaction_id is not null and user_id is not null""",
)
def silver_clean(spark: SparkSession, folder: str) -> DataFrame:
    return R.clean(dirty_transactions(spark, folder)).select(
        "transaction_id", "user_id", "timestamp", "currency", money("amount_brl").alias("amount_brl")
    )


_ENRICH_SQL = f"""select transaction_id, round(cast(amount_brl as double) / 5.0, 2) as amount_usd,
  dayofweek("timestamp") + 1 as day_of_week, hour("timestamp") as hour_of_day,
  hour("timestamp") between 9 and 17 and dayofweek("timestamp") between 1 and 5 as is_business_hours,
  cast("timestamp" as date) as date, year("timestamp") * 100 + month("timestamp") as year_month"""


@query("silver_enrich", f"with {TX_SQL} {_ENRICH_SQL} from tx")
def silver_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return R.enrich(transactions(spark, folder)).select(
        "transaction_id",
        money("amount_usd").alias("amount_usd"),
        long("day_of_week").alias("day_of_week"),
        long("hour_of_day").alias("hour_of_day"),
        "is_business_hours",
        "date",
        long("year_month").alias("year_month"),
    )


@query(
    "silver_validate",
    f"""with {DIRTY_SQL}, c as (select count(*) as total,
        count(*) filter (where amount_brl is null) as a, count(*) filter (where amount_brl <= 0) as b,
        count(*) filter (where "timestamp" is null) as c,
        count(*) filter (where upper(currency) not in ({_VALID})) as d from dirty),
      l as (select 'null_amount_brl' as check_name, a as bad, total from c
        union all select 'negative_amounts', b, total from c
        union all select 'null_timestamps', c, total from c
        union all select 'invalid_currencies', d, total from c)
    select check_name, bad, total, round(bad * 100.0 / total, 6) as pct,
      bad * 100.0 / total <= 5 as passed from l""",
)
def silver_validate(spark: SparkSession, folder: str) -> DataFrame:
    rows = dirty_transactions(spark, folder).withColumn("currency", F.upper("currency"))
    return R.silver_checks(rows).withColumn("pct", r6("pct"))


@query(
    "contract_transactions",
    """select event_id, case event_id % 11
      when 0 then 'required:user_id' when 1 then 'pattern:currency' when 2 then 'minimum:amount_brl'
      when 3 then 'enum:transaction_type' when 4 then 'maximum:anomaly_score'
      when 5 then 'additional:unknown_field' when 6 then 'type:exchange_rate'
      when 7 then 'malformed' when 8 then 'minimum:spread_pct,required:status' else '' end as violations
    from events""",
)
def contract_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transaction texts, most with one kind of fault, against the wire contract."""
    rows = transactions(spark, folder)
    kind = F.col("event_id") % 11

    def unless(case: int, value):
        return F.when(kind != case, value)

    record = F.struct(
        "transaction_id",
        unless(0, F.col("user_id")).alias("user_id"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.when(kind == 3, "TRANSFER").otherwise(F.col("transaction_type")).alias("transaction_type"),
        F.when(kind == 1, "usd").otherwise(F.upper("currency")).alias("currency"),
        F.when(kind == 2, F.lit(-1.0)).otherwise(F.col("value")).alias("amount_brl"),
        F.col("amount_foreign"),
        unless(6, F.col("exchange_rate")).alias("exchange_rate"),
        F.when(kind == 8, F.lit(-0.5)).otherwise(F.col("spread_pct").cast("double")).alias("spread_pct"),
        unless(8, F.lit("completed")).alias("status"),
        "is_anomaly",
        F.when(kind == 4, F.lit(1.5)).otherwise(F.lit(0.5)).alias("anomaly_score"),
        F.when(kind == 5, "x").alias("unknown_field"),
    )
    text = F.to_json(record)
    # A number sent as text breaks the type rule.
    quoted = F.regexp_replace(text, r"\}$", ',"exchange_rate":"5.1"}')
    value = F.when(kind == 7, "not-json").when(kind == 6, quoted).otherwise(text)
    checked = with_violations(rows.select("event_id", value.alias("value")), TRANSACTION_CONTRACT)
    return checked.select("event_id", F.concat_ws(",", "violations").alias("violations"))


@query(
    "contract_users",
    """select c_custkey, case when c_custkey % 5 = 0 then 'enum:tier'
      when c_custkey % 5 = 1 then 'pattern:state' when c_custkey % 5 = 2 then 'required:email'
      else '' end as violations from customer""",
)
def contract_users(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("c_custkey") % 5
    record = F.struct(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("name"),
        F.when(kind != 2, F.concat(F.col("c_name"), F.lit("@example.org"))).alias("email"),
        F.when(kind == 1, "sp").otherwise("SP").alias("state"),
        F.when(kind == 0, "vip").otherwise("gold").alias("tier"),
        F.col("c_mktsegment").alias("segment"),
    )
    rows = table(spark, folder, "customer")
    checked = with_violations(rows.select("c_custkey", F.to_json(record).alias("value")), USER_CONTRACT)
    return checked.select("c_custkey", F.concat_ws(",", "violations").alias("violations"))


@query(
    "ingest_enrich",
    """select cast(event_id as varchar) as transaction_id, 'debezium-cdc' as source_system, true as stamped,
      36::bigint as id_length from events""",
)
def ingest_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """The ingest metadata, reduced to what does not depend on time and chance."""
    from goldseam.streaming.ingest import add_ingest_metadata

    return add_ingest_metadata(transactions(spark, folder)).select(
        "transaction_id",
        "source_system",
        F.col("ingestion_timestamp").isNotNull().alias("stamped"),
        long(F.length("batch_id")).alias("id_length"),
    )


@query(
    "rate_quotes",
    """select event_id, round((value - lag(value) over w) / nullif(lag(value) over w, 0) * 100, 6) as pct_change,
      round(value - lag(value) over w * 0.002 / 2, 6) as bid,
      round(value + lag(value) over w * 0.002 / 2, 6) as ask
    from events window w as (partition by event_type order by ts, event_id)""",
)
def rate_quotes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    quotes = FE.rate_quotes(rows, "event_type", "ts", "value", "event_id")
    return quotes.select("event_id", "pct_change", "bid", "ask")


@query(
    "storage_cost",
    """select source, round(sum(n_chars) / 1073741824.0 * 0.023, 12) as usd_month
    from documents group by source""",
)
def storage_cost(spark: SparkSession, folder: str) -> DataFrame:
    sizes = table(spark, folder, "documents").groupBy("source").agg(F.sum("n_chars").alias("b"))
    return sizes.select("source", F.round(X.storage_usd("b"), 12).alias("usd_month"))


@query(
    "job_cost",
    """select event_type, round(cast(sum(cast(value as decimal(15,2))) as double) / 3600
      * (4 * 0.052624 + 16 * 0.0057785), 6) as usd from events group by event_type""",
)
def job_cost(spark: SparkSession, folder: str) -> DataFrame:
    times = table(spark, folder, "events").groupBy("event_type").agg(
        F.sum(F.col("value").cast("decimal(15,2)")).cast("double").alias("s")
    )
    return times.select("event_type", r6(X.job_usd("s")).alias("usd"))


@query("cdc_route", "select event_id, event_type as target from events")
def cdc_route(spark: SparkSession, folder: str) -> DataFrame:
    topic = F.concat(F.lit("shop.public."), F.col("event_type"))
    return table(spark, folder, "events").select("event_id", X.topic_table(topic).alias("target"))


@query(
    "safe_cast",
    """select event_id, case when event_id % 13 <> 0 then cast(json_extract(props, '$.k') as double)
      end as k from events""",
)
def safe_cast(spark: SparkSession, folder: str) -> DataFrame:
    text = F.get_json_object("props", "$.k")
    faulty = F.when(F.col("event_id") % 13 == 0, F.concat(text, F.lit("x"))).otherwise(text)
    return table(spark, folder, "events").select("event_id", X.to_number(faulty).alias("k"))


@query("iso_millis", "select event_id, epoch_us(ts) // 1000 as millis from events")
def iso_millis(spark: SparkSession, folder: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return table(spark, folder, "events").select("event_id", X.iso_millis(text).alias("millis"))


@query(
    "date_spine",
    """with d as (select unnest(generate_series(timestamp '2023-12-25', timestamp '2024-02-05',
        interval 1 day)) as x),
      e as (select cast(ts as date) as date, count(*) as n from events group by 1)
    select cast(d.x as date) as date, coalesce(e.n, 0) as n from d left join e on e.date = cast(d.x as date)""",
)
def date_spine(spark: SparkSession, folder: str) -> DataFrame:
    counts = table(spark, folder, "events").groupBy(F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    spine = V.date_spine(spark, "2023-12-25", "2024-02-05")
    return spine.join(counts, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "json_extract",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k,
      cast(json_extract(props, '$.k') as bigint) * 2 as k2 from events""",
)
def json_extract(spark: SparkSession, folder: str) -> DataFrame:
    """A field read from text, packed into a new document and read back."""
    rows = table(spark, folder, "events").select(
        "event_id", F.from_json("props", "k long").alias("p")
    )
    packed = F.to_json(F.struct((F.col("p.k") * 2).alias("k2")))
    return rows.select(
        "event_id",
        F.col("p.k").alias("k"),
        F.get_json_object(packed, "$.k2").try_cast("long").alias("k2"),
    )


@query(
    "gold_daily_volume",
    f"""with {TX_SQL}, b as (
      select cast("timestamp" as date) as date, currency, cast(sum(amount_brl) as decimal(18,2)) as tv,
        count(transaction_id) as n, {half_up("sum(amount_brl)", "count(*)")} as av,
        min(amount_brl) as mn, max(amount_brl) as mx, quantile_disc(amount_brl, 0.95) as p95
      from tx group by 1, 2)
    select date, currency, cast(tv as double) as total_volume_brl, n as transaction_count,
      av as avg_amount, cast(mn as double) as min_amount, cast(mx as double) as max_amount,
      cast(p95 as double) as p95_amount,
      round(cast(tv - lag(tv) over w as double) / nullif(cast(lag(tv) over w as double), 0) * 100, 6)
        as volume_change_pct,
      {half_up("sum(tv) over r", "count(*) over r")} as ma7_volume_brl
    from b window w as (partition by currency order by date),
      r as (partition by currency order by date rows between 6 preceding and current row)""",
)
def gold_daily_volume(spark: SparkSession, folder: str) -> DataFrame:
    result = G.daily_volume(transactions(spark, folder))
    names = ("total_volume_brl", "min_amount", "max_amount")
    return result.withColumns(
        {**{n: money(n) for n in names}, "volume_change_pct": r6("volume_change_pct")}
    )


@query(
    "gold_user_summary",
    f"""with {TX_SQL} select user_id, count(transaction_id) as total_transactions,
      cast(sum(amount_brl) as double) as total_volume_brl,
      {half_up("sum(amount_brl)", "count(*)")} as avg_transaction_brl,
      min("timestamp") as first_transaction_at, max("timestamp") as last_transaction_at
    from tx group by user_id""",
)
def gold_user_summary(spark: SparkSession, folder: str) -> DataFrame:
    return G.user_summary(transactions(spark, folder)).withColumns(
        {
            "total_volume_brl": money("total_volume_brl"),
        }
    )


def _two_loads(spark: SparkSession, folder: str) -> str:
    """A lake whose user totals come from two overlapping loads; returns its folder.

    The first load ends with January 20th. Some of its rows have other amounts, some belong to other
    users, and some happened at other times, on the last three days. The second load replaces these
    days and brings the rest.
    """
    rows = transactions(spark, folder)
    day, number = F.to_date("timestamp"), F.col("event_id")
    wrong = (day >= F.lit("2024-01-18").cast("date")) & (number % 3 == 0)
    first = rows.filter(day <= F.lit("2024-01-20").cast("date")).withColumns(
        {
            "amount_brl": F.when(wrong, F.col("amount_brl") * 2 + 1)
            .otherwise(F.col("amount_brl"))
            .cast("decimal(15,2)"),
            "user_id": F.when(wrong & (number % 2 == 0), F.concat(F.lit("former-"), "user_id")).otherwise(
                F.col("user_id")
            ),
            "timestamp": F.when(wrong, F.date_trunc("day", "timestamp")).otherwise(F.col("timestamp")),
        }
    )
    second = rows.filter(day >= F.lit("2024-01-18").cast("date"))
    lake = new_path(spark, "lake")
    for load in (first, second):
        days = [r["d"] for r in load.select(F.to_date("timestamp").alias("d")).distinct().collect()]
        DA.refresh_users(spark, lake, load, days)
    return lake


@query(
    "daily_incremental",
    f"""with {TX_SQL} select user_id, count(transaction_id) as total_transactions,
      cast(sum(amount_brl) as double) as total_volume_brl,
      {half_up("sum(amount_brl)", "count(*)")} as avg_transaction_brl,
      min("timestamp") as first_transaction_at, max("timestamp") as last_transaction_at
    from tx group by user_id""",
)
def daily_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The user summary kept by signed changes over two overlapping loads equals that of one load."""
    found = DA.user_summary(spark, _two_loads(spark, folder))
    return found.withColumn("total_volume_brl", money("total_volume_brl"))


@query(
    "user_summary_ext",
    f"""with {TX_SQL} select user_id, count(*) as total_transactions,
      count(distinct currency) as distinct_currencies from tx group by user_id""",
)
def user_summary_ext(spark: SparkSession, folder: str) -> DataFrame:
    return G.user_summary(transactions(spark, folder), currency="currency").select(
        "user_id", "total_transactions", "distinct_currencies"
    )


@query(
    "gold_hourly_rates",
    f"""with {TX_SQL} select year("timestamp") * 1000000 + month("timestamp") * 10000
        + day("timestamp") * 100 + hour("timestamp") as hour_bucket, currency,
      round(avg(cast(exchange_rate as double)), 6) as avg_rate, cast(min(exchange_rate) as double) as min_rate,
      cast(max(exchange_rate) as double) as max_rate,
      round(stddev(cast(exchange_rate as double)), 6) as volatility, count(*) as transaction_count
    from tx group by 1, 2""",
)
def gold_hourly_rates(spark: SparkSession, folder: str) -> DataFrame:
    rates = transactions(spark, folder).withColumn("exchange_rate", money("exchange_rate"))
    return G.hourly_rates(rates).withColumns(
        {"avg_rate": r6("avg_rate"), "volatility": r6("volatility")}
    )


@query(
    "gold_anomaly_summary",
    f"""with {TX_SQL} select cast("timestamp" as date) as date, count(*) as total_transactions,
      count(*) filter (where is_anomaly) as total_anomalies,
      round(count(*) filter (where is_anomaly) / count(*), 6) as anomaly_rate from tx group by 1""",
)
def gold_anomaly_summary(spark: SparkSession, folder: str) -> DataFrame:
    return G.anomaly_summary(transactions(spark, folder)).withColumn("anomaly_rate", r6("anomaly_rate"))


@query(
    "anomaly_summary_missing",
    """select cast(ts as date) as date, 0::bigint as total_transactions, 0::bigint as total_anomalies,
      0.0::double as anomaly_rate from events where false""",
)
def anomaly_summary_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Without the flag column the summary is empty but typed."""
    return G.anomaly_summary(transactions(spark, folder).drop("is_anomaly"))


@query(
    "daily_median",
    f"""with {TX_SQL} select cast("timestamp" as date) as date, currency,
      round(quantile_cont(value, 0.5), 6) as median_amount from tx group by 1, 2""",
)
def daily_median(spark: SparkSession, folder: str) -> DataFrame:
    found = G.daily_median(transactions(spark, folder), "timestamp", "currency", "value")
    return found.withColumn("median_amount", r6("median_amount"))


@query(
    "anomaly_by_type",
    f"""with {TX_SQL} select cast("timestamp" as date) as date, currency as anomaly_type,
      count(*) filter (where value > 50) as anomalies from tx group by 1, 2""",
)
def anomaly_by_type(spark: SparkSession, folder: str) -> DataFrame:
    flagged = transactions(spark, folder).withColumn("is_anomaly", F.col("value") > 50)
    return G.anomalies_by_type(flagged, "timestamp", "currency")


@query(
    "user_volume_rank",
    f"""with {TX_SQL}, u as (select user_id, cast(sum(amount_brl) as decimal(18,2)) as v from tx group by 1)
    select user_id, cast(v as double) as total_volume_brl, rank() over (order by v desc) as volume_rank,
      dense_rank() over (order by v desc) as dense_rank from u""",
)
def user_volume_rank(spark: SparkSession, folder: str) -> DataFrame:
    summary = G.user_summary(transactions(spark, folder)).select("user_id", "total_volume_brl")
    return G.volume_rank(summary).select(
        "user_id", money("total_volume_brl").alias("total_volume_brl"), "volume_rank", "dense_rank"
    )


@query(
    "enrich_users",
    """select o_orderkey, o_custkey, c_name, c_mktsegment, n_name, o_totalprice from orders
    left join customer on c_custkey = o_custkey left join nation on n_nationkey = c_nationkey""",
)
def enrich_users(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    users = table(spark, folder, "customer")
    states = table(spark, folder, "nation")
    named = J.with_reference(orders, users, "o_custkey", "c_custkey", ["c_name", "c_mktsegment", "c_nationkey"])
    placed = J.with_reference(named, states, "c_nationkey", "n_nationkey", ["n_name"])
    return placed.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment", "n_name", "o_totalprice")


@query(
    "quarantine_rows",
    f"""select event_id, {FAULT_TEXT_SQL} as _raw, 'malformed' as _error from events where {FAULT_SQL}""",
)
def quarantine_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The texts that the schema rejects, kept as they came."""
    parsed = IN.parse_values(raw_values(spark, folder), S.RAW_TRANSACTION)
    return IN.split_values(parsed)[1].select("event_id", "_raw", "_error")
