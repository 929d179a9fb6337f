"""Quality, profile and monitoring queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldseam import schemas as S
from goldseam.functions import columns as X
from goldseam.operators import features as FE
from goldseam.operators import gold as G
from goldseam.operators import joins as J
from goldseam.operators import metrics as M
from goldseam.operators import monitoring as MO
from goldseam.operators import quality as Q
from goldseam.operators import refine as R
from goldseam.operators import runs as RU
from goldseam.operators import versions as V
from goldseam.session import new_path
from goldseam.sources import inputs as IN
from goldseam.sources import outputs as OUT
from goldseam.workloads.binding import (
    DIRTY_SQL,
    RUNS_SQL,
    TX_SQL,
    dirty_transactions,
    long,
    money,
    ntz,
    r6,
    transactions,
)
from goldseam.workloads.registry import query, table

_VALID = ", ".join(f"'{c}'" for c in S.VALID_CURRENCIES)
NOW = "timestamp_ntz '2024-01-31 06:00:00'"
NOW_SQL = "timestamp '2024-01-31 06:00:00'"


def _report_sql(source: str, table_name: str, checks: list[tuple[str, str]]) -> str:
    """SQL of a one-row report; each check is (name, expression counting bad rows)."""
    counts = ", ".join(f"{e} as b{i}" for i, (_, e) in enumerate(checks))
    passed = " + ".join(f"cast(b{i} = 0 as int)" for i in range(len(checks)))
    failures = ", ".join(
        f"case when b{i} > 0 then '{n}=' || b{i} end" for i, (n, _) in enumerate(checks)
    )
    n = len(checks)
    return f"""c as (select {counts} from {source})
      select '{table_name}' as table_name, {n}::bigint as total_checks, ({passed})::bigint as passed,
        ({n} - ({passed}))::bigint as failed, case when {passed} = {n} then 'PASS' else 'FAIL' end as overall,
        concat_ws('; ', {failures}) as failures from c"""


@query(
    "quality_report",
    "with "
    + _report_sql(
        "lineitem",
        "lineitem",
        [
            ("NOT_NULL(l_orderkey)", "count(*) filter (where l_orderkey is null)"),
            ("UNIQUE(l_orderkey)", "count(*) - count(distinct l_orderkey)"),
            ("RANGE(l_quantity, [1, 40])", "count(*) filter (where l_quantity < 1 or l_quantity > 40)"),
            ("ALLOWED_VALUES(l_returnflag)", "count(*) filter (where l_returnflag not in ('A', 'N'))"),
            (
                "REFERENTIAL_INTEGRITY(l_orderkey -> o_orderkey)",
                "(select count(distinct l_orderkey) from lineitem where l_orderkey not in "
                "(select o_orderkey from orders))",
            ),
            ("ROW_COUNT(lineitem)", "greatest(100 - count(*), 0)"),
        ],
    ),
)
def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        Q.not_null("l_orderkey"),
        Q.unique("l_orderkey"),
        Q.in_range("l_quantity", 1, 40),
        Q.allowed_values("l_returnflag", ["A", "N"]),
        Q.references("l_orderkey", table(spark, folder, "orders"), "o_orderkey"),
        Q.row_count(100, "lineitem"),
    ]
    return Q.run_all(table(spark, folder, "lineitem"), rules, "lineitem")


@query(
    "quality_bronze",
    f"with {DIRTY_SQL}, "
    + _report_sql(
        "dirty",
        "bronze.transactions",
        [
            ("NOT_NULL(transaction_id)", "count(*) filter (where transaction_id is null)"),
            ("NOT_NULL(user_id)", "count(*) filter (where user_id is null)"),
            ("NOT_NULL(timestamp)", 'count(*) filter (where "timestamp" is null)'),
            (
                "RANGE(amount_brl, [0.01, 10000000])",
                "count(*) filter (where amount_brl < 0.01 or amount_brl > 10000000)",
            ),
            ("ROW_COUNT(bronze.transactions)", "greatest(1 - count(*), 0)"),
        ],
    ),
)
def quality_bronze(spark: SparkSession, folder: str) -> DataFrame:
    return Q.run_all(dirty_transactions(spark, folder), Q.bronze_suite(), "bronze.transactions")


@query(
    "quality_silver",
    f"with {DIRTY_SQL}, "
    + _report_sql(
        f"""(select * from dirty where amount_brl > 0 and upper(currency) in ({_VALID})
          and "timestamp" is not null and user_id is not null)""",
        "silver.transactions",
        [
            ("NOT_NULL(transaction_id)", "count(*) filter (where transaction_id is null)"),
            ("NOT_NULL(amount_usd)", "count(*) filter (where amount_brl is null)"),
            (
                "RANGE(amount_brl, [0.01, 10000000])",
                "count(*) filter (where amount_brl < 0.01 or amount_brl > 10000000)",
            ),
            ("ALLOWED_VALUES(currency)", f"count(*) filter (where upper(currency) not in ({_VALID}))"),
            ("ROW_COUNT(silver.transactions)", "greatest(1 - count(*), 0)"),
        ],
    ),
)
def quality_silver(spark: SparkSession, folder: str) -> DataFrame:
    silver = R.enrich(R.clean(dirty_transactions(spark, folder)))
    return Q.run_all(silver, Q.silver_suite(), "silver.transactions")


@query(
    "quality_unique",
    """select count(*) as total_rows, count(distinct l_partkey) as unique_values,
      count(*) - count(distinct l_partkey) as duplicates from lineitem""",
)
def quality_unique(spark: SparkSession, folder: str) -> DataFrame:
    return Q.duplicates(table(spark, folder, "lineitem"), "l_partkey")


@query(
    "ri_orphans",
    "select distinct doc_id from documents where doc_id not in (select doc_id from labels)",
)
def ri_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return Q.orphans(table(spark, folder, "documents"), "doc_id", table(spark, folder, "labels"), "doc_id")


_LI = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()


@query(
    "profile_nulls",
    " union all ".join(
        f"""select '{c}' as column_name, count(*) filter (where {c} is null
        {"or l_quantity > 45" if c == "l_tax" else ""}) as null_count, count(*) as total_rows,
        round(count(*) filter (where {c} is null {"or l_quantity > 45" if c == "l_tax" else ""})
        * 100.0 / count(*), 2) as null_pct from lineitem"""
        for c in _LI
    ),
)
def profile_nulls(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem").select(*_LI)
    return Q.profile_nulls(rows.withColumn("l_tax", F.when(F.col("l_quantity") <= 45, F.col("l_tax"))))


_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "profile_numeric",
    " union all ".join(
        f"""select '{c}' as column_name, count({c}) as non_null, min({c}) as min,
        round(quantile_cont({c}, 0.25), 6) as p25, round(quantile_cont({c}, 0.5), 6) as p50,
        round(quantile_cont({c}, 0.75), 6) as p75, max({c}) as max, round(avg({c}), 4) as mean,
        round(stddev({c}), 4) as stddev from lineitem"""
        for c in _NUMERIC
    ),
)
def profile_numeric(spark: SparkSession, folder: str) -> DataFrame:
    found = Q.profile_numeric(table(spark, folder, "lineitem"), _NUMERIC)
    exact = {n: r6(n) for n in ("p25", "p50", "p75")}
    return found.withColumns({**exact, "mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query(
    "profile_daily_counts",
    """select cast(ts as date) as date, count(*) as count from events
    where cast(ts as date) >= date '2024-01-11' group by 1""",
)
def profile_daily_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    return Q.daily_counts(rows, F.to_date("ts"), F.lit("2024-01-11").cast("date"))


@query(
    "freshness",
    f"""select max(cast(ts as date)) as latest_partition,
      round(epoch({NOW_SQL} - cast(max(cast(ts as date)) as timestamp)) / 3600.0, 1) as freshness_hours,
      epoch({NOW_SQL} - cast(max(cast(ts as date)) as timestamp)) / 3600.0 > 48 as stale from events""",
)
def freshness(spark: SparkSession, folder: str) -> DataFrame:
    return Q.freshness(table(spark, folder, "events"), F.to_date("ts"), F.expr(NOW))


@query(
    "value_shares",
    """select o_orderpriority, count(*) as n, round(count(*) * 100.0 / sum(count(*)) over (), 6) as pct
    from orders group by 1""",
)
def value_shares(spark: SparkSession, folder: str) -> DataFrame:
    return Q.value_shares(table(spark, folder, "orders"), "o_orderpriority").withColumn("pct", r6("pct"))


@query(
    "hourly_anomaly_rate",
    """select hour(ts) as hour_of_day, round(count(*) filter (where event_type <> 'error') / count(*), 6) as normal,
      round(count(*) filter (where event_type = 'error') / count(*), 6) as anomalous from events group by 1""",
)
def hourly_anomaly_rate(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        long(F.hour("ts")).alias("hour_of_day"), (F.col("event_type") == "error").cast("int").alias("label")
    )
    wide = rows.groupBy("hour_of_day").pivot("label", [0, 1]).count().fillna(0)
    total = F.col("0") + F.col("1")
    return wide.select(
        "hour_of_day", r6(X.ratio("0", total)).alias("normal"), r6(X.ratio("1", total)).alias("anomalous")
    )


@query(
    "topic_stats",
    """select event_type as topic, count(*) as messages, arg_max(props, event_id) as last_message
    from events group by 1""",
)
def topic_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").withColumnRenamed("event_type", "topic")
    return MO.topic_stats(rows, "topic", "props", "event_id")


@query(
    "risk_level",
    """select event_id, value / 100 as score, case when value / 100 >= 0.7 then 'high'
      when value / 100 >= 0.4 then 'medium' else 'low' end as risk_level, value / 100 >= 0.4 as is_anomaly
    from events""",
)
def risk_level(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", (F.col("value") / 100).alias("score"))
    return rows.withColumns({"risk_level": X.risk_level("score"), "is_anomaly": X.risk_flag("score")})


@query(
    "risk_counts",
    """select case when event_type = 'error' then 'error' else 'ok' end as status,
      case when value / 100 >= 0.7 then 'high' when value / 100 >= 0.4 then 'medium' else 'low' end as risk_level,
      count(*) as requests from events group by 1, 2""",
)
def risk_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    status = F.when(F.col("event_type") == "error", "error").otherwise("ok")
    level = X.risk_level(F.col("value") / 100)
    return rows.groupBy(status.alias("status"), level.alias("risk_level")).agg(
        F.count(F.lit(1)).alias("requests")
    )


# Bucket bounds of the latency histogram in milliseconds.
LATENCY_BOUNDS = (5, 10, 25, 50, 75, 100, 200, 500, 1000)
_BOUNDS_SQL = ", ".join(f"({float(b)})" for b in LATENCY_BOUNDS)
_BUCKETS_SQL = f"""b as (select le, (select count(*) from events e where e.event_type = t.event_type
    and e.value <= b.le) as cum_count, t.event_type from (values {_BOUNDS_SQL}) b(le),
    (select distinct event_type from events) t
  union all select null, count(*), event_type from events group by event_type)"""


@query("bucket_histogram", f"with {_BUCKETS_SQL} select event_type, cast(le as double) as le, cum_count from b")
def bucket_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return M.bucket_counts(table(spark, folder, "events"), "value", LATENCY_BOUNDS, ["event_type"])


@query(
    "histogram_quantile",
    f"""with {_BUCKETS_SQL},
      r as (select *, coalesce(le, 'inf'::double) as hi,
        lag(cum_count, 1, 0) over w as prev, lag(le, 1, 0) over w as lo,
        0.95 * max(cum_count) over (partition by event_type) as rank
        from b window w as (partition by event_type order by coalesce(le, 'inf'::double))),
      h as (select * from r where cum_count >= rank
        qualify row_number() over (partition by event_type order by hi) = 1)
    select event_type, round(case when le is null then lo
      else lo + (le - lo) * (rank - prev) / (cum_count - prev) end, 6) as value from h""",
)
def histogram_quantile(spark: SparkSession, folder: str) -> DataFrame:
    buckets = M.bucket_counts(table(spark, folder, "events"), "value", LATENCY_BOUNDS, ["event_type"])
    return M.bucket_quantile(buckets, 0.95, ["event_type"]).withColumn("value", r6("value"))


@query(
    "latency_percentiles",
    """select event_type, round(quantile_cont(value, 0.5), 6) as p50, round(quantile_cont(value, 0.95), 6) as p95,
      round(quantile_cont(value, 0.99), 6) as p99 from events group by 1""",
)
def latency_percentiles(spark: SparkSession, folder: str) -> DataFrame:
    wanted = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = M.percentiles(table(spark, folder, "events"), "value", wanted, ["event_type"])
    return found.withColumns({n: r6(n) for n in wanted})


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a label, a score and the prediction that the score implies."""
    rows = table(spark, folder, "events")
    return rows.select(
        "event_id",
        "ts",
        (F.col("event_type") == "error").cast("int").alias("label"),
        F.col("value").alias("score"),
        (F.col("value") >= 20).cast("int").alias("prediction"),
    )


_LABELLED_SQL = """l as (select event_id, ts, cast(event_type = 'error' as int) as label, value as score,
  cast(value >= 20 as int) as prediction from events)"""


@query(
    "classification_metrics",
    f"""with {_LABELLED_SQL}, c as (select count(*) filter (where label = 1 and prediction = 1) as tp,
      count(*) filter (where label = 0 and prediction = 1) as fp,
      count(*) filter (where label = 1 and prediction = 0) as fn,
      count(*) filter (where label = 0 and prediction = 0) as tn from l)
    select tp, fp, fn, tn, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall,
      round(2 * tp / (2 * tp + fp + fn), 6) as f1 from c""",
)
def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = M.confusion(labelled(spark, folder))
    return found.withColumns({n: r6(n) for n in ("precision", "recall", "f1")})


_AUC_SQL = f"""with {_LABELLED_SQL}, r as (select label, rank() over (order by score)
    + (count(*) over (partition by score) - 1) / 2.0 as rk from l)
  select round((sum(rk) filter (where label = 1) - count(*) filter (where label = 1)
    * (count(*) filter (where label = 1) + 1) / 2.0) / (count(*) filter (where label = 1)
    * count(*) filter (where label = 0)), 6) as auc_roc from r"""


@query("roc_auc", _AUC_SQL)
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return M.roc_auc(labelled(spark, folder)).withColumn("auc_roc", r6("auc_roc"))


@query(
    "pr_curve",
    f"""with {_LABELLED_SQL}, s as (select score, count(*) filter (where label = 1) as p,
        count(*) filter (where label = 0) as n from l group by score),
      c as (select score, sum(p) over (order by score desc) as tp, sum(n) over (order by score desc) as fp,
        sum(p) over () as all_p from s)
    select score as threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
      round(tp / (tp + fp), 6) as precision, round(tp / all_p, 6) as recall from c""",
)
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return M.pr_curve(labelled(spark, folder)).withColumns(
        {"precision": r6("precision"), "recall": r6("recall")}
    )


def _histogram_sql(source: str, by: str = "") -> str:
    """SQL of a histogram over (value, label) in 50 bins."""
    keys, names = (f"{by}, ", f"{by}, ") if by else ("", "")
    return f"""e as (select min(v) as lo, max(v) as hi from {source}),
      b as (select {keys} least(cast(floor((v - lo) / ((hi - lo) / 50)) as int), 49) as bin, lo,
        (hi - lo) / 50 as w from {source}, e)
      select {names} cast(bin as bigint) as bin, count(*) as n, round(lo + bin * w, 6) as bin_start,
        round(lo + (bin + 1) * w, 6) as bin_end"""


@query(
    "score_histogram",
    f"""with s as (select value as v from events), {_histogram_sql("s")} from b group by bin, lo, w""",
)
def score_histogram(spark: SparkSession, folder: str) -> DataFrame:
    found = M.equal_width_histogram(table(spark, folder, "events"), "value", 50)
    return found.withColumns(
        {"bin": long("bin"), "bin_start": r6("bin_start"), "bin_end": r6("bin_end")}
    )


@query(
    "log_hist",
    f"""with s as (select ln(1 + value) as v, cast(event_type = 'error' as int) as label from events),
      {_histogram_sql("s", "label")},
      round(count(*) / sum(count(*)) over (partition by label) / w, 6) as density
      from b group by label, bin, lo, w""",
)
def log_hist(spark: SparkSession, folder: str) -> DataFrame:
    """Distribution of the log amount of normal and anomalous rows."""
    rows = table(spark, folder, "events").select(
        F.log1p("value").alias("v"), (F.col("event_type") == "error").cast("int").alias("label")
    )
    found = M.equal_width_histogram(rows, "v", 50, by="label", density=True)
    rounded = {n: r6(n) for n in ("bin_start", "bin_end", "density")}
    return found.withColumns({"bin": long("bin"), **rounded})


def _psi_sql(name: str, value: str) -> str:
    """SQL terms of one feature's stability index between the two halves of the month."""
    return f"""
      x_{name} as (select {value} as v, ts < timestamp '2024-01-16' as e from events),
      q_{name} as (select list_sort(list_distinct(quantile_cont(v, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8,
        0.9, 1]))) as edges from x_{name} where e),
      i_{name} as (select unnest(range(1, len(edges))) as i, edges from q_{name}),
      p_{name} as (select i, (select count(*) from x_{name} where e and v >= edges[i] and (v < edges[i + 1]
          or (i = len(edges) - 1 and v = edges[i + 1]))) / (select count(*) from x_{name} where e) as e,
        (select count(*) from x_{name} where not e and v >= edges[i] and (v < edges[i + 1]
          or (i = len(edges) - 1 and v = edges[i + 1]))) / (select count(*) from x_{name} where not e) as a
        from i_{name}),
      psi_{name} as (select '{name}' as feature, coalesce(sum((case when a = 0 then 1e-6 else a end
        - case when e = 0 then 1e-6 else e end) * ln(case when a = 0 then 1e-6 else a end
        / case when e = 0 then 1e-6 else e end)), 0) as psi from p_{name})"""


def halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Three features in long form, first and second half of the month."""
    rows = table(spark, folder, "events").select(
        "ts",
        F.col("value").alias("amount"),
        F.hour("ts").alias("hour"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    names = ["amount", "hour", "k"]
    border = F.expr("timestamp_ntz '2024-01-16 00:00:00'")
    first = Q.unpivot(rows.filter(F.col("ts") < border), names)
    second = Q.unpivot(rows.filter(F.col("ts") >= border), names)
    return first.withColumnRenamed("name", "feature"), second.withColumnRenamed("name", "feature")


_FEATURES_SQL = ",".join(
    _psi_sql(n, v)
    for n, v in (("amount", "value"), ("hour", "hour(ts)"), ("k", "cast(json_extract(props, '$.k') as double)"))
)


@query(
    "psi_drift",
    f"""with {_psi_sql("amount", "value")} select round(psi, 6) as psi, psi >= 0.2 as drifted from psi_amount""",
)
def psi_drift(spark: SparkSession, folder: str) -> DataFrame:
    first, second = (h.filter("feature = 'amount'") for h in halves(spark, folder))
    return M.drift(first, second, [], "value").select(r6("psi").alias("psi"), "drifted")


@query(
    "feature_drift",
    f"""with {_FEATURES_SQL}, p as (select * from psi_amount union all select * from psi_hour
        union all select * from psi_k)
    select feature, round(psi, 6) as psi, psi >= 0.2 as drifted,
      case when (select bool_or(psi >= 0.2) from p) then 'WARNING' else 'OK' end as overall_status from p""",
)
def feature_drift(spark: SparkSession, folder: str) -> DataFrame:
    first, second = halves(spark, folder)
    found = M.drift(first, second, ["feature"], "value", min_rows=10)
    summary = M.drift_summary(found.withColumn("view", F.lit("events")))
    drifted = summary.agg(F.count_if("has_drift").alias("n")).scalar()
    return found.select(
        "feature", r6("psi").alias("psi"), "drifted",
        M.overall_status(F.lit(0), drifted).alias("overall_status"),
    )


VALIDATED_AT = "2024-01-31 01:30:00"


@query(
    "feature_validation",
    f"""with {_FEATURES_SQL}, p as (select * from psi_amount union all select * from psi_hour
        union all select * from psi_k),
    v as (select event_type as view, max(ts) as last_updated from events group by 1
      union all select 'not materialised', null),
    f as (select view, (epoch_us(timestamp '{VALIDATED_AT}') - epoch_us(last_updated)) / 3600000000.0 as age from v),
    t as (select view, round(age, 6) as hours_since_update,
      case when age is null then 'UNKNOWN' when age > 2 then 'STALE' else 'FRESH' end as status from f)
    select *, (select count(*) from p where psi >= 0.2) as drifted_features,
      case when (select count(*) from t where status = 'STALE') > 0 then 'CRITICAL'
        when (select bool_or(psi >= 0.2) from p) then 'WARNING' else 'OK' end as overall_status from t""",
)
def feature_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Freshness of every view, drifted features and the status of all: stale views are critical."""
    events = table(spark, folder, "events")
    views = events.groupBy(F.col("event_type").alias("view")).agg(F.max("ts").alias("last_updated"))
    missing = spark.range(1).select(
        F.lit("not materialised").alias("view"), F.lit(None).cast(views.schema["last_updated"].dataType).alias("last_updated")
    )
    fresh = FE.view_freshness(views.unionByName(missing), F.expr(f"timestamp_ntz '{VALIDATED_AT}'"), 2.0)
    first, second = halves(spark, folder)
    drift = M.drift(first, second, ["feature"], "value", min_rows=10)
    drifted = drift.agg(F.count_if("drifted").alias("n")).scalar()
    stale = fresh.agg(F.count_if(F.col("status") == "STALE").alias("n")).scalar()
    return fresh.select(
        "view",
        r6("hours_since_update").alias("hours_since_update"),
        "status",
        drifted.alias("drifted_features"),
        M.overall_status(stale, drifted).alias("overall_status"),
    )


@query(
    "sla_compliance",
    """with r as (select o_orderkey, o_orderdate, min(l_shipdate) as done from orders
      join lineitem on l_orderkey = o_orderkey group by 1, 2)
    select count(*) as runs, round(avg(cast(abs(epoch(done - o_orderdate)) <= 86400 * 365 as int)), 6) as compliance,
      max(done) filter (where abs(epoch(done - o_orderdate)) <= 86400 * 365) as last_success from r""",
)
def sla_compliance(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as runs that end with the first shipment."""
    first = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("done"))
    runs = table(spark, folder, "orders").join(first, F.col("o_orderkey") == F.col("l_orderkey"))
    seconds = F.abs(
        F.unix_seconds(F.col("done").cast("timestamp")) - F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    )
    return MO.sla_compliance(runs, seconds, 86_400 * 365, "done").withColumn("compliance", r6("compliance"))


@query(
    "detected_vs_injected",
    """select cast(ts as date) as date, count(*) filter (where value >= 20) as detected,
      count(*) filter (where event_type = 'error') as injected,
      count(*) filter (where value >= 20 and event_type = 'error') as both from events group by 1""",
)
def detected_vs_injected(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    return MO.detected_vs_injected(
        rows, F.to_date("ts"), F.col("value") >= 20, F.col("event_type") == "error"
    )


def offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messages: produced up to the last id, committed up to the last cheap one."""
    return table(spark, folder, "events").groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 6).alias("partition")
    ).agg(
        F.lit("etl").alias("group"),
        F.max("event_id").alias("latest"),
        F.coalesce(F.max(F.when(F.col("value") < 1, F.col("event_id"))), F.lit(0)).alias("committed"),
    )


@query(
    "lag_max",
    """with o as (select event_type as topic, user_id % 6 as partition, max(event_id) as latest,
      coalesce(max(event_id) filter (where value < 1), 0) as committed from events group by 1, 2)
    select 'etl' as "group", topic, max(latest - committed) as max_lag, max(latest - committed) > 10000 as critical
    from o group by topic""",
)
def lag_max(spark: SparkSession, folder: str) -> DataFrame:
    return MO.consumer_lag(offsets(spark, folder), "group", "topic")


@query(
    "quality_pass_rate",
    f"""with {DIRTY_SQL}, l as (select 'bronze' as layer, amount_brl is null or amount_brl <= 0 as bad from dirty
      union all select 'silver', amount_brl is null or amount_brl <= 0 from dirty where amount_brl > 0)
    select layer, count(*) as total_records, count(*) filter (where bad) as failed_records,
      round(1 - count(*) filter (where bad) / count(*), 6) as pass_rate from l group by layer""",
)
def quality_pass_rate(spark: SparkSession, folder: str) -> DataFrame:
    bronze = dirty_transactions(spark, folder).select("amount_brl")
    layers = bronze.withColumn("layer", F.lit("bronze")).unionByName(
        bronze.filter("amount_brl > 0").withColumn("layer", F.lit("silver"))
    )
    bad = F.col("amount_brl").isNull() | (F.col("amount_brl") <= 0)
    return V.share_failed(layers, bad, ["layer"]).withColumn("pass_rate", r6("pass_rate"))


@query(
    "low_volume",
    """with h as (select date_trunc('hour', ts) as hour, count(*) as n from events group by 1),
      a as (select hour, n, avg(n) over (order by hour rows between unbounded preceding and 1 preceding) as m from h)
    select cast(hour as timestamp) as hour, n, round(m, 6) as avg_n, coalesce(n < m * 0.5, false) as low from a""",
)
def low_volume(spark: SparkSession, folder: str) -> DataFrame:
    found = MO.low_volume(MO.hourly_volume(table(spark, folder, "events"), "ts"))
    return found.withColumns({"hour": ntz("hour"), "avg_n": r6("avg_n")})


@query(
    "ingestion_gaps",
    """with g as (select ts as gap_start, lead(ts) over (order by ts) as gap_end from events)
    select gap_start, gap_end, (epoch_us(gap_end) - epoch_us(gap_start)) / 1e6 as gap_seconds from g
    where epoch_us(gap_end) - epoch_us(gap_start) > 900000000""",
)
def ingestion_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps of more than a quarter of an hour."""
    return MO.ingestion_gaps(table(spark, folder, "events"), "ts", 900)


@query(
    "alert_islands",
    """with h as (select date_trunc('hour', ts) as hour, count(*) filter (where event_type = 'error') as errors
        from events group by 1),
      f as (select hour, epoch(hour) / 3600 - row_number() over (order by hour) as run from h where errors >= 3)
    select cast(min(hour) as timestamp) as run_start, cast(max(hour) as timestamp) as run_end, count(*) as buckets
    from f group by run having count(*) >= 2""",
)
def alert_islands(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of at least two hours with three or more errors each."""
    hours = table(spark, folder, "events").groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(
        F.count_if(F.col("event_type") == "error").alias("errors")
    )
    runs = MO.held_for(MO.islands(hours, "hour", F.col("errors") >= 3, 3_600), 2)
    return runs.withColumns({"run_start": ntz("run_start"), "run_end": ntz("run_end")})


@query(
    "concept_drift_f1",
    f"""with {_LABELLED_SQL}, d as (select cast(ts as date) as date,
        count(*) filter (where label = 1 and prediction = 1) as tp,
        count(*) filter (where label = 0 and prediction = 1) as fp,
        count(*) filter (where label = 1 and prediction = 0) as fn from l group by 1),
      w as (select date, sum(tp) over r as tp_7d, sum(fp) over r as fp_7d, sum(fn) over r as fn_7d from d
        window r as (order by date rows between 6 preceding and current row))
    select date, cast(tp_7d as bigint) as tp_7d, cast(fp_7d as bigint) as fp_7d, cast(fn_7d as bigint) as fn_7d,
      round(coalesce(2 * tp_7d / nullif(2 * tp_7d + fp_7d + fn_7d, 0), 0), 6) as f1_7d from w""",
)
def concept_drift_f1(spark: SparkSession, folder: str) -> DataFrame:
    daily = M.confusion(labelled(spark, folder).withColumn("date", F.to_date("ts")), keys=["date"])
    return MO.concept_drift(daily).withColumn("f1_7d", r6("f1_7d"))


@query(
    "missing_members",
    """select * from (values ('click'), ('refund'), ('chargeback'), ('view')) v(event_type)
    where event_type not in (select event_type from events)""",
)
def missing_members(spark: SparkSession, folder: str) -> DataFrame:
    """Expected event types that never occur."""
    names = F.array(*[F.lit(n) for n in ("click", "refund", "chargeback", "view")])
    expected = spark.range(1).select(F.explode(names).alias("event_type"))
    return J.missing_members(expected, table(spark, folder, "events"), "event_type")


@query(
    "msg_rate",
    """with e as (select time_bucket(interval 1 minute, ts) as m from events),
      w as (select m - to_minutes(cast(i as int)) as start from e, range(5) r(i))
    select start as window_start, start + interval 5 minute as window_end, round(count(*) / 300.0, 6) as msg_per_sec
    from w group by start""",
)
def msg_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Messages per second over five minutes, every minute."""
    rows = table(spark, folder, "events").select(F.col("ts").cast("timestamp").alias("ts"))
    counts = rows.groupBy(F.window("ts", "5 minutes", "1 minute").alias("w")).count()
    return counts.select(
        ntz("w.start").alias("window_start"),
        ntz("w.end").alias("window_end"),
        r6(F.col("count") / 300.0).alias("msg_per_sec"),
    )


@query("raw_freshness", "select 'fresh' as status, true as listed from events limit 1")
def raw_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Age of the newest file of a raw folder written just now."""
    base = new_path(spark, "fresh")
    rows = transactions(spark, folder).withColumn("event_date", F.to_date("timestamp"))
    OUT.write_raw_json(rows, base)
    found = V.freshness_of_files(IN.list_files(spark, base), F.current_timestamp())
    return found.select("status", F.col("last_modified").isNotNull().alias("listed"))


def daily_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One model run per day of events, with its scores."""
    rows = transactions(spark, folder)
    error, high = F.col("is_anomaly"), F.col("value") >= 5
    tenth = F.col("event_id") % 10 == 0
    keyed = rows.withColumns(
        {
            "day": F.to_date("timestamp"),
            "run_id": F.concat(F.lit("run-"), F.to_date("timestamp").cast("string")),
            "model_type": F.when(F.dayofmonth("timestamp") % 2 == 0, "lof").otherwise("isolation_forest"),
        }
    )
    keys = ["day", "run_id", "model_type"]
    counts = keyed.groupBy(*keys).agg(
        F.count_if(error & high).alias("tp"),
        F.count_if(~error & high & tenth).alias("fp"),
        F.count_if(error & ~high).alias("fn"),
    )
    slow = M.percentiles(keyed, "value", {"latency_p95_ms": 0.95}, keys)
    return M.add_scores(counts.join(slow, keys)).withColumn(
        "start_time", F.col("day").cast("timestamp_ntz")
    )


@query(
    "recent_runs",
    f"""with {RUNS_SQL} select run_id, model_type, cast(start_time as timestamp) as start_time, round(f1, 6) as f1
    from scored where model_type = 'lof' order by start_time desc limit 10""",
)
def recent_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = RU.recent_runs(daily_runs(spark, folder), 10, "lof")
    return found.select("run_id", "model_type", "start_time", r6("f1").alias("f1"))


@query(
    "best_run",
    f"""with {RUNS_SQL}, c as (select run_id, f1, latency_p95_ms, f1 * 0.8 + greatest(0, 1 - latency_p95_ms / 100) * 0.2
      as score from scored)
    select run_id, round(f1, 6) as f1, round(latency_p95_ms, 6) as latency_p95_ms, round(score, 6) as composite_score
    from c order by score desc, run_id limit 1""",
)
def best_run(spark: SparkSession, folder: str) -> DataFrame:
    found = RU.best_run(daily_runs(spark, folder))
    names = ("f1", "latency_p95_ms", "composite_score")
    return found.select("run_id", *[r6(n).alias(n) for n in names])


@query(
    "promotion_gate",
    f"""with {RUNS_SQL}, p as (select f1 from scored where start_time = timestamp '2024-01-10')
    select run_id, concat_ws(',', case when f1 < 0.6 then 'f1' end,
        case when latency_p95_ms > 50 then 'latency_p95' end, case when precision < 0.8 then 'precision' end,
        case when recall < 0.75 then 'recall' end,
        case when f1 < (select f1 from p) then 'production' end) as failures,
      f1 >= 0.6 and latency_p95_ms <= 50 and precision >= 0.8 and recall >= 0.75 and f1 >= (select f1 from p)
        as promoted from scored""",
)
def promotion_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Every daily run against the thresholds and the run in production since January 10th."""
    runs = daily_runs(spark, folder)
    production = runs.filter(F.col("day") == F.lit("2024-01-10").cast("date")).select("f1").scalar()
    return RU.promotion_gate(runs, production, min_f1=0.6, min_recall=0.75).select(
        "run_id", "failures", "promoted"
    )


@query(
    "model_staleness",
    f"""with {RUNS_SQL} select run_id, epoch({NOW_SQL} - start_time) > 86400 * 15 as stale from scored""",
)
def model_staleness(spark: SparkSession, folder: str) -> DataFrame:
    runs = daily_runs(spark, folder)
    stale = RU.staleness(F.col("start_time"), F.expr(NOW), 15)
    return runs.select("run_id", stale.alias("stale"))


@query(
    "feature_freshness",
    f"""select event_type as "view", max(ts) as last_updated,
      round(epoch_us({NOW_SQL}) / 3.6e9 - epoch_us(max(ts)) / 3.6e9, 4) as hours_since_update,
      case when epoch_us({NOW_SQL}) - epoch_us(max(ts)) > 6.3 * 3.6e9 then 'STALE' else 'FRESH' end as status
    from events group by 1""",
)
def feature_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Event types as views."""
    views = table(spark, folder, "events").groupBy(F.col("event_type").alias("view")).agg(
        F.max("ts").alias("last_updated")
    )
    return FE.view_freshness(views, F.expr(NOW), 6.3).withColumn(
        "hours_since_update", F.round("hours_since_update", 4)
    )


def alert_metrics(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The metrics behind the alert rules, each one row."""
    events = table(spark, folder, "events")
    now = F.unix_micros(F.expr(NOW).cast("timestamp"))
    age = (now - F.unix_micros(F.max("ts").cast("timestamp"))) / 1_000_000.0
    first, second = halves(spark, folder)
    buckets = M.bucket_counts(events, "value", LATENCY_BOUNDS)
    failing = V.share_failed(
        dirty_transactions(spark, folder), F.col("amount_brl").isNull() | (F.col("amount_brl") <= 0)
    )
    low = MO.low_volume(MO.hourly_volume(events, "ts"))
    trained = daily_runs(spark, folder).agg(F.min("start_time").alias("t"))
    return {
        "consumer_lag": MO.consumer_lag(offsets(spark, folder), "group", "topic").agg(
            F.max("max_lag").alias("value")
        ),
        "ingestion_age_seconds": events.agg(age.alias("value")),
        "latency_p95_seconds": M.bucket_quantile(buckets, 0.95).select((F.col("value") / 1000).alias("value")),
        "max_psi": M.drift(first, second, ["feature"], "value").agg(F.max("psi").alias("value")),
        "model_age_seconds": trained.select(
            ((now - F.unix_micros(F.col("t").cast("timestamp"))) / 1_000_000.0).alias("value")
        ),
        "failed_share": failing.select((1 - F.col("pass_rate")).alias("value")),
        "low_volume": low.agg(F.max_by(F.col("low").cast("int"), "hour").alias("value")),
    }


_ALERTS_SQL = f"""with {DIRTY_SQL}, {_FEATURES_SQL},
  o as (select event_type as topic, user_id % 6 as partition, max(event_id) as latest,
    coalesce(max(event_id) filter (where value < 1), 0) as committed from events group by 1, 2),
  bk as (select le, (select count(*) from events e where e.value <= b.le) as cum_count
    from (values {_BOUNDS_SQL}) b(le) union all select null, count(*) from events),
  rk as (select *, coalesce(le, 'inf'::double) as hi, lag(cum_count, 1, 0) over w as prev, lag(le, 1, 0) over w as lo,
    0.95 * max(cum_count) over () as rank from bk window w as (order by coalesce(le, 'inf'::double))),
  hv as (select date_trunc('hour', ts) as hour, count(*) as n from events group by 1),
  lv as (select hour, n, avg(n) over (order by hour rows between unbounded preceding and 1 preceding) as m from hv),
  a as (
    select 'HighConsumerLag' as alert, 'critical' as severity, 'data-engineering' as team, 10000.0 as lim,
      cast((select max(latest - committed) from o) as double) as v
    union all select 'NoDataIngestion', 'critical', 'data-engineering', 3600,
      (select (epoch_us({NOW_SQL}) - epoch_us(max(ts))) / 1e6 from events)
    union all select 'InferenceServiceCritical', 'critical', 'ml-engineering', 0.5,
      (select (case when le is null then lo else lo + (le - lo) * (rank - prev) / (cum_count - prev) end) / 1000
       from rk where cum_count >= rank order by hi limit 1)
    union all select 'DataDriftDetected', 'warning', 'ml-engineering', 0.2,
      (select max(psi) from (select psi from psi_amount union all select psi from psi_hour
        union all select psi from psi_k))
    union all select 'ModelStaleness', 'warning', 'ml-engineering', 2592000,
      (select epoch({NOW_SQL} - date_trunc('day', min(ts))) from events)
    union all select 'DataQualityDegraded', 'warning', 'data-engineering', 0.05,
      (select count(*) filter (where amount_brl is null or amount_brl <= 0) / count(*) from dirty)
    union all select 'LowTransactionVolume', 'info', 'data-engineering', 0,
      (select arg_max(case when n < m * 0.5 then 1 else 0 end, hour) from lv))"""


@query(
    "alert_report",
    _ALERTS_SQL + " select alert, severity, team, coalesce(v > lim, false) as fired, round(v, 6) as value from a",
)
def alert_report(spark: SparkSession, folder: str) -> DataFrame:
    return MO.evaluate_alerts(alert_metrics(spark, folder)).withColumn("value", r6("value"))


#: Holding times fit for evaluations once an hour.
HOURLY_RULES = (
    MO.AlertRule("HighConsumerLag", "critical", "lag", 25, held_seconds=3_600),
    MO.AlertRule("DataQualityDegraded", "warning", "failed_share", 0.05, held_seconds=3_600),
    MO.AlertRule("LowTransactionVolume", "info", "shortfall", 0.5, held_seconds=7_200),
)


def hourly_series(spark: SparkSession, folder: str) -> DataFrame:
    """The metrics of three rules by topic and hour, all from one rollup of the transactions."""
    rows = dirty_transactions(spark, folder).filter("timestamp is not null")
    bad = F.col("amount_brl").isNull() | (F.col("amount_brl") <= 0)
    rollup = rows.groupBy(F.col("event_type").alias("labels"), F.date_trunc("hour", "timestamp").alias("at")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(bad).alias("bad"),
        F.max("event_id").alias("latest"),
        F.max(F.when(F.col("value") < 5, F.col("event_id"))).alias("committed"),
    )
    past = Window.partitionBy("labels").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    lag = F.max("latest").over(past) - F.coalesce(F.max("committed").over(past), F.lit(0))
    wide = rollup.withColumn("lag", lag)
    before = Window.partitionBy("labels").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    wide = wide.withColumn("shortfall", 1 - X.ratio(F.col("n"), F.avg("n").over(before)))
    values = {"HighConsumerLag": "lag", "DataQualityDegraded": F.col("bad") / F.col("n"), "LowTransactionVolume": "shortfall"}
    pairs = [
        F.struct(F.lit(a).alias("alert"), (F.col(v) if isinstance(v, str) else v).cast("double").alias("value"))
        for a, v in values.items()
    ]
    return wide.select("labels", "at", F.inline(F.array(*pairs))).select("alert", "labels", "at", "value")


@query(
    "alert_states",
    f"""with {DIRTY_SQL}, r as (
      select event_type as labels, date_trunc('hour', "timestamp") as hr, count(*) as n,
        count(*) filter (where amount_brl is null or amount_brl <= 0) as bad, max(event_id) as latest,
        max(event_id) filter (where value < 5) as committed
      from dirty where "timestamp" is not null group by 1, 2),
    w as (select *, max(latest) over p - coalesce(max(committed) over p, 0) as lag,
        1 - n / nullif(avg(n) over (partition by labels order by hr rows between unbounded preceding and 1 preceding), 0) as shortfall
      from r window p as (partition by labels order by hr)),
    s as (select 'HighConsumerLag' as alert, 'critical' as severity, 25 as lim, 1 as hours, labels, hr, cast(lag as double) as value from w
      union all select 'DataQualityDegraded', 'warning', 0.05, 1, labels, hr, bad / n from w
      union all select 'LowTransactionVolume', 'info', 0.5, 2, labels, hr, shortfall from w),
    hits as (select *, hr - to_hours(row_number() over (partition by alert, labels order by hr)) as run from s where value > lim),
    runs as (select alert, labels, hours, run, min(hr) as began, max(hr) as ended from hits group by all),
    fired as (select alert, labels, count(*) as times_fired, max(ended) as last_fired from runs
      where ended - began >= to_hours(hours) group by all),
    now as (select max(hr) as t from r),
    l as (select alert, labels, any_value(severity) as severity, max(hr) as hr, arg_max(coalesce(value, 'nan'::double), hr) as value from s group by 1, 2)
    select l.alert, l.labels, l.severity, 'data-engineering' as team,
      case when u.began is not null and u.ended - u.began >= to_hours(u.hours) then 'firing' when u.began is not null then 'pending'
        when f.last_fired is not null then 'resolved' else 'inactive' end as state,
      round(case when isnan(l.value) then null else l.value end, 6) as value, u.began as active_since,
      coalesce(times_fired, 0) as times_fired, last_fired
    from l cross join now left join fired f on f.alert = l.alert and f.labels = l.labels
      left join runs u on u.alert = l.alert and u.labels = l.labels and u.ended = l.hr and l.hr >= now.t - to_hours(1)""",
)
def alert_states(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts by topic with their holding times, evaluated once an hour."""
    series = hourly_series(spark, folder)
    now = series.agg(F.max("at").alias("t")).scalar()
    found = MO.alert_states(series, now, HOURLY_RULES, 3_600)
    return found.withColumns({"value": r6("value"), **{c: ntz(c) for c in ("active_since", "last_fired")}})


@query(
    "alert_routing",
    _ALERTS_SQL
    + """, r(severity, receiver) as (values ('critical', 'pagerduty-critical'), ('critical', 'slack-data-alerts'),
      ('warning', 'slack-data-alerts'), ('warning', 'email-data-team'), ('info', 'slack-data-alerts'))
    select alert, a.severity, round(v, 6) as value, receiver from a join r on r.severity = a.severity where v > lim""",
)
def alert_routing(spark: SparkSession, folder: str) -> DataFrame:
    alerts = MO.evaluate_alerts(alert_metrics(spark, folder))
    return MO.route_alerts(alerts).withColumn("value", r6("value"))
