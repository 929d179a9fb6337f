"""Feature, point-in-time and window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam import schemas as S
from goldseam.functions import columns as X
from goldseam.operators import features as FE
from goldseam.operators import joins as J
from goldseam.operators import metrics as M
from goldseam.session import materialize
from goldseam.workloads.binding import DIRTY_SQL, TX_SQL, dirty_transactions, long, ntz, r6, transactions
from goldseam.workloads.registry import query, table

AS_OF = "timestamp_ntz '2024-01-31 00:00:00'"
AS_OF_SQL = "timestamp '2024-01-31 00:00:00'"


@query(
    "asof_features",
    """with p as (select event_id, user_id, ts from events where event_type = 'purchase'),
      v as (select user_id, ts as view_ts, value as view_value from events where event_type = 'view')
    select p.event_id, p.user_id, p.ts,
      case when epoch_us(p.ts) - epoch_us(v.view_ts) <= 86400000000 then v.view_ts end as view_ts,
      case when epoch_us(p.ts) - epoch_us(v.view_ts) <= 86400000000 then v.view_value end as view_value
    from p asof left join v on p.user_id = v.user_id and p.ts >= v.view_ts""",
)
def asof_features(spark: SparkSession, folder: str) -> DataFrame:
    """Each purchase with the user's latest view of the preceding day."""
    events = table(spark, folder, "events")
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    views = events.filter("event_type = 'view'").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value")
    )
    return J.as_of_join(purchases, views, ["user_id"], "ts", "view_ts", ["view_value"], FE.DAY)


@query(
    "online_lookup",
    f"""with {TX_SQL}, u as (select user_id, arg_max(value, "timestamp") as last_view from tx
        where event_type = 'view' group by 1),
      c as (select currency, arg_max(exchange_rate, "timestamp") as current_rate from tx group by 1)
    select t.transaction_id, coalesce(u.last_view, t.value) as last_view,
      cast(coalesce(c.current_rate, 1) as double) as current_rate
    from tx t left join u using (user_id) left join c using (currency)""",
)
def online_lookup(spark: SparkSession, folder: str) -> DataFrame:
    rows = transactions(spark, folder)
    viewed = rows.filter("event_type = 'view'").select(
        "user_id", "timestamp", F.col("value").alias("last_view")
    )
    rates = rows.select("currency", "timestamp", F.col("exchange_rate").alias("current_rate"))
    users = J.latest_features(viewed, ["user_id"], "timestamp").drop("timestamp")
    pairs = J.latest_features(rates, ["currency"], "timestamp").drop("timestamp")
    requests = rows.select("transaction_id", "user_id", "currency", "value")
    first = J.with_latest(requests, users, ["user_id"], {"last_view": F.col("value")})
    both = J.with_latest(first, pairs, ["currency"], {"current_rate": 1.0})
    return both.select("transaction_id", "last_view", F.col("current_rate").cast("double").alias("current_rate"))


@query(
    "prediction_feedback",
    """select d.doc_id, d.n_chars > 1000 as predicted, cast(l.toxic as bigint) as label,
      case when l.doc_id is null then 'pending' when (d.n_chars > 1000) = (l.toxic = 1) then 'right'
        else 'wrong' end as outcome
    from documents d left join labels l using (doc_id)""",
)
def prediction_feedback(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions joined with the labels that have come in."""
    predictions = table(spark, folder, "documents").select(
        "doc_id", (F.col("n_chars") > 1000).alias("predicted")
    )
    labels = table(spark, folder, "labels").select("doc_id", long("toxic").alias("label"))
    outcome = F.when(F.col("label").isNull(), "pending").when(
        F.col("predicted") == (F.col("label") == 1), "right"
    )
    joined = predictions.join(labels, "doc_id", "left")
    return joined.withColumn("outcome", outcome.otherwise("wrong"))


_FILES_SQL = """f as (select 'pages/' || page_id || case when page_id % 50 = 7 then '.metadata.json' else '.html' end as key,
    strlen(html) as size, page_id from pages),
  r as (select 's3a://raw/' || key as path from f where page_id % 3 = 0
    union select key from f where page_id % 3 = 1 union select 's3a://raw/manifest-' || page_id from f),
  o as (select key, size from f where 's3a://raw/' || key not in (select path from r)
    and key not in (select path from r) and key not like '%.metadata.json')"""


def orphan_listing(spark: SparkSession, folder: str) -> DataFrame:
    suffix = F.when(F.col("page_id") % 50 == 7, ".metadata.json").otherwise(".html")
    files = table(spark, folder, "pages").select(
        F.concat(F.lit("pages/"), F.col("page_id").cast("string"), suffix).alias("key"),
        F.octet_length("html").cast("long").alias("size"),
        "page_id",
    )
    files = files.withColumn("full_path", F.concat(F.lit("s3a://raw/"), F.col("key")))
    data = files.filter("page_id % 3 = 0").select(F.col("full_path").alias("path"))
    keys = files.filter("page_id % 3 = 1").select(F.col("key").alias("path"))
    manifests = files.select(
        F.concat(F.lit("s3a://raw/manifest-"), F.col("page_id").cast("string")).alias("path")
    )
    return J.orphan_files(files, data.unionByName(keys).unionByName(manifests)).select("key", "size")


@query("orphan_files", f"with {_FILES_SQL} select * from o")
def orphan_files(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_listing(spark, folder)


@query("orphan_totals", f"with {_FILES_SQL} select count(*) as files, cast(sum(size) as bigint) as bytes from o")
def orphan_totals(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_listing(spark, folder).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")
    )


@query("largest_orphans", f"with {_FILES_SQL} select * from o order by size desc, key limit 20")
def largest_orphans(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_listing(spark, folder).orderBy(F.desc("size"), "key").limit(20)


_USERS_SQL = f"""u30 as (select user_id, count(*) as n, sum(amount_brl) as v,
    count(*) filter (where transaction_type = 'BUY') as buy, count(*) filter (where transaction_type = 'SELL') as sell,
    max("timestamp") as last from tx
    where "timestamp" > {AS_OF_SQL} - interval 30 day and "timestamp" <= {AS_OF_SQL} group by 1),
  pref as (select user_id, currency from tx where "timestamp" > {AS_OF_SQL} - interval 30 day
    and "timestamp" <= {AS_OF_SQL} group by 1, 2
    qualify row_number() over (partition by user_id order by count(*) desc, currency) = 1)"""


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as users with a registration date and a tier."""
    number = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        number.cast("string").alias("user_id"),
        F.date_add(F.lit("2020-01-01").cast("date"), (number % 1000).cast("int")).alias("registration_date"),
        F.element_at(F.array(*[F.lit(t) for t in S.TIERS]), (number % 3 + 1).cast("int")).alias("tier"),
    )


def user_features(spark: SparkSession, folder: str) -> DataFrame:
    return FE.user_features(
        transactions(spark, folder), F.expr(AS_OF), users=accounts(spark, folder)
    )


@query(
    "user_features_30d",
    f"""with {TX_SQL}, {_USERS_SQL}
    select u30.user_id, n as total_transactions_30d, cast(v as double) as total_volume_30d,
      round(cast(v as double) / n, 6) as avg_ticket_30d, pref.currency as preferred_currency,
      buy as transaction_count_buy, sell as transaction_count_sell, last as event_timestamp,
      date_diff('day', date '2020-01-01' + cast(c_custkey % 1000 as int), date '2024-01-31') as days_since_registration,
      ['standard', 'gold', 'platinum'][c_custkey % 3 + 1] as tier
    from u30 join pref on pref.user_id = u30.user_id left join customer on cast(c_custkey as varchar) = u30.user_id""",
)
def user_features_30d(spark: SparkSession, folder: str) -> DataFrame:
    return user_features(spark, folder).withColumn("avg_ticket_30d", r6("avg_ticket_30d"))


_PATTERNS_SQL = """pat as (select user_id, "timestamp" as event_timestamp,
    count(*) over (partition by user_id order by "timestamp" range between interval 1 hour preceding and current row)
      as transactions_last_1h,
    avg(value) over (partition by user_id order by "timestamp" range between interval 24 hour preceding and current row)
      as avg_amount_last_24h,
    count(distinct currency) over (partition by user_id order by "timestamp"
      range between interval 7 day preceding and current row) as distinct_currencies_last_7d,
    avg(cast(hour("timestamp") < 6 as int)) over (partition by user_id order by "timestamp"
      range between unbounded preceding and current row) as night_transaction_ratio
    from tx)"""


def patterns(spark: SparkSession, folder: str) -> DataFrame:
    return FE.pattern_features(transactions(spark, folder))


@query(
    "pattern_features",
    f"""with {TX_SQL}, {_PATTERNS_SQL} select distinct user_id, event_timestamp, transactions_last_1h,
      round(avg_amount_last_24h, 6) as avg_amount_last_24h, distinct_currencies_last_7d,
      round(night_transaction_ratio, 6) as night_transaction_ratio from pat""",
)
def pattern_features(spark: SparkSession, folder: str) -> DataFrame:
    return patterns(spark, folder).withColumns(
        {
            "avg_amount_last_24h": r6("avg_amount_last_24h"),
            "night_transaction_ratio": r6("night_transaction_ratio"),
        }
    )


_LATEST_SQL = f"""{_USERS_SQL}, {_PATTERNS_SQL},
  lp as (select * from pat qualify row_number() over (partition by user_id order by event_timestamp desc) = 1)"""


@query(
    "ondemand_features",
    f"""with {TX_SQL}, {_LATEST_SQL}, j as (select user_id, cast(v as double) / n as ticket, n,
        avg_amount_last_24h as recent, night_transaction_ratio as night, transactions_last_1h as n1
        from u30 join lp using (user_id))
    select user_id, round(greatest(least((recent - ticket) / case when recent = 0 then 1 else recent end, 5), -5), 6)
        as z_score_amount, night > 0.5 as is_unusual_hour,
      round(greatest(least(n1 / (n / 30.0), 20), 0), 6) as velocity_score from j""",
)
def ondemand_features(spark: SparkSession, folder: str) -> DataFrame:
    latest = J.latest_features(patterns(spark, folder), ["user_id"], "event_timestamp")
    users = user_features(spark, folder).drop("event_timestamp")
    return FE.on_demand(users, latest).withColumns(
        {"z_score_amount": r6("z_score_amount"), "velocity_score": r6("velocity_score")}
    )


@query(
    "serving_vector",
    f"""with {TX_SQL}, {_LATEST_SQL}
    select t.transaction_id, cast(t.amount_brl as double) as amount_brl, cast(hour("timestamp") as double) as hour_of_day,
      cast((dayofweek("timestamp") + 6) % 7 + 1 as double) as day_of_week,
      cast(hour("timestamp") between 8 and 18 and dayofweek("timestamp") between 1 and 5 as double) as is_business_hours,
      case when t.spread_pct = 0 then 0.01 else cast(t.spread_pct as double) end as spread_pct,
      cast(coalesce(lp.transactions_last_1h, 0) as double) as velocity_1h,
      round((t.value - coalesce(cast(u30.v as double) / u30.n, t.value))
        / greatest(coalesce(lp.avg_amount_last_24h, t.value) * 0.3, 1.0), 6) as z_score_amount
    from tx t left join u30 on u30.user_id = t.user_id left join lp on lp.user_id = t.user_id""",
)
def serving_vector(spark: SparkSession, folder: str) -> DataFrame:
    latest = J.latest_features(patterns(spark, folder), ["user_id"], "event_timestamp").drop("event_timestamp")
    users = user_features(spark, folder).select("user_id", "avg_ticket_30d")
    requests = transactions(spark, folder).join(users, "user_id", "left").join(latest, "user_id", "left")
    vector = FE.serving_vector(requests)
    return vector.select(
        "transaction_id", *[F.col(f) for f in S.MODEL_FEATURES[:-1]], r6("z_score_amount").alias("z_score_amount")
    )


_HOURLY_SQL = """hr as (select currency, date_trunc('hour', "timestamp") as h, avg(cast(exchange_rate as double)) as rate,
    avg(cast(spread_pct as double)) as spread, cast(sum(amount_brl) as double) as volume from tx group by 1, 2)"""


@query(
    "currency_features",
    f"""with {TX_SQL}, {_HOURLY_SQL}, w as (select currency, cast(h as timestamp) as h, rate,
      last(rate) over (partition by currency order by h range between unbounded preceding and interval 1 hour preceding) as r1,
      last(rate) over (partition by currency order by h range between unbounded preceding and interval 24 hour preceding) as r24,
      stddev(rate) over (partition by currency order by h range between interval 167 hour preceding and current row) as vol,
      avg(spread) over (partition by currency order by h range between interval 167 hour preceding and current row) as spr,
      sum(volume) over (partition by currency order by h range between interval 23 hour preceding and current row) as v24
      from hr)
    select currency, h as event_timestamp, round(rate, 6) as current_rate,
      round((rate - r1) / nullif(r1, 0) * 100, 6) as rate_change_1h,
      round((rate - r24) / nullif(r24, 0) * 100, 6) as rate_change_24h, round(vol, 6) as volatility_7d,
      round(spr, 6) as avg_spread, round(v24, 4) as volume_24h from w""",
)
def currency_features(spark: SparkSession, folder: str) -> DataFrame:
    hourly = transactions(spark, folder).groupBy(
        "currency", F.date_trunc("hour", "timestamp").alias("hour_start")
    ).agg(
        F.avg(F.col("exchange_rate").cast("double")).alias("rate"),
        F.avg(F.col("spread_pct").cast("double")).alias("spread"),
        F.sum("amount_brl").cast("double").alias("volume"),
    )
    found = FE.currency_features(hourly)
    rounded = ("current_rate", "rate_change_1h", "rate_change_24h", "volatility_7d", "avg_spread")
    return found.withColumns(
        {
            "event_timestamp": ntz("event_timestamp"),
            "volume_24h": F.round("volume_24h", 4),
            **{n: r6(n) for n in rounded},
        }
    )


@query(
    "materialize_latest",
    """select user_id, event_id, ts, value from events where ts > timestamp '2024-01-10' and ts <= timestamp '2024-01-20'
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def materialize_latest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    start, end = F.expr("timestamp_ntz '2024-01-10 00:00:00'"), F.expr("timestamp_ntz '2024-01-20 00:00:00'")
    return FE.materialize_view(rows, ["user_id"], "ts", start, end, ["event_id"])


@query(
    "materialize_incremental",
    """select user_id, event_id, ts, value from events where ts <= timestamp '2024-01-25'
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
)
def materialize_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """A first load up to the 15th, then a refresh from its high-water mark."""
    rows = table(spark, folder, "events").select("user_id", "event_id", "ts", "value")
    first = FE.materialize_view(rows, ["user_id"], "ts", None, F.expr("timestamp_ntz '2024-01-15 00:00:00'"))
    return FE.refresh_online(first, rows, ["user_id"], "ts", F.expr("timestamp_ntz '2024-01-25 00:00:00'"))


@query(
    "rate_anomaly",
    """with c as (select event_id, event_type, ts, (value - lag(value) over w) / nullif(lag(value) over w, 0) * 100 as chg
        from events window w as (partition by event_type order by ts, event_id)),
      s as (select *, count(chg) over r as n, avg(chg) over r as mu, stddev(chg) over r as sd from c
        window r as (partition by event_type order by ts, event_id rows between 19 preceding and current row))
    select event_id, coalesce(n >= 5 and sd > 0 and abs(chg - mu) > 2 * sd, false) as is_anomaly from s""",
)
def rate_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "event_type", "ts", "value")
    return FE.rate_changes(rows, "event_type", "ts", "value", "event_id").select("event_id", "is_anomaly")


@query(
    "temporal_split",
    """with r as (select event_id, row_number() over (order by ts, event_id) as i, count(*) over () as n from events)
    select event_id, case when i <= floor(n * 0.7) then 'train' when i <= floor(n * 0.7) + floor(n * 0.15)
      then 'validation' else 'test' end as split from r""",
)
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "ts")
    return M.chronological_split(rows, ["ts", "event_id"]).select("event_id", "split")


@query(
    "avg_over_24h",
    """select distinct event_type, ts, round(cast(sum(cast(value as decimal(15,2))) over w as double) / count(*) over w, 9)
      as avg_24h from events window w as (partition by event_type order by ts
      range between interval 24 hour preceding and current row)""",
)
def avg_over_24h(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "event_type", "ts", F.col("value").cast("decimal(15,2)").alias("value")
    )
    found = FE.average_over_span(rows, ["event_type"], "ts", "value", FE.DAY, "avg_24h")
    return found.withColumn("avg_24h", F.round("avg_24h", 9))


@query(
    "user_zscore",
    """with s as (select event_id, value, count(*) over w as n, avg(value) over w as mu, stddev(value) over w as sd
      from events window w as (partition by user_id order by ts, event_id rows between unbounded preceding and 1 preceding))
    select event_id, round(case when n >= 2 then (value - mu) / nullif(sd, 0) end, 4) as z_score from s""",
)
def user_zscore(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "value")
    found = FE.history_zscore(rows, "user_id", "ts", "value", "event_id")
    return found.select("event_id", F.round("z_score", 4).alias("z_score"))


@query(
    "unusual_hour",
    f"""with {TX_SQL} select transaction_id, hour("timestamp") < 6 or hour("timestamp") > 23 as is_unusual_hour from tx""",
)
def unusual_hour(spark: SparkSession, folder: str) -> DataFrame:
    rows = transactions(spark, folder)
    return rows.select("transaction_id", X.night_by_hour("timestamp").alias("is_unusual_hour"))


@query(
    "score_minmax",
    """with m as (select min(value) as lo, max(value) as hi from events)
    select event_id, round((value - lo) / (hi - lo + 1e-9), 6) as score, cast(event_type = 'error' as int) as label
    from events, m""",
)
def score_minmax(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events")
    low, high = M.value_range(rows, "value")
    score = X.min_max("value", F.lit(low), F.lit(high))
    prediction = F.when(F.col("event_type") == "error", -1).otherwise(1)
    return rows.select("event_id", r6(score).alias("score"), X.outlier_to_label(prediction).alias("label"))


@query(
    "score_norm",
    """select event_id, round(coalesce(least(greatest(case when event_id % 31 <> 0 then value / 100 end / 0.5, 0), 1),
      case when event_type = 'error' then 0.8 else 0.2 end), 6) as score from
      (select *, case when event_id % 31 <> 0 then 1 end as has from events) where has = 1
    union all select event_id, case when event_type = 'error' then 0.8 else 0.2 end from events where event_id % 31 = 0""",
)
def score_norm(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("event_id") % 31 != 0, F.col("value") / 100)
    prediction = F.when(F.col("event_type") == "error", -1).otherwise(1)
    rows = table(spark, folder, "events")
    return rows.select("event_id", r6(X.score_from_raw(raw, prediction)).alias("score"))


_TRAINING_SQL = f"""{DIRTY_SQL}, view as (select distinct user_id, "timestamp",
    count(*) over month as n30, cast(sum(amount_brl) over month as double) as v30,
    count(*) over hour as n1, avg(cast(amount_brl as double)) over day as recent,
    avg(cast(hour("timestamp") < 6 as int)) over upto as night from tx
    window month as (partition by user_id order by "timestamp" range between interval 30 day preceding and current row),
      hour as (partition by user_id order by "timestamp" range between interval 1 hour preceding and current row),
      day as (partition by user_id order by "timestamp" range between interval 24 hour preceding and current row),
      upto as (partition by user_id order by "timestamp" range between unbounded preceding and current row)),
  training as (select d.*, n30, v30, n1, recent, night, case when recent is not null then
    greatest(least((recent - v30 / n30) / case when recent = 0 then 1 else recent end, 5), -5) end as z
    from dirty d left join view using (user_id, "timestamp"))"""

_MATRIX_SQL = f"""{_TRAINING_SQL}, fm as (select transaction_id, coalesce(cast(amount_brl as double), 0) as amount_brl,
    coalesce(cast(hour("timestamp") as double), 0) as hour_of_day,
    coalesce(cast(dayofweek("timestamp") + 1 as double), 0) as day_of_week,
    coalesce(cast(hour("timestamp") between 9 and 17 and dayofweek("timestamp") between 1 and 5 as double), 0)
      as is_business_hours,
    cast(spread_pct as double) as spread_pct, coalesce(cast(n1 as double), 0) as velocity_1h,
    coalesce(z, 0) as z_score_amount, cast(is_anomaly as int) as label from training)"""

#: The features of the two user views that go into training.
_USER_COLUMNS = ("total_transactions_30d", "total_volume_30d", "avg_ticket_30d")
_PATTERN_COLUMNS = ("transactions_last_1h", "avg_amount_last_24h", "night_transaction_ratio")


def training(spark: SparkSession, folder: str) -> DataFrame:
    """Silver rows with the features of two views at their time."""
    from goldseam.operators import refine as R

    known = transactions(spark, folder)
    views = [
        (FE.user_history(known), S.USER_FEATURES, _USER_COLUMNS),
        (FE.pattern_features(known), S.PATTERN_FEATURES, _PATTERN_COLUMNS),
    ]
    silver = R.enrich(dirty_transactions(spark, folder))
    return FE.training_signals(J.training_rows(silver, views, "timestamp"))


@query(
    "training_frame",
    f"""with {_TRAINING_SQL} select transaction_id, n30 as total_transactions_30d, round(v30, 6) as total_volume_30d,
      round(v30 / n30, 6) as avg_ticket_30d, n1 as transactions_last_1h, round(recent, 6) as avg_amount_last_24h,
      round(night, 6) as night_transaction_ratio, round(z, 6) as z_score_amount from training""",
)
def training_frame(spark: SparkSession, folder: str) -> DataFrame:
    """Six features of two views and the amount's deviation, as known at each transaction."""
    return training(spark, folder).select(
        "transaction_id",
        "total_transactions_30d",
        r6(F.col("total_volume_30d").cast("double")).alias("total_volume_30d"),
        r6("avg_ticket_30d").alias("avg_ticket_30d"),
        "transactions_last_1h",
        r6("avg_amount_last_24h").alias("avg_amount_last_24h"),
        r6("night_transaction_ratio").alias("night_transaction_ratio"),
        r6("z_score_amount").alias("z_score_amount"),
    )


def model_matrix(spark: SparkSession, folder: str) -> DataFrame:
    """The inputs of the detectors for every transaction, written once: models read it often."""
    rows = training(spark, folder)
    return materialize(FE.feature_matrix(rows, S.MODEL_FEATURES, keep=["transaction_id"]), "matrix")


@query(
    "feature_matrix",
    f"with {_MATRIX_SQL} select * replace (round(z_score_amount, 6) as z_score_amount) from fm",
)
def feature_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return model_matrix(spark, folder).withColumn("z_score_amount", r6("z_score_amount"))


_SCALED = ", ".join(
    f"round(({f} - avg({f}) over ()) / case when stddev_pop({f}) over () = 0 then 1 else stddev_pop({f}) over () end, 6) as {f}"
    for f in S.MODEL_FEATURES
)


@query("standardize", f"with {_MATRIX_SQL} select transaction_id, {_SCALED}, label from fm")
def standardize(spark: SparkSession, folder: str) -> DataFrame:
    scaled = FE.standardize(model_matrix(spark, folder), S.MODEL_FEATURES)
    return scaled.withColumns({f: r6(f) for f in S.MODEL_FEATURES})
