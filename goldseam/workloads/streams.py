"""Streaming queries: each runs over everything that is there and returns the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldseam.operators import forest as FO
from goldseam.session import new_path
from goldseam.sources import inputs as IN
from goldseam.streaming import changes as CH
from goldseam.streaming import ingest as IG
from goldseam.streaming import stateful as ST
from goldseam.workloads.batch import _TYPED_SQL, _typed
from goldseam.workloads.binding import (
    FAULT_SQL,
    FAULT_TEXT_SQL,
    TX_SQL,
    code,
    long,
    money,
    ntz,
    r6,
    raw_values,
)
from goldseam.workloads.features import _USERS_SQL, user_features
from goldseam.workloads.models import _NODES_SQL, _PATH_SQL, FIXED_NODES
from goldseam.workloads.registry import ORACLES, query, table


def landed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written to a folder and read back as a stream."""
    path = new_path(spark, "landed")
    rows.write.parquet(path)
    return IN.file_stream(spark, path, rows.schema)


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The events table as a stream, event time with zone so that watermarks apply."""
    schema = table(spark, folder, "events").schema
    stream = IN.file_stream(spark, folder, schema, pattern="events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "stream_raw_sink",
    f'with {TX_SQL} select cast("timestamp" as date) as event_date, {_TYPED_SQL} from tx where not {FAULT_SQL}',
)
def stream_raw_sink(spark: SparkSession, folder: str) -> DataFrame:
    base = new_path(spark, "raw")
    stream = landed(spark, raw_values(spark, folder).select("value"))
    IG.run_available(IG.json_sink(stream, base), new_path(spark, "checkpoint"))
    return _typed(IN.read_raw(spark, base, "1900-01-01", "2999-12-31"), "event_date")


@query(
    "stream_dlq",
    f"""with {TX_SQL} select event_id, case when {FAULT_SQL} then 'dead' else 'good' end as target,
      {FAULT_TEXT_SQL} as _raw, case when not {FAULT_SQL} then cast(amount_brl as double) end as amount_brl from tx""",
)
def stream_dlq(spark: SparkSession, folder: str) -> DataFrame:
    good_path, dead_path = new_path(spark, "good"), new_path(spark, "dead")
    stream = landed(spark, raw_values(spark, folder).select("event_id", "value"))
    IG.run_available(IG.split_sink(stream, good_path, dead_path), new_path(spark, "checkpoint"))
    good = spark.read.parquet(good_path).select(
        "event_id",
        F.lit("good").alias("target"),
        F.lit(None).cast("string").alias("_raw"),
        money("amount_brl").alias("amount_brl"),
    )
    dead = spark.read.parquet(dead_path).select(
        "event_id", F.lit("dead").alias("target"), "_raw", F.lit(None).cast("double").alias("amount_brl")
    )
    return good.unionByName(dead)


ORDER_ROW = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_totalprice", T.DecimalType(15, 2)),
        T.StructField("o_orderstatus", T.StringType()),
    ]
)


def order_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as change messages: a first image, updates, deletes and tombstones."""
    rows = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(15,2)")

    def state(amount, status) -> Column:
        return F.struct(
            key, "o_custkey", amount.cast("string").alias("o_totalprice"), status.alias("o_orderstatus")
        )

    def message(before, after, op: str, step: int) -> Column:
        source = F.struct((key * 10 + step).alias("lsn"))
        fields = [F.lit(op).alias("op"), F.lit(1_700_000_000_000 + step).alias("ts_ms"), source.alias("source")]
        if before is not None:
            fields.append(before.alias("before"))
        if after is not None:
            fields.append(after.alias("after"))
        return F.to_json(F.struct(F.struct(*fields).alias("payload")))

    first = state(price, F.col("o_orderstatus"))
    second = state(price + 1, F.lit("U"))
    frames = [
        rows.select(message(None, first, "r", 0).alias("value")),
        rows.filter("o_orderkey % 3 = 0").select(message(first, second, "u", 1).alias("value")),
        rows.filter("o_orderkey % 10 = 0").select(message(second, None, "d", 2).alias("value")),
        rows.filter("o_orderkey % 10 = 0").select(F.lit(None).cast("string").alias("value")),
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


_CDC_SQL = """select o_orderkey, o_custkey, cast(cast(o_totalprice as decimal(15,2))
    + case when o_orderkey % 3 = 0 then 1 else 0 end as double) as o_totalprice,
    case when o_orderkey % 3 = 0 then 'U' else o_orderstatus end as o_orderstatus from orders"""


def _applied(spark: SparkSession, folder: str, keep_deletes: bool) -> DataFrame:
    log = new_path(spark, "changes")
    stream = landed(spark, order_messages(spark, folder))
    sink = CH.change_sink(stream, ORDER_ROW, ["o_orderkey"], log, keep_deletes)
    IG.run_available(sink, new_path(spark, "checkpoint"))
    state = CH.apply_latest(spark.read.parquet(log).drop("_batch"), ["o_orderkey"])
    return state.withColumn("o_totalprice", money("o_totalprice"))


@query("cdc_apply", _CDC_SQL)
def cdc_apply(spark: SparkSession, folder: str) -> DataFrame:
    """New states only: deletes carry none and leave the row as it was."""
    return _applied(spark, folder, keep_deletes=False)


@query("cdc_apply_deletes", _CDC_SQL + " where o_orderkey % 10 <> 0")
def cdc_apply_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """Deletes remove the row."""
    return _applied(spark, folder, keep_deletes=True)


@query(
    "stream_rate_anomaly",
    """with c as (select event_id, event_type, ts, (value - lag(value) over w) / nullif(lag(value) over w, 0) * 100 as chg
        from events window w as (partition by event_type order by ts, event_id)),
      s as (select *, count(chg) over r as n, avg(chg) over r as mu, stddev(chg) over r as sd from c
        window r as (partition by event_type order by ts, event_id rows between 19 preceding and current row))
    select event_id, coalesce(n >= 5 and sd > 0 and abs(chg - mu) > 2 * sd, false) as is_anomaly from s""",
)
def stream_rate_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    """Three landings that overlap in time, each a run of its own; a last row moves the watermark on.

    A row lands up to 36 hours after its time, within the two days that rows may be late.
    """
    rows = table(spark, folder, "events").select(
        "event_type", F.col("ts").cast("timestamp").alias("ts"), "value", "event_id"
    )
    landed_at = F.col("ts") + F.make_dt_interval(hours=F.col("event_id") % 7 * 6)
    source, output, checkpoint = (new_path(spark, n) for n in ("landed", "flags", "checkpoint"))
    borders = ["2000-01-01", "2024-01-11", "2024-01-21", "2100-01-01"]
    last = spark.range(1).select(
        F.lit("none").alias("event_type"), F.lit("2200-01-01").cast("timestamp").alias("ts"),
        F.lit(0.0).alias("value"), F.lit(-1).cast("long").alias("event_id"),
    )
    parts = [rows.filter((landed_at >= start) & (landed_at < end)) for start, end in zip(borders, borders[1:])]
    for part in [*parts, last]:
        part.write.mode("append").parquet(source)
        stream = IN.file_stream(spark, source, rows.schema)
        flags = ST.rolling_rate_flags(stream, "event_type", "ts", "value", "event_id", "2 days")
        IG.run_available(ST.append_sink(flags, output), checkpoint)
    return spark.read.parquet(output).select("event_id", "is_anomaly")


@query(
    "stream_rate_tables",
    ORACLES["stream_rate_anomaly"],
)
def stream_rate_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The same flags by the sink that keeps its tails in a table per batch; rows land in time order."""
    rows = table(spark, folder, "events").select("event_type", "ts", "value", "event_id")
    source, output = new_path(spark, "landed"), new_path(spark, "flags")
    state, checkpoint = new_path(spark, "tails"), new_path(spark, "checkpoint")
    borders = ["2000-01-01 00:00:00", "2024-01-11 00:00:00", "2024-01-21 00:00:00", "2100-01-01 00:00:00"]
    for start, end in zip(borders, borders[1:]):
        inside = F.expr(f"ts >= timestamp_ntz '{start}' and ts < timestamp_ntz '{end}'")
        rows.filter(inside).write.mode("append").parquet(source)
        stream = IN.file_stream(spark, source, rows.schema)
        sink = ST.rate_anomaly_sink(stream, "event_type", "ts", "value", "event_id", output, state)
        IG.run_available(sink, checkpoint)
    return spark.read.parquet(output).select("event_id", "is_anomaly")


@query(
    "stream_feedback",
    """with p as (select doc_id, n_chars > 1000 as predicted, timestamp '2024-01-01' + to_seconds(doc_id * 60) as predicted_at
        from documents),
      l as (select doc_id, cast(toxic as bigint) as label,
        timestamp '2024-01-01' + to_seconds(doc_id * 60 + (doc_id % 5) * 3600) as labelled_at from labels)
    select p.doc_id, p.predicted, l.label, case when l.doc_id is null then 'pending'
      when p.predicted = (l.label = 1) then 'right' else 'wrong' end as outcome
    from p left join l on p.doc_id = l.doc_id and labelled_at between predicted_at and predicted_at + interval 3 hours""",
)
def stream_feedback(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions and labels as two streams; labels come up to four hours after, three are waited for."""
    base = F.lit("2024-01-01").cast("timestamp")
    minutes = F.make_dt_interval(mins=F.col("doc_id"))
    predictions = table(spark, folder, "documents").select(
        "doc_id", (F.col("n_chars") > 1000).alias("predicted"), (base + minutes).alias("predicted_at")
    )
    delay = F.make_dt_interval(hours=F.col("doc_id") % 5)
    labels = table(spark, folder, "labels").select(
        "doc_id", long("toxic").alias("label"), (base + minutes + delay).alias("labelled_at")
    )
    sources = [new_path(spark, n) for n in ("predictions", "labels")]
    output, checkpoint = new_path(spark, "feedback"), new_path(spark, "checkpoint")
    end = F.lit("2200-01-01").cast("timestamp")
    last = [
        # With an id, as rows without one are filtered before they move the watermark.
        spark.range(1).select(
            *[(end if n.endswith("_at") else F.lit(own if n == "doc_id" else None).cast(k)).alias(n) for n, k in df.dtypes]
        )
        for df, own in ((predictions, -1), (labels, -2))
    ]
    for land in ((predictions, labels), last):
        for rows, source in zip(land, sources):
            rows.write.mode("append").parquet(source)
        streams = [IN.file_stream(spark, s, df.schema) for s, df in zip(sources, (predictions, labels))]
        joined = ST.prediction_feedback(*streams, ["doc_id"], "predicted_at", "labelled_at", "3 hours", "1 hour")
        IG.run_available(ST.append_sink(joined, output), checkpoint)
    rows = spark.read.parquet(output)
    outcome = F.when(F.col("labelled_at").isNull(), "pending").when(
        F.col("predicted") == (F.col("label") == 1), "right"
    )
    return rows.select("doc_id", "predicted", "label", outcome.otherwise("wrong").alias("outcome"))


@query("stream_dedup", "select event_id, event_type, value from events")
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice and is kept once."""
    rows = table(spark, folder, "events").select(
        "event_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts")
    )
    output = new_path(spark, "once")
    once = IG.drop_repeats(landed(spark, rows.unionByName(rows)), "event_id", "ts")
    IG.run_available(ST.append_sink(once, output), new_path(spark, "checkpoint"))
    return spark.read.schema(rows.schema).parquet(output).select("event_id", "event_type", "value")


@query(
    "stream_topic_stats",
    """select event_type as topic, count(*) as messages, arg_max(props, event_id) as last_message
    from events group by 1""",
)
def stream_topic_stats(spark: SparkSession, folder: str) -> DataFrame:
    output = new_path(spark, "topics")
    stream = events_stream(spark, folder).withColumnRenamed("event_type", "topic")
    counts = ST.topic_counts(stream, "topic", "props", "event_id")
    IG.run_available(ST.table_sink(counts, output), new_path(spark, "checkpoint"))
    versions = spark.read.parquet(output)
    newest = versions.agg(F.max("version").alias("v")).scalar()
    return versions.filter(F.col("version") == newest).drop("version")


@query(
    "stream_hourly_volume",
    """with h as (select date_trunc('hour', ts) as s, event_type as currency,
        cast(sum(cast(value as decimal(15,2))) as double) as volume, count(*) as transactions from events group by 1, 2)
    select cast(s as timestamp) as window_start, cast(s + interval 1 hour as timestamp) as window_end, currency, volume,
      transactions from h where s + interval 1 hour <= (select max(ts) - interval 1 hour from events)""",
)
def stream_hourly_volume(spark: SparkSession, folder: str) -> DataFrame:
    output = new_path(spark, "hourly")
    stream = events_stream(spark, folder).select(
        "ts", F.col("event_type").alias("currency"), F.col("value").cast("decimal(15,2)").alias("amount")
    )
    totals = ST.hourly_volume(stream, "ts", "currency", "amount")
    IG.run_available(ST.append_sink(totals, output), new_path(spark, "checkpoint"))
    return spark.read.schema(totals.schema).parquet(output).select(
        ntz("window_start").alias("window_start"),
        ntz("window_end").alias("window_end"),
        "currency",
        money("volume").alias("volume"),
        "transactions",
    )


@query(
    "stream_score",
    f"""with recursive {TX_SQL}, {_USERS_SQL},
      n(tree, node, feature, threshold, l, r, size, depth) as (values {_NODES_SQL}),
      w as (select event_id, value, cast(hour(ts) as double) as hour, t.tree, 0 as node from events,
          (values (0), (1)) t(tree)
        union all select event_id, value, hour, w.tree,
          case when (case when feature = 0 then value else hour end) <= threshold then l else r end
        from w join n on n.tree = w.tree and n.node = w.node where feature >= 0),
      p as (select event_id, avg(depth + {_PATH_SQL}) as path from w join n on n.tree = w.tree and n.node = w.node
        where feature < 0 group by event_id),
      s as (select event_id, least(power(2, -path / (2 * (ln(7.0) + 0.5772156649015329) - 2 * 7.0 / 8)) / 0.5, 1) as score
        from p)
    select cast(event_id as varchar) as key, round(score, 6) as anomaly_score, score >= 0.4 as is_anomaly,
      case when score >= 0.7 then 'high' when score >= 0.4 then 'medium' else 'low' end as risk_level,
      round((value - coalesce(cast(v as double) / n, value)) / greatest(coalesce(cast(v as double) / n, value) * 0.3, 1), 6)
        as z_score_amount
    from s join tx using (event_id) left join u30 using (user_id)""",
)
def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """Each event joined with its user's features and scored by the hand-written forest."""
    nodes = spark.createDataFrame(FIXED_NODES, FO.NODE_DDL)
    forest = FO.Forest.collect(nodes, ["amount_brl", "hour_of_day"], 8, 2)
    users = user_features(spark, folder).select(
        "user_id",
        "avg_ticket_30d",
        F.col("avg_ticket_30d").alias("avg_amount_last_24h"),
        F.lit(0).alias("transactions_last_1h"),
    )
    stream = events_stream(spark, folder).select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        code().alias("currency"),
        F.col("value").alias("amount_brl"),
        F.lit(0.01).alias("spread_pct"),
        F.col("ts").alias("timestamp"),
    )
    output = new_path(spark, "predictions")
    records = ST.score_stream(stream, users, forest)
    IG.run_available(ST.append_sink(records, output), new_path(spark, "checkpoint"))
    fields = (
        "anomaly_score double, is_anomaly boolean, risk_level string, features struct<z_score_amount: double>"
    )
    read = spark.read.schema(records.schema).parquet(output)
    parsed = read.select("key", F.from_json("value", fields).alias("v"))
    return parsed.select(
        "key", "v.anomaly_score", "v.is_anomaly", "v.risk_level", r6("v.features.z_score_amount").alias("z_score_amount")
    )
