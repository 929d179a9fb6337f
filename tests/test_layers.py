"""Bronze, silver and gold cases, sources and sinks."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from goldseam import schemas as S
from goldseam.functions import columns as X
from goldseam.operators import gold as G
from goldseam.operators import refine as R
from goldseam.plans import daily
from goldseam.session import new_path
from goldseam.sources import inputs as IN
from goldseam.sources import outputs as OUT

DDL = "transaction_id string, user_id string, timestamp timestamp, currency string, amount_brl decimal(15,2)"


def test_dedup_keeps_the_newest(spark):
    rows = [
        ("tx-1", datetime(2024, 1, 15, 10), 1),
        ("tx-1", datetime(2024, 1, 15, 11), 2),
        ("tx-2", datetime(2024, 1, 15, 9), 3),
    ]
    df = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp, n int")
    got = {r["transaction_id"]: r["n"] for r in R.latest_per_key(df, ["transaction_id"], ["timestamp"]).collect()}
    assert got == {"tx-1": 2, "tx-2": 3}


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = R.latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    first, last = plan.index("WindowGroupLimit"), plan.rindex("WindowGroupLimit")
    assert first < plan.index("Exchange") < last


def test_clean_and_enrich(spark):
    when = datetime(2024, 1, 15, 10, 30)
    rows = [
        ("t1", "u1", when, "usd", 100.05),
        ("t2", "u1", when, "INVALID", 100.0),
        ("t3", "u1", when, "USD", -100.0),
        (None, "u1", when, "USD", 1.0),
        ("t4", None, when, "USD", 1.0),
        ("t5", "u1", None, "USD", 1.0),
        ("t6", "u1", datetime(2024, 1, 14, 10), "EUR", 3.0),
    ]
    df = spark.createDataFrame(rows, DDL.replace("decimal(15,2)", "double"))
    df = df.withColumn("amount_brl", F.col("amount_brl").cast("decimal(15,2)"))
    got = {r["transaction_id"]: r for r in R.enrich(R.clean(df)).collect()}
    assert set(got) == {"t1", "t6"}
    row = got["t1"]
    assert (row["currency"], float(row["amount_usd"])) == ("USD", 20.01)
    assert (row["day_of_week"], row["hour_of_day"], row["is_business_hours"]) == (2, 10, True)
    assert (row["date"], row["year_month"]) == (date(2024, 1, 15), 202401)
    assert not got["t6"]["is_business_hours"]


def test_audit_columns(spark):
    df = spark.createDataFrame([("s3a://raw/20240115103000-1f2e3d4c.json",)], "f string")
    row = R.add_audit(df, "f").first()
    assert row["_batch_id"] == "20240115103000-1f2e3d4c" and row["_bronze_loaded_at"]
    assert R.add_audit(df, "f", from_tail=True).first()["_batch_id"] == "f2e3d4c."


def test_daily_volume_and_users(spark):
    rows = [
        ("a", "u1", datetime(2024, 1, 15, 10), "USD", 1000),
        ("b", "u1", datetime(2024, 1, 15, 11), "USD", 2000),
        ("c", "u2", datetime(2024, 1, 15, 12), "EUR", 500),
        ("d", "u2", datetime(2024, 1, 17, 12), "USD", 1500),
    ]
    df = spark.createDataFrame(rows, DDL.replace("decimal(15,2)", "int"))
    df = df.withColumn("amount_brl", F.col("amount_brl").cast("decimal(15,2)"))
    got = {(r["currency"], r["date"].day): r for r in G.daily_volume(df).collect()}
    assert got[("USD", 15)]["transaction_count"] == 2
    assert got[("USD", 15)]["volume_change_pct"] is None
    assert got[("USD", 17)]["volume_change_pct"] == -50.0
    assert got[("USD", 17)]["ma7_volume_brl"] == 2250.0
    calendar = {(r["currency"], r["date"].day): r for r in G.daily_volume(df, average_rows=2, calendar_days=True).collect()}
    assert calendar[("USD", 17)]["ma7_volume_brl"] == 1500.0
    assert G.user_summary(df).count() == 2
    assert G.anomaly_summary(df).columns == ["date", "total_transactions", "total_anomalies", "anomaly_rate"]


def test_raw_files_by_day(spark):
    base = new_path(spark, "raw")
    rows = [("1", datetime(2024, 1, 15, 1, 2, 3, 456789)), ("2", datetime(2024, 1, 16))]
    df = spark.createDataFrame(rows, "transaction_id string, timestamp timestamp")
    OUT.write_raw_json(df.withColumn("event_date", F.to_date("timestamp")), base)
    day = IN.read_raw(spark, base, "2024-01-15")
    assert [(r["transaction_id"], r["timestamp"]) for r in day.collect()] == [rows[0]]
    assert IN.read_raw(spark, base, "2024-01-15", "2024-01-16").count() == 2
    assert IN.read_raw(spark, base).count() == 0
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_overwrite_replaces_only_its_partitions(spark):
    path = new_path(spark, "t")
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "v int, p string")
    assert OUT.overwrite_partitions(first, path, ["p"]) == 3
    assert OUT.overwrite_partitions(first.filter("p = 'a'").withColumn("v", F.lit(9)), path, ["p"]) == 2
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(3, "b"), (9, "a"), (9, "a")]
    assert OUT.replace_table(first.filter("v = 1"), path) == 1
    assert spark.read.parquet(path).count() == 1


def test_parse_keeps_bad_texts(spark):
    good = '{"transaction_id":"1","user_id":"u","timestamp":"2024-01-01T00:00:00Z","transaction_type":"BUY","currency":"USD","amount_brl":1,"amount_foreign":1,"exchange_rate":5,"spread_pct":0.1}'
    texts = [good, "not-json", "{broken", "", "null", None, '{"transaction_id":"1"}']
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    ok, bad = IN.split_values(IN.parse_values(df, S.RAW_TRANSACTION))
    assert ok.count() == 1
    assert {r["_raw"] for r in bad.collect()} == set(texts[1:])


@pytest.mark.parametrize("score,level,flag", [(0.7, "high", True), (0.4, "medium", True), (0.39, "low", False)])
def test_risk(spark, score, level, flag):
    row = spark.range(1).select(X.risk_level(F.lit(score)).alias("l"), X.risk_flag(F.lit(score)).alias("f")).first()
    assert (row["l"], row["f"]) == (level, flag)


def test_composite_score(spark):
    rows = [(0.9, 10.0), (None, None), (0.5, 0.0), (1.0, 200.0)]
    df = spark.createDataFrame(rows, "f1 double, p double")
    got = [r["s"] for r in df.select(X.composite_score("f1", "p").alias("s")).collect()]
    assert got == pytest.approx([0.9, 0.1, 0.5, 0.8])


def test_daily_job_is_repeatable(spark):
    raw, lake = new_path(spark, "raw"), new_path(spark, "lake")
    rows = [
        ("1", "u1", datetime(2024, 1, 15, 10), "usd", 100, True),
        ("1", "u1", datetime(2024, 1, 15, 11), "usd", 110, False),
        ("2", "u2", datetime(2024, 1, 15, 12), "EUR", 50, False),
    ]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, timestamp timestamp, currency string, amount_brl int, is_anomaly boolean")
    full = df.withColumns(
        {
            "transaction_type": F.lit("BUY"),
            "amount_foreign": F.lit(1),
            "exchange_rate": F.lit(5),
            "spread_pct": F.lit(0.1),
            "event_date": F.to_date("timestamp"),
        }
    )
    OUT.write_raw_json(full, raw)
    for _ in range(2):
        counts = daily.run(spark, raw, lake, "2024-01-15")
        assert counts["bronze"] == 2 and counts["silver"] == 2
        assert counts["gold"]["daily_volume"] == 2 and counts["gold"]["anomaly_summary"] == 1
    silver = spark.read.parquet(f"{lake}/silver/transactions")
    assert {(r["transaction_id"], float(r["amount_brl"])) for r in silver.collect()} == {("1", 110.0), ("2", 50.0)}


def test_gold_by_day_equals_gold_at_once(spark):
    lake = new_path(spark, "lake")
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("transaction_id"),
        (F.col("id") % 7).cast("string").alias("user_id"),
        F.timestamp_seconds(1_704_067_200 + F.col("id") * 1_300).alias("timestamp"),
        F.when(F.col("id") % 3 == 0, "USD").otherwise("EUR").alias("currency"),
        (F.col("id") * 1.37 + 1).cast("decimal(15,2)").alias("amount_brl"),
        (F.col("id") % 50 + 1).cast("decimal(10,4)").alias("exchange_rate"),
        (F.col("id") % 11 == 0).alias("is_anomaly"),
    )
    silver = rows.withColumn("date", F.to_date("timestamp"))
    OUT.overwrite_partitions(silver, f"{lake}/silver/transactions", ["date"])
    days = sorted(str(r["date"]) for r in silver.select("date").distinct().collect())
    assert len(days) == 7
    for day in [*days, days[2]]:
        daily.load_gold(spark, lake, day)
    whole = {
        "daily_volume": G.daily_volume(silver),
        "user_summary": G.user_summary(silver),
        "hourly_rates": G.hourly_rates(silver),
        "anomaly_summary": G.anomaly_summary(silver),
    }
    for name, want in whole.items():
        got = spark.read.parquet(f"{lake}/gold/{name}").select(*want.columns)
        assert got.count() == want.count() > 0
        assert got.exceptAll(want).count() == 0, name


def test_late_rows_join_the_day_they_happened_on(spark):
    lake = new_path(spark, "lake")

    def load(day, times):
        rows = [(f"{day}-{i}", "u1", t, "USD", 10, 5, False) for i, t in enumerate(times)]
        schema = "transaction_id string, user_id string, timestamp timestamp, currency string, amount_brl int, exchange_rate int, is_anomaly boolean"
        silver = spark.createDataFrame(rows, schema).withColumn("date", F.lit(day).cast("date"))
        OUT.overwrite_partitions(silver, f"{lake}/silver/transactions", ["date"])

    def totals():
        volume = {str(r["date"]): r["transaction_count"] for r in spark.read.parquet(f"{lake}/gold/daily_volume").collect()}
        return volume, spark.read.parquet(f"{lake}/gold/user_summary").first()["total_transactions"]

    assert daily.event_days(spark, lake, "2024-01-01") == set()
    load("2024-01-01", [datetime(2024, 1, 1, 10 + i) for i in range(5)])
    daily.load_gold(spark, lake, "2024-01-01")
    assert totals() == ({"2024-01-01": 5}, 5)
    load("2024-01-02", [datetime(2024, 1, 1, 23, 59, 30), *[datetime(2024, 1, 2, i) for i in range(3)]])
    for _ in range(2):
        daily.load_gold(spark, lake, "2024-01-02")
        assert totals() == ({"2024-01-01": 6, "2024-01-02": 3}, 9)
    # The load of Jan 2 again, now without the late row.
    replaced = daily.event_days(spark, lake, "2024-01-02")
    load("2024-01-02", [datetime(2024, 1, 2, i) for i in range(3)])
    daily.load_gold(spark, lake, "2024-01-02", also=replaced)
    assert totals() == ({"2024-01-01": 5, "2024-01-02": 3}, 8)


def _user_rows(spark, rows):
    schema = "transaction_id string, user_id string, timestamp timestamp, amount_brl decimal(15,2)"
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], schema)


def test_user_totals_by_signed_changes(spark):
    lake, rng = new_path(spark, "lake"), random.Random(4)
    held = {}
    users = ["u1", "u1", "u1", "u2", "u3", "u4", None]
    for step in range(5):
        days = rng.sample(range(1, 7), 2) if step < 4 else [1, 2, 3]
        for d in days:
            # In the last step three days lose all their rows.
            held[d] = [
                (rng.choice(users), datetime(2024, 1, d, rng.randint(0, 23)), None if rng.random() < 0.3 else Decimal(rng.randint(1, 999)) / 100)
                for _ in range(rng.randint(1, 6) if step < 4 else 0)
            ]
        rows = _user_rows(spark, [r for d in days for r in held[d]])
        for _ in range(2 if step == 2 else 1):
            daily.refresh_users(spark, lake, rows, [datetime(2024, 1, d).date() for d in days])
        got = daily.user_summary(spark, lake)
        want = G.user_summary(_user_rows(spark, [r for rows in held.values() for r in rows]))
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect())), step


def test_broken_refresh_of_users_is_finished_once(spark, monkeypatch):
    lake, day = new_path(spark, "lake"), [datetime(2024, 1, 1).date()]
    daily.refresh_users(spark, lake, _user_rows(spark, [("u1", datetime(2024, 1, 1, 5), Decimal(3)), ("u2", datetime(2024, 1, 1), None)]), day)
    rows = _user_rows(spark, [("u1", datetime(2024, 1, 1, 6), Decimal(4))])
    put, calls = OUT.replace_partitions, []

    def breaks_at_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return put(*args)

    monkeypatch.setattr(OUT, "replace_partitions", breaks_at_second)
    with pytest.raises(RuntimeError):
        daily.refresh_users(spark, lake, rows, day)
    monkeypatch.undo()
    for _ in range(2):
        daily.refresh_users(spark, lake, rows, day)
        got = [tuple(r) for r in daily.user_summary(spark, lake).collect()]
        assert got == [("u1", 1, Decimal("4.00"), 4.0, datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 6))]


def test_untouched_parts_and_days_stay(spark):
    lake = new_path(spark, "lake")
    rows = [(f"u{i}", datetime(2024, 1, d, 1 + d), Decimal(i)) for i in range(200) for d in (1, 2)]
    days = [datetime(2024, 1, d).date() for d in (1, 2)]
    daily.refresh_users(spark, lake, _user_rows(spark, rows), days)

    def files():
        listed = IN.list_files(spark, f"{lake}/gold").collect()
        return {r["full_path"] for r in listed if "/user_totals/bucket=" in r["full_path"] or "/user_days/date=" in r["full_path"]}

    before = files()
    daily.refresh_users(spark, lake, _user_rows(spark, [("u7", datetime(2024, 1, 3), Decimal(1))]), [datetime(2024, 1, 3).date()])
    gone = before - files()
    assert len(gone) == 1 and "user_totals/bucket=" in gone.pop()


def test_day_without_rows_goes(spark):
    lake = new_path(spark, "lake")
    schema = "transaction_id string, user_id string, timestamp timestamp, currency string, amount_brl int, exchange_rate int, is_anomaly boolean"

    def load(rows):
        silver = spark.createDataFrame(rows, schema).withColumn("date", F.lit("2024-01-05").cast("date"))
        OUT.overwrite_partitions(silver, f"{lake}/silver/transactions", ["date"])

    load([("1", "u1", datetime(2024, 1, 4, 9), "USD", 10, 5, True), ("2", "u2", datetime(2024, 1, 5, 9), "USD", 10, 5, False)])
    daily.load_gold(spark, lake, "2024-01-05")
    replaced = daily.event_days(spark, lake, "2024-01-05")
    load([("2", "u2", datetime(2024, 1, 5, 9), "USD", 10, 5, False)])
    daily.load_gold(spark, lake, "2024-01-05", also=replaced)
    for name in ("daily_volume", "hourly_rates", "anomaly_summary", "user_summary"):
        assert spark.read.parquet(f"{lake}/gold/{name}").count() == 1, name


def test_gates_stop_the_daily_job(spark):
    raw, lake = new_path(spark, "raw"), new_path(spark, "lake")
    rows = [("1", "u1", datetime(2024, 1, 15, 10), "USD", -100)]
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, timestamp timestamp, currency string, amount_brl int")
    full = df.withColumns(
        {
            "transaction_type": F.lit("BUY"),
            "amount_foreign": F.lit(1),
            "exchange_rate": F.lit(5),
            "spread_pct": F.lit(0.1),
            "event_date": F.to_date("timestamp"),
        }
    )
    OUT.write_raw_json(full, raw)
    with pytest.raises(ValueError, match="too many bad rows|is not accepted"):
        daily.run(spark, raw, lake, "2024-01-15")


def test_layer_tables(spark):
    names = OUT.create_layer(spark, "gold", new_path(spark, "gold"))
    assert names == ["gold.daily_volume", "gold.user_summary", "gold.hourly_rates", "gold.anomaly_summary"]
    assert spark.table("gold.daily_volume").count() == 0


def test_shared_folder_without_a_setting(spark, monkeypatch):
    """A local session without ``spark.checkpoint.dir`` gets one folder for its whole life."""
    from goldseam import session

    class Conf:
        def get(self, name, default=None):
            return default

    class Unset:
        conf, sparkContext = Conf(), spark.sparkContext

    first = session.shared_folder(Unset())
    assert first and session.shared_folder(Unset()) == first


def test_base_queries_without_the_llm_packages(tmp_path):
    """A missing package of the training-data operators leaves the other queries."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; import warnings; warnings.simplefilter('ignore');"
        "import __spark_entry__ as e; n = e.queries();"
        "assert 'gold_daily_volume' in n and not any(x.startswith('op1_') for x in n), sorted(n)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, env={**os.environ, "PYTHONPATH": root})
