"""Versioned tables and maintenance."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from goldseam.operators import changelog as CL
from goldseam.operators import joins as J
from goldseam.operators import monitoring as MO
from goldseam.operators import versions as V
from goldseam.plans import maintenance as MT
from goldseam.session import new_path
from goldseam.sources import inputs as IN
from goldseam.sources import outputs as OUT

ROWS = [
    (1, "a", 1, datetime(2024, 1, 1), "upsert"),
    (2, "b", 1, datetime(2024, 1, 1), "upsert"),
    (1, "c", 2, datetime(2024, 1, 2), "upsert"),
    (2, "b", 3, datetime(2024, 1, 9), "delete"),
    (3, None, 4, datetime(2024, 1, 10), "upsert"),
]
DDL = "id int, v string, _commit_id long, _committed_at timestamp, _op string"


@pytest.fixture
def log(spark):
    return spark.createDataFrame(ROWS, DDL)


def state(df):
    return sorted((r["id"], r["v"]) for r in df.collect())


def test_states(log):
    assert state(V.state_at_commit(log, ["id"], 1)) == [(1, "a"), (2, "b")]
    assert state(V.state_at_commit(log, ["id"], 2)) == [(1, "c"), (2, "b")]
    assert state(V.current_state(log, ["id"])) == [(1, "c"), (3, None)]
    assert state(V.state_at_time(log, ["id"], F.lit(datetime(2024, 1, 5)))) == [(1, "c"), (2, "b")]


def test_rollback_appends_the_inverse(log):
    undo = V.rollback_changes(log, ["id"], F.col("_commit_id") <= 1)
    assert sorted((r["id"], r["v"], r["_op"]) for r in undo.collect()) == [
        (1, "a", "upsert"),
        (2, "b", "upsert"),
        (3, None, "delete"),
    ]
    after = V.append_commit(log, undo, F.lit(datetime(2024, 2, 1)))
    assert state(V.current_state(after, ["id"])) == [(1, "a"), (2, "b")]
    assert state(V.state_at_commit(after, ["id"], 4)) == [(1, "c"), (3, None)]
    assert V.latest_commit_id(after) == 5


def test_incremental_and_snapshots(spark, log):
    assert V.incremental_read(log, 1, 3).count() == 2
    assert V.incremental_read(log, 1).count() == 3
    rows = V.snapshots(log).collect()
    assert [r["snapshot_id"] for r in rows] == [4, 3, 2, 1]
    assert [r["parent_id"] for r in rows] == [3, 2, 1, None]
    assert rows[1]["operation"] == "overwrite"
    with pytest.raises(ValueError):
        V.latest_commit_id(log.limit(0))


def test_expire_keeps_reads(log):
    plan = {r["snapshot_id"]: r["expired"] for r in V.expire_plan(log, F.lit(datetime(2024, 1, 12)), 7).collect()}
    assert plan == {1: True, 2: True, 3: False, 4: False}
    far = V.expire_plan(log, F.lit(datetime(2030, 1, 1)), 7, keep_last=2)
    assert {r["snapshot_id"] for r in far.filter("expired").collect()} == {1, 2}
    small = V.squash(log, ["id"], 2)
    assert small.count() == 4
    assert state(V.current_state(small, ["id"])) == state(V.current_state(log, ["id"]))
    assert state(V.state_at_commit(small, ["id"], 3)) == [(1, "c")]


def test_compaction_plan(spark):
    mb = 1 << 20
    rows = [("a", mb)] * 5 + [("b", 200 * mb)] + [("c", 20 * mb)] * 10 + [("d", mb)]
    plan = {r["p"]: r for r in V.compaction_plan(spark.createDataFrame(rows, "p string, size long"), "p").collect()}
    assert (plan["a"]["rewrite"], plan["a"]["output_files"]) == (True, 1)
    assert not plan["b"]["rewrite"] and not plan["d"]["rewrite"]
    assert plan["c"]["output_files"] == 2


def test_maintenance_on_files(spark, log):
    path, fresh = new_path(spark, "log"), new_path(spark, "log")
    log.repartition(4).write.partitionBy("_commit_id").parquet(path)
    log.repartition(4).write.mode("append").partitionBy("_commit_id").parquet(path)
    files = [r["full_path"] for r in MT.find_orphans(spark, path, spark.createDataFrame([("x",)], "path string")).collect()]
    references = spark.createDataFrame([(f,) for f in files[1:]], "path string")
    before = state(V.current_state(spark.read.parquet(path), ["id"]))
    args = (spark, path, fresh, ["id"], F.lit(datetime(2024, 1, 12)), references)
    # Files of now are too young for the default age.
    assert MT.run_all(*args, execute=True)["deleted"] == 0 and os.path.exists(files[0].removeprefix("file:").replace("///", "/"))
    result = MT.run_all(*args, execute=True, min_age_hours=0, grace_hours=0)
    assert result["expired_upto"] == 2 and result["orphan_files"] == 1 and result["deleted"] == 1
    assert not os.path.exists(files[0].removeprefix("file:").replace("///", "/"))
    assert state(V.current_state(spark.read.parquet(fresh), ["id"])) == before


def test_removal_in_two_steps(spark):
    path, marks = new_path(spark, "lake"), new_path(spark, "marks")
    spark.range(40).repartition(4).write.parquet(path)
    listed = lambda: IN.list_files(spark, path)
    files = sorted(r["full_path"] for r in listed().collect())
    local = lambda f: f.removeprefix("file:").replace("///", "/")
    refs = lambda *names: spark.createDataFrame([(n,) for n in ("x", *names)], "path string")
    hours = lambda n: F.timestamp_micros(F.unix_micros(F.current_timestamp()) + int(n * 3_600_000_000))
    assert MT.mark_orphans(listed(), refs(), hours(0)).count() == 0
    OUT.replace_table(MT.mark_orphans(listed(), refs(files[0]), hours(73)), marks)
    marked = spark.read.parquet(marks)
    assert sorted(r["full_path"] for r in marked.collect()) == files[1:]
    assert MT.sweep_marks(marked, listed(), refs(files[0]), hours(80)).count() == 0
    # Since the marks were set: one file got a reference, one was written anew, one is new.
    spark.range(1).repartition(1).write.mode("append").parquet(path)
    os.utime(local(files[2]), (1_800_000_000, 1_800_000_000))
    swept = MT.sweep_marks(marked, listed(), refs(files[0], files[1]), hours(98)).cache()
    assert [tuple(r) for r in swept.collect()] == [(files[3], True)]
    assert sorted(map(os.path.exists, map(local, files))) == [False, True, True, True] and listed().count() == 4
    # A repeated attempt counts the same.
    gone = marked.filter(F.col("full_path") == files[3])
    assert [r["deleted"] for r in MT.remove_files(gone).collect()] == [True]
    # Marks keep their first time, but not those of changed files.
    first = {r["full_path"]: r["marked_at"] for r in marked.collect()}
    later = {r["full_path"]: r["marked_at"] for r in MT.mark_orphans(listed(), refs(files[0]), hours(1_000_000), 0, marked).collect()}
    assert later[files[1]] == first[files[1]] and later[files[2]] > first[files[2]]


def test_compact_escaped_and_null_partitions(spark):
    path = new_path(spark, "escaped")
    rows = spark.createDataFrame([(i, p) for i in range(20) for p in ("a b", "x:y%2/z=+", None, "plain")], "id int, p string")
    for _ in range(3):
        rows.repartition(2).write.mode("append").partitionBy("p").parquet(path)
    before = sorted(map(repr, spark.read.parquet(path).select("id", "p").collect()))
    assert MT.compact_table(spark, path, "p").count() == 4
    assert sorted(map(repr, spark.read.parquet(path).select("id", "p").collect())) == before
    assert IN.list_files(spark, path, "*.parquet").count() == 4


def test_compact_deals_equal_rows(spark):
    path = new_path(spark, "equal")
    rows = spark.range(400).select(F.lit(1).alias("p"), F.create_map(F.lit("k"), F.lit(1)).alias("m"))
    V.compact(rows, "p", spark.createDataFrame([(1, 4)], "p int, output_files int")).write.partitionBy("p").parquet(path)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert sorted(r["count"] for r in sizes) == [100] * 4


def test_compact_table(spark):
    path = new_path(spark, "small")
    rows = spark.range(100).withColumn("p", F.col("id") % 2)
    for _ in range(3):
        rows.repartition(3).write.mode("append").partitionBy("p").parquet(path)
    plan = MT.compact_table(spark, path, "p")
    assert plan.count() == 2
    assert spark.read.parquet(path).count() == 300
    listed = [f for f in spark.read.parquet(path).inputFiles()]
    assert len(listed) <= 2
    assert MT.compact_table(spark, path, "p") is None


def test_compact_writes_the_wanted_files(spark):
    path = new_path(spark, "wanted")
    rows = spark.range(3_000).withColumn("p", F.col("id") % 3)
    wanted = spark.createDataFrame([(0, 1), (1, 2), (2, 5)], "p long, output_files int")
    V.compact(rows, "p", wanted).write.partitionBy("p").parquet(path)
    files = spark.read.parquet(path).select("p", F.input_file_name().alias("f")).distinct()
    counts = {r["p"]: r["count"] for r in files.groupBy("p").count().collect()}
    assert counts[0] == 1 and counts[1] == 2 and counts[2] == 5
    assert spark.read.parquet(path).count() == 3_000


def test_orphans_by_path_or_key(spark):
    files = spark.createDataFrame(
        [("s3a://b/1", "1", 5), ("s3a://b/2", "2", 6), ("s3a://b/3", "3", 7), ("s3a://b/v.metadata.json", "v.metadata.json", 1)],
        "full_path string, key string, size long",
    )
    refs = spark.createDataFrame([("s3a://b/1",), ("2",)], "path string")
    assert [r["key"] for r in J.orphan_files(files, refs).collect()] == ["3"]


def test_islands_and_routes(spark):
    hours = [(datetime(2024, 1, 1, h), v) for h, v in enumerate([1, 1, 0, 1, 1, 1, 0, 1])]
    df = spark.createDataFrame(hours, "hour timestamp, v int")
    runs = MO.islands(df, "hour", F.col("v") == 1, 3600)
    assert sorted((r["run_start"].hour, r["buckets"]) for r in runs.collect()) == [(0, 2), (3, 3), (7, 1)]
    assert MO.held_for(runs, 2).count() == 2
    alerts = spark.createDataFrame(
        [("A", "critical", True, 1.0), ("A", "warning", True, 1.0), ("B", "warning", True, 1.0), ("C", "info", False, 0.0)],
        "alert string, severity string, fired boolean, value double",
    )
    got = sorted((r["alert"], r["severity"], r["receiver"]) for r in MO.route_alerts(alerts).collect())
    assert got == [
        ("A", "critical", "pagerduty-critical"),
        ("A", "critical", "slack-data-alerts"),
        ("B", "warning", "email-data-team"),
        ("B", "warning", "slack-data-alerts"),
    ]


def test_alert_states(spark):
    rules = (MO.AlertRule("A", "critical", "m", 10, held_seconds=120), MO.AlertRule("B", "info", "m", 0, "ml", 0))
    at = lambda m: datetime(2024, 1, 1, 0, m)
    values = {
        ("A", "x"): {0: 11, 1: 12, 2: 13, 3: 14, 4: 5, 5: 20, 6: 20},
        # A missing evaluation or value ends a run.
        ("A", "y"): {0: 11, 1: 11, 3: 11, 4: 11, 5: None, 6: 11},
        ("A", None): {0: 99, 1: 99, 2: 99, 3: 99},
        ("A", "z"): {4: 11, 5: 11, 6: 10.5},
        ("B", "x"): {6: 1},
        ("unknown", "x"): {6: 1000},
    }
    rows = [(a, l, at(m), None if v is None else float(v)) for (a, l), vs in values.items() for m, v in vs.items()]
    series = spark.createDataFrame(rows, "alert string, labels string, at timestamp, value double")
    line = {}
    for r in MO.alert_timeline(series, rules).orderBy("at").collect():
        line.setdefault((r["alert"], r["labels"]), []).append(r["state"][0])
    assert {k: "".join(v) for k, v in line.items()} == {
        ("A", "x"): "ppffrpp", ("A", "y"): "ppppip", ("A", None): "ppff", ("A", "z"): "ppf", ("B", "x"): "f", ("unknown", "x"): "i",
    }
    got = {(r["alert"], r["labels"]): r for r in MO.alert_states(series, F.lit(at(6)), rules).collect()}
    assert {k: (r["state"], r["times_fired"]) for k, r in got.items()} == {
        ("A", "x"): ("pending", 1), ("A", "y"): ("pending", 0), ("A", None): ("resolved", 1), ("A", "z"): ("firing", 1),
        ("B", "x"): ("firing", 1), ("unknown", "x"): ("inactive", 0),
    }
    assert got["A", "x"]["active_since"] == at(5) and got["A", "x"]["last_fired"] == at(3)
    assert got["A", None]["active_since"] is None and got["B", "x"]["team"] == "ml" and got["unknown", "x"]["severity"] is None
    assert MO.alert_states(series.limit(0), F.lit(at(6)), rules).count() == 0


def test_stored_log_opens_what_it_needs(spark):
    path = new_path(spark, "log")
    rows = spark.range(600).select(
        (F.col("id") % 60).alias("id"),
        F.col("id").cast("string").alias("v"),
        (F.col("id") / 60).cast("long").alias("_commit_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + 3_600 * (F.col("id") / 60).cast("long")).alias("_committed_at"),
        F.when(F.col("id") % 7 == 0, "delete").otherwise("upsert").alias("_op"),
    )
    for _ in range(2):
        assert CL.store_commits(rows, path, ["id"]) == 600
    same = lambda a, b: sorted(map(tuple, a.select(*rows.columns).collect())) == sorted(map(tuple, b.collect()))
    moment = F.timestamp_seconds(F.lit(1_704_067_200 + 4 * 3_600 + 60))
    three = spark.createDataFrame([(3,), (4,), (3,), (99,)], "id long")
    assert same(CL.read_log(spark, path), rows)
    assert same(CL.read_log(spark, path, moment=moment), rows.filter("_commit_id <= 4"))
    assert same(CL.read_log(spark, path, 2, 8, keys=three), rows.filter("_commit_id > 2 and _commit_id <= 8 and id in (3, 4)"))
    assert state(V.current_state(CL.read_log(spark, path, moment=moment), ["id"])) == state(V.state_at_commit(rows, ["id"], 4))
    # Every file outside commits 3 to 4 and the buckets of the keys is damaged; the reads do not open them.
    held = {r["b"] for r in three.select(CL.key_bucket(["id"]).alias("b")).collect()}
    for r in IN.list_files(spark, f"{path}/rows", "*.parquet").collect():
        parts = dict(p.split("=") for p in r["full_path"].split("/") if "=" in p)
        if int(parts["_commit_id"]) not in (3, 4) or int(parts["_bucket"]) not in held:
            with open(r["full_path"].removeprefix("file:").replace("///", "/"), "wb") as file:
                file.write(b"x")
            crc = os.path.join(os.path.dirname(file.name), f".{os.path.basename(file.name)}.crc")
            if os.path.exists(crc):
                os.remove(crc)
    spark.catalog.clearCache()
    schema = rows.withColumn("_bucket", F.lit(0)).schema
    found = CL.read_log(spark, path, 2, moment=moment, keys=three, schema=schema)
    assert same(found, rows.filter("_commit_id in (3, 4) and id in (3, 4)"))
    with pytest.raises(Exception, match="(?i)parquet"):
        CL.read_log(spark, path, 2, moment=moment, schema=schema).collect()
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "dynamicpruning" in plan


def test_broken_commit_is_not_seen(spark):
    path = new_path(spark, "log")
    rows = spark.createDataFrame(ROWS, "id long, v string, _commit_id long, _committed_at timestamp, _op string")
    CL.store_commits(rows.filter("_commit_id < 3"), path, ["id"])
    late = rows.filter("_commit_id = 3").withColumn("_bucket", CL.key_bucket(["id"]))
    OUT.overwrite_partitions(late, f"{path}/rows", ["_commit_id", "_bucket"])
    assert CL.read_log(spark, path).count() == 3
    CL.store_commits(rows.filter("_commit_id = 3"), path, ["id"])
    assert CL.read_log(spark, path).count() == 4
