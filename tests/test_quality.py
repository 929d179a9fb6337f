"""Literal cases of the checks, the report and the gates."""

import pytest
from pyspark.sql import functions as F

from goldseam.operators import quality as Q
from goldseam.operators import refine as R


def result(df, *rules):
    return {r["check_name"]: r for r in Q.run_checks(df, list(rules)).collect()}


def test_not_null(spark):
    good = spark.createDataFrame([("a",), ("b",)], "id string")
    bad = spark.createDataFrame([("a",), (None,)], "id string")
    assert result(good, Q.not_null("id"))["NOT_NULL(id)"]["passed"]
    row = result(bad, Q.not_null("id"))["NOT_NULL(id)"]
    assert (row["passed"], row["bad"], row["total"], row["bad_pct"]) == (False, 1, 2, 50.0)


def test_unique_counts_null_as_a_value(spark):
    assert result(spark.createDataFrame([("a",), ("a",)], "id string"), Q.unique("id"))["UNIQUE(id)"]["bad"] == 1
    nulls = spark.createDataFrame([("a",), (None,), (None,)], "id string")
    assert result(nulls, Q.unique("id"))["UNIQUE(id)"]["bad"] == 1


def test_range_and_allowed_values_let_nulls_pass(spark):
    df = spark.createDataFrame([(5, "USD"), (-1, "BAD"), (None, None), (100, "EUR")], "v int, c string")
    rows = result(df, Q.in_range("v", 0, 100), Q.allowed_values("c", ["USD", "EUR"]))
    assert rows["RANGE(v, [0, 100])"]["bad"] == 1
    assert rows["ALLOWED_VALUES(c)"]["bad"] == 1


def test_references_and_row_count(spark):
    df = spark.createDataFrame([("u1",), ("ghost",), ("ghost",)], "user_id string")
    users = spark.createDataFrame([("u1",), ("u2",)], "id string")
    rows = result(df, Q.references("user_id", users, "id"), Q.row_count(5, "t"), Q.row_count(3, "s"))
    assert rows["REFERENTIAL_INTEGRITY(user_id -> id)"]["bad"] == 1
    assert not rows["ROW_COUNT(t)"]["passed"]
    assert rows["ROW_COUNT(s)"]["passed"]


def test_custom_rule(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    rule = Q.CustomRule("EVEN", lambda d: d.agg(F.count_if(F.col("v") % 2 == 1).alias("bad"), F.count("*").alias("total")))
    assert result(df, rule)["EVEN"]["bad"] == 1


def test_row_rules_share_one_aggregate(spark):
    df = spark.range(10).withColumn("v", F.col("id"))
    rules = [Q.not_null("id"), Q.in_range("v", 0, 5), Q.allowed_values("v", [1]), Q.row_count(1)]
    plan = Q.run_checks(df, rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_report_and_gate(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "id string, v int")
    report = Q.run_all(df, [Q.not_null("id"), Q.in_range("v", 0, 5)], "t")
    row = report.first()
    assert (row["total_checks"], row["passed"], row["failed"], row["overall"]) == (2, 1, 1, "FAIL")
    assert row["failures"] == "NOT_NULL(id)=1"
    with pytest.raises(ValueError, match="t is not accepted"):
        Q.raise_if_failed(report)
    assert Q.raise_if_failed(Q.run_all(df, [Q.in_range("v", 0, 5)], "t"))["overall"] == "PASS"


def test_empty_table(spark):
    df = spark.createDataFrame([], "id string")
    rows = result(df, Q.not_null("id"), Q.unique("id"), Q.row_count(1, "t"))
    assert rows["NOT_NULL(id)"]["passed"] and rows["UNIQUE(id)"]["passed"]
    assert not rows["ROW_COUNT(t)"]["passed"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None), (4, None)], "v int, s string")
    rows = {r["column_name"]: r for r in Q.profile_nulls(df).collect()}
    assert (rows["v"]["null_count"], rows["s"]["null_pct"]) == (1, 50.0)


def test_silver_gate(spark):
    rows = [("t1", "u1", None, "USD", -5.0)] * 10
    df = spark.createDataFrame(rows, "transaction_id string, user_id string, timestamp timestamp, currency string, amount_brl double")
    with pytest.raises(ValueError, match="too many bad rows"):
        R.validate_silver(df)
    good = df.withColumns({"amount_brl": F.lit(5.0), "timestamp": F.current_timestamp()})
    assert R.validate_silver(good)["negative_amounts"] == 0
