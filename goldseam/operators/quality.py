"""Data-quality suites: row rules share one aggregate, the report is a DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldseam.functions import columns as X
from goldseam.operators.ordered import select_quantiles
from goldseam.schemas import VALID_CURRENCIES


@dataclass(frozen=True)
class RowRule:
    """Counts bad rows; passes when there are none."""

    name: str
    bad: Column = field(compare=False)


@dataclass(frozen=True)
class UniqueRule:
    name: str
    column: str


@dataclass(frozen=True)
class ReferenceRule:
    name: str
    column: str
    reference: DataFrame = field(compare=False)
    key: str = ""


@dataclass(frozen=True)
class CountRule:
    name: str
    at_least: int


@dataclass(frozen=True)
class CustomRule:
    """Any function from the table to one row with ``bad`` and ``total``."""

    name: str
    check: Callable[[DataFrame], DataFrame] = field(compare=False)


Rule = RowRule | UniqueRule | ReferenceRule | CountRule | CustomRule


def not_null(column: str) -> RowRule:
    return RowRule(f"NOT_NULL({column})", F.col(column).isNull())


def in_range(column: str, low: float, high: float) -> RowRule:
    """Both ends are allowed, and nulls pass."""
    outside = (F.col(column) < low) | (F.col(column) > high)
    return RowRule(f"RANGE({column}, [{low}, {high}])", outside)


def allowed_values(column: str, allowed: Sequence[str]) -> RowRule:
    """Nulls pass."""
    return RowRule(f"ALLOWED_VALUES({column})", ~F.col(column).isin(*allowed))


def unique(column: str) -> UniqueRule:
    """Null counts as one value."""
    return UniqueRule(f"UNIQUE({column})", column)


def references(column: str, reference: DataFrame, key: str) -> ReferenceRule:
    name = f"REFERENTIAL_INTEGRITY({column} -> {key})"
    return ReferenceRule(name, column, reference, key)


def row_count(at_least: int, table: str = "df") -> CountRule:
    return CountRule(f"ROW_COUNT({table})", at_least)


def bronze_suite(table: str = "bronze.transactions") -> list[Rule]:
    return [
        not_null("transaction_id"),
        not_null("user_id"),
        not_null("timestamp"),
        in_range("amount_brl", 0.01, 10_000_000),
        row_count(1, table),
    ]


def silver_suite(table: str = "silver.transactions") -> list[Rule]:
    return [
        not_null("transaction_id"),
        not_null("amount_usd"),
        in_range("amount_brl", 0.01, 10_000_000),
        allowed_values("currency", VALID_CURRENCIES),
        row_count(1, table),
    ]


def orphans(df: DataFrame, column: str, reference: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``column`` without a match in the reference key."""
    keys = reference.select(F.col(key).alias(column))
    return df.select(column).distinct().join(keys, column, "left_anti")


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, distinct values (null is one) and their difference.

    Grouping first keeps partial aggregation and needs no set of values in one task.
    """
    groups = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("unique_values"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def run_checks(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: position, check_name, bad, total, bad_pct, passed."""
    frames = []
    simple = [(i, r) for i, r in enumerate(rules) if isinstance(r, (RowRule, CountRule))]
    if simple:
        counted = [(i, r) for i, r in simple if isinstance(r, RowRule)]
        totals = df.agg(
            F.count(F.lit(1)).alias("total"), *[F.count_if(r.bad).alias(f"_b{i}") for i, r in counted]
        )
        entries = []
        for i, rule in simple:
            if isinstance(rule, RowRule):
                bad = F.col(f"_b{i}")
            else:
                bad = F.greatest(F.lit(rule.at_least) - F.col("total"), F.lit(0))
            entries.append(
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(rule.name).alias("check_name"),
                    bad.cast("long").alias("bad"),
                )
            )
        frames.append(totals.select(F.inline(F.array(*entries)), "total"))
    for i, rule in enumerate(rules):
        if isinstance(rule, UniqueRule):
            found = duplicates(df, rule.column).select(
                F.col("duplicates").alias("bad"), F.col("total_rows").alias("total")
            )
        elif isinstance(rule, ReferenceRule):
            lost = orphans(df, rule.column, rule.reference, rule.key)
            found = lost.agg(F.count(F.lit(1)).alias("bad")).withColumn(
                "total", F.lit(None).cast("long")
            )
        elif isinstance(rule, CustomRule):
            found = rule.check(df)
        else:
            continue
        frames.append(
            found.select(
                F.lit(i).alias("position"), F.lit(rule.name).alias("check_name"), "bad", "total"
            )
        )
    rows = reduce(DataFrame.unionByName, frames)
    percent = F.round(F.coalesce(X.ratio("bad", "total") * 100, F.lit(0.0)), 2)
    return rows.withColumn("bad_pct", percent).withColumn("passed", F.col("bad") == 0)


def report(checks: DataFrame, table: str) -> DataFrame:
    """One row over the checks: totals, overall verdict and the failed names in order."""
    failed = F.collect_list(
        F.when(~F.col("passed"), F.struct("position", "check_name", "bad"))
    )
    names = F.transform(
        F.array_sort(failed),
        lambda f: F.concat(f["check_name"], F.lit("="), f["bad"].cast("string")),
    )
    return checks.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.when(F.every("passed"), "PASS").otherwise("FAIL").alias("overall"),
        F.concat_ws("; ", names).alias("failures"),
    ).select(F.lit(table).alias("table_name"), "*")


def run_all(df: DataFrame, rules: Sequence[Rule], table: str = "") -> DataFrame:
    return report(run_checks(df, rules), table)


def raise_if_failed(result: DataFrame) -> dict:
    """The one-row report as a dict; raises when a check failed."""
    row = result.first().asDict()
    if row["overall"] != "PASS":
        raise ValueError(f"{row['table_name']} is not accepted: {row['failures']}")
    return row


def profile_nulls(df: DataFrame) -> DataFrame:
    """Null count and percentage of every column, in one pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n_{i}") for i, c in enumerate(df.columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n_{i}").alias("null_count"))
        for i, c in enumerate(df.columns)
    ]
    rows = counts.select(F.inline(F.array(*entries)), "total_rows")
    percent = F.round(F.coalesce(X.ratio("null_count", "total_rows") * 100, F.lit(0.0)), 2)
    return rows.withColumn("null_pct", percent)


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form: one (name, value) row per listed column."""
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    return df.select(*keep, *doubles).unpivot(list(keep), list(columns), "name", "value")


def profile_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Minimum, quartiles, maximum, mean and deviation of each column, quartiles exact.

    All columns share two passes: one for the plain figures and the bounds of the quartiles, one for
    the quartiles.
    """
    names = [f"_v{i}" for i in range(len(columns))]
    rows = df.select(*[F.col(c).cast("double").alias(n) for c, n in zip(columns, names)])
    figures = {"non_null": F.count, "min": F.min, "max": F.max, "mean": F.avg, "stddev": F.stddev}
    extra = [fn(n).alias(f"{figure}{n}") for n in names for figure, fn in figures.items()]
    found = select_quantiles(rows, [], names, [0.25, 0.5, 0.75], extra)
    entries = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"non_null{n}").alias("non_null"),
            F.col(f"min{n}").alias("min"),
            *[F.col(f"q_{i}")[k].alias(q) for k, q in enumerate(("p25", "p50", "p75"))],
            *[F.col(f"{figure}{n}").alias(figure) for figure in ("max", "mean", "stddev")],
        )
        for i, (name, n) in enumerate(zip(columns, names))
    ]
    return found.select(F.inline(F.array(*entries)))


def daily_counts(df: DataFrame, day: str | Column, since: str | Column) -> DataFrame:
    """Rows per day from a first day on, in order."""
    value = F.col(day) if isinstance(day, str) else day
    return df.filter(value >= since).groupBy(value.alias("date")).count().orderBy("date")


def freshness(df: DataFrame, day: str | Column, now: Column, warn_hours: float = 48.0) -> DataFrame:
    """Latest day, its age in hours, and whether that is too old."""
    value = F.col(day) if isinstance(day, str) else day
    latest = df.agg(F.max(value).alias("latest_partition"))
    start = F.col("latest_partition").cast("timestamp")
    seconds = F.unix_micros(now.cast("timestamp")) - F.unix_micros(start)
    hours = F.round(seconds / F.lit(3_600_000_000.0), 1)
    return latest.withColumn("freshness_hours", hours).withColumn(
        "stale", F.col("freshness_hours") > warn_hours
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage of each value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("pct", X.ratio("n", total) * 100)
