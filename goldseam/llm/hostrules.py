"""Quality rules with verdicts on hosts, in DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import written
from goldseam.llm.registry import query
from goldseam.workloads.registry import table

BLANK = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Rules whose failures are counted by host, as SQL over the counts; the first is the base rule.
RULES = {
    "base": "n_words < 50 OR 100 * n_repeat_words > 50 * n_words",
    "symbols": "n_symbols > n_words",
    "lines": "10 * n_dup_lines > n_words",
}
#: A host is rejected when its shrunk rate of failures of a rule is above this.
WORST_RATE = 0.5


def counts(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` as a struct ``_row``, and the counts of each text.

    Words inside repeated 3-word windows: the windows are sorted by content, equal neighbours are
    repeated, and the stretches that they cover are added up in order of position. Each step is
    a column of its own, so that no array is computed twice.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(c) for c in keep]).alias("_row"), text.alias("_text"))
    words = F.filter(F.split("_text", r"[ \t-\r]+"), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n"), lambda x: F.translate(x, BLANK, "") != "")
    rows = rows.select("*", words.alias("_words"), lines.alias("_lines"))

    def window(word: Column, i: Column) -> Column:
        after = [F.get("_words", i + k) for k in (1, 2)]
        return F.struct(F.concat(word, F.lit(" "), after[0], F.lit(" "), after[1]).alias("w"), i.alias("i"))

    windows = F.filter(F.transform("_words", window), lambda x: x["w"].isNotNull())
    rows = rows.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate("_text", BLANK, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.array_sort(windows).alias("_windows"),
    )
    same = lambda x, j: x["w"] == F.get("_windows", j)["w"]
    repeated = F.filter("_windows", lambda x, j: same(x, j - 1) | same(x, j + 1))
    rows = rows.withColumn("_at", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    covered = F.transform(
        "_at", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_at", j + 1) - p, F.lit(3)))
    )
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", total).drop("_windows", "_at")


@dataclass(frozen=True)
class Prior:
    """Failures and passes that every host is credited with."""

    failures: float
    passes: float


def fit_prior(rows: float, failed: float, spread: float) -> Prior:
    """A beta prior by moments: the mean rate, and the variance of the hosts' rates.

    ``spread`` is the sum over hosts of rows times the squared distance from the mean rate. The
    weight (failures plus passes) is held between 1 and 1,000,000.
    """
    rate = failed / rows if rows else 0.0
    variance = spread / rows if rows else 0.0
    most = 1_000_000.0
    weight = rate * (1 - rate) / variance - 1 if variance > 0 else most
    weight = min(max(weight, 1.0), most)
    return Prior(rate * weight, (1 - rate) * weight)


def host_rules(
    docs: DataFrame, keep: list[str], text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """``_row`` (a struct of ``keep``), the counts, ``base_failed``, ``host_rejected`` and ``kept``.

    Failures of each rule are added up by host (partial sums before the shuffle, so a host with a
    third of all rows costs no more). A host's rate is shrunk towards the mean by a beta prior
    that is fitted to all hosts; a host above ``WORST_RATE`` in any rule is rejected with all its
    documents. Three sums per rule reach the driver, no rows.

    Null text counts as empty (it fails the base rule); a row without a host is judged by itself
    only; repeated rows each count; an empty table gives no rows.
    """
    host = F.col(host_col).cast("string")
    rows = counts(docs.withColumn("_host", host), text_col, [*keep, "_host"])
    failed = [F.expr(rule).alias(f"_fails_{name}") for name, rule in RULES.items()]
    rows = rows.select(
        F.struct(*[F.col(f"_row.{c}") for c in keep]).alias("_row"), F.col("_row._host").alias("_host"), *COUNTS, *failed
    )
    rows = written(rows, "rules")
    sums = [F.sum(F.col(f"_fails_{name}").cast("long")).alias(name) for name in RULES]
    hosts = rows.where("_host is not null").groupBy("_host").agg(F.count("*").alias("_rows"), *sums)
    hosts = written(hosts, "hosts")
    total = hosts.agg(F.sum("_rows").alias("rows"), *[F.sum(n).alias(n) for n in RULES]).first()
    n = float(total["rows"] or 0)
    spreads = [
        F.sum(F.col("_rows") * F.pow(F.col(x) / F.col("_rows") - F.lit((total[x] or 0) / n if n else 0.0), F.lit(2)))
        for x in RULES
    ]
    spread = hosts.agg(*[s.alias(x) for s, x in zip(spreads, RULES)]).first()
    worst = F.lit(False)
    for name in RULES:
        prior = fit_prior(n, float(total[name] or 0), float(spread[name] or 0.0))
        shrunk = (F.col(name) + prior.failures) / (F.col("_rows") + (prior.failures + prior.passes))
        worst = worst | (shrunk > WORST_RATE)
    bad = hosts.where(worst).select("_host", F.lit(True).alias("_bad"))
    judged = rows.join(bad, "_host", "left").select(
        "_row", *COUNTS, F.col("_fails_base").alias("base_failed"), F.coalesce("_bad", F.lit(False)).alias("host_rejected")
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))


_SUMS = ", ".join(f"sum(CAST({rule} AS INT)) AS f_{name}" for name, rule in RULES.items())
_PRIOR = ", ".join(
    f"CASE WHEN s_{x} > 0 THEN least(greatest(p_{x} * (1 - p_{x}) / (s_{x} / n) - 1, 1.0), 1000000.0) "
    f"ELSE 1000000.0 END AS m_{x}"
    for x in RULES
)
_WORST = " OR ".join(f"(f_{x} + p_{x} * m_{x}) / (h.n_rows + m_{x}) > {WORST_RATE}" for x in RULES)


def sql(documents: str = "documents") -> str:
    """The rules as DuckDB SQL over a relation of documents; keeps all its columns."""
    return f"""
WITH words AS (
  SELECT d.*, list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines
  FROM {documents} d
), grams AS (
  SELECT *, [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FOR i IN range(1, len(ws) - 1)] AS gs FROM words
), counted AS (
  SELECT g.* EXCLUDE (ws, lines, gs), len(ws) AS n_words,
    length(regexp_replace(coalesce(text, ''), '[ \\t-\\r]', '', 'g')) AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    list_histogram(gs) AS seen, gs AS gs
  FROM grams g
), repeated AS (
  SELECT *, list_filter(range(0, n_words), lambda i:
      coalesce(seen[gs[i + 1]], 0) > 1 OR (i >= 1 AND coalesce(seen[gs[i]], 0) > 1)
      OR (i >= 2 AND coalesce(seen[gs[i - 1]], 0) > 1)) AS covered FROM counted
), base AS (
  SELECT * EXCLUDE (seen, gs, covered), len(covered) AS n_repeat_words FROM repeated
), hosts AS (
  SELECT source, count(*) AS n_rows, {_SUMS} FROM base WHERE source IS NOT NULL GROUP BY source
), means AS (
  SELECT sum(n_rows) AS n, {", ".join(f"sum(f_{x}) / sum(n_rows) AS p_{x}" for x in RULES)} FROM hosts
), spreads AS (
  SELECT any_value(n) AS n, {", ".join(f"any_value(p_{x}) AS p_{x}, sum(n_rows * pow(f_{x} / n_rows - p_{x}, 2)) AS s_{x}" for x in RULES)}
  FROM hosts, means
), prior AS (SELECT *, {_PRIOR} FROM spreads),
bad AS (SELECT h.source FROM hosts h, prior WHERE {_WORST})
SELECT b.*, {RULES["base"]} AS base_failed,
  NOT ({RULES["base"]}) AND coalesce(source NOT IN (SELECT source FROM bad), TRUE) AS kept
FROM base b"""


OUT = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept"


@query("op5_host_rules", f"SELECT {OUT} FROM ({sql()}) q")
def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and host verdict of every document."""
    judged = host_rules(table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.selectExpr("_row.doc_id AS doc_id", *OUT.split(", ")[1:])
