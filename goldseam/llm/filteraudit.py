"""Interaction of document filters in every order, from one table of counts per part."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from goldseam.llm.registry import query
from goldseam.workloads.registry import table

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
_CAPITALS = bytes(range(65, 91))
_MARKS = re.compile(rb"[#$%&*|]")
_COUNTS = "kept removed redundant unique_fails good_lost toxic_lost shapley".split()
_RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in _COUNTS)


def text_failures(text: str | None) -> tuple[int, bytes]:
    """Bits of the failed filters A to D, and a digest of the whole text (null counts as empty)."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    bits = len(words) < 50
    bits |= (100 * len(set(words)) < 65 * len(words)) << 1
    bits |= (100 * capitals > 5 * len(text or "")) << 2
    bits |= (_MARKS.search(data) is not None) << 3
    return int(bits), hashlib.blake2b(data, digest_size=16).digest()


@lru_cache(maxsize=1)
def _selectors() -> dict[str, np.ndarray]:
    """For every order and step, which places of each axis count: pass, fail or all.

    ``(orders * steps, axes, 2)``; place 0 of an axis is pass, place 1 is fail.
    """
    passes, fails, both = (1, 0), (0, 1), (1, 1)
    out: dict[str, list] = {"kept": [], "removed": [], "fails": [], "alone": []}
    for order in ORDERS:
        for step, letter in enumerate(order):
            before = order[:step]
            out["kept"].append([passes if x in before + letter else both for x in FILTERS])
            out["removed"].append([fails if x == letter else passes if x in before else both for x in FILTERS])
            out["fails"].append([fails if x == letter else both for x in FILTERS])
            out["alone"].append([fails if x == letter else passes for x in FILTERS])
    return {name: np.array(rows, np.int64) for name, rows in out.items()}


def contract(tensor: np.ndarray, selector: np.ndarray) -> np.ndarray:
    """``(parts, kinds, 2, 2, 2, 2, 2)`` to ``(parts, kinds, orders * steps)``."""
    axes = [selector[:, i] for i in range(STEPS)]
    return np.einsum("pkabcde,sa,sb,sc,sd,se->pks", tensor, *axes, optimize=True)


def audit(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """All result columns as ``(parts, orders * steps)``; kinds are all, good and toxic documents."""
    chosen = _selectors()
    removed = contract(tensor, chosen["removed"])
    every = tensor[:, :1]
    out = {
        "kept": contract(every, chosen["kept"])[:, 0],
        "removed": removed[:, 0],
        "redundant": contract(every, chosen["fails"])[:, 0] - removed[:, 0],
        "unique_fails": contract(every, chosen["alone"])[:, 0],
        "good_lost": removed[:, 1],
        "toxic_lost": removed[:, 2],
    }
    letters = np.array([FILTERS.index(x) for order in ORDERS for x in order])
    total = np.stack([removed[:, 0, letters == k].sum(axis=1) for k in range(STEPS)], axis=1)
    return out | {"shapley": total[:, letters]}


def outcome_counts(
    docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``part, code, n, good, toxic``: documents by the set of filters that they fail (bits A to E).

    A text fails E if a smaller document id has the identical text. Copies are first added up by
    text, part and label, so a text that a third of all documents share is a few rows per task.
    Null text counts as empty, a null part as the empty string; a null id is smaller or larger than
    none, so it fails nobody and E never fails it; rows that repeat an id each count, as does each
    of an id's labels only once (1 if any row says 1).
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                rows = batch.slice(at, 1024)
                found = [text_failures(t.as_py()) for t in rows.column(2)]
                bits, keys = zip(*found)
                columns = [rows.column(0), rows.column(1), pa.array(bits, pa.int32()), pa.array(keys, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "part", "bits", "key"])

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col)
    )
    kind = rows.schema["id"].dataType.simpleString()
    judged = rows.mapInArrow(judge, f"id {kind}, part string, bits int, key binary")
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast(kind).alias("id"))
    known = known.agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    text = ["key", "bits", "part", "good", "toxic"]
    seen = judged.join(known, "id", "left").fillna(0, ["good", "toxic"]).groupBy("id", *text).count()
    numbered = F.col("id").isNotNull()
    groups = seen.groupBy(*text).agg(
        F.sum("count").alias("n"),
        F.sum(F.when(numbered, F.col("count")).otherwise(0)).alias("with_id"),
        F.min(F.when(numbered, F.struct("id", "count"))).alias("least"),
    )
    first = F.min("least.id").over(Window.partitionBy("key"))
    groups = groups.withColumn("first", first)
    spared = F.when(F.col("least.id") == F.col("first"), F.col("least.count")).otherwise(0)
    groups = groups.withColumn("copies", F.col("with_id") - F.coalesce(spared, F.lit(0)))
    sides = F.array(
        F.struct(F.col("bits").alias("code"), (F.col("n") - F.col("copies")).alias("n")),
        F.struct((F.col("bits") + 16).alias("code"), F.col("copies").alias("n")),
    )
    flat = groups.select("part", "good", "toxic", F.explode(sides).alias("side"))
    return flat.groupBy("part", F.col("side.code").alias("code")).agg(
        F.sum("side.n").alias("n"),
        F.sum(F.col("side.n") * F.col("good")).alias("good"),
        F.sum(F.col("side.n") * F.col("toxic")).alias("toxic"),
    )


def filter_audit(
    docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per part, order of the five filters and step, with the counts of the audit.

    The 32 counts of a part are a 2x2x2x2x2 tensor; every figure is a contraction that takes pass,
    fail or all along each axis. Nulls, ties and repeated rows are as in ``outcome_counts``; an
    empty table gives no rows; other columns are ignored, whatever their names.
    """
    counts = outcome_counts(docs, labels, part_col, id_col, text_col)
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("code", "n", "good", "toxic")).alias("cells"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(ORDERS).take(pa.array(np.repeat(np.arange(len(ORDERS)), STEPS)))
        steps = np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS))
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                rows = batch.slice(at, 64)
                tensor = np.zeros((rows.num_rows, 3, 32), np.int64)
                for i, cells in enumerate(rows.column(1).to_pylist()):
                    for cell in cells:
                        tensor[i, :, cell["code"]] = cell["n"], cell["good"], cell["toxic"]
                # Bit 0 of a code is filter A, so A is the last axis until the axes are turned round.
                tensor = tensor.reshape(-1, 3, 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)
                figures = audit(tensor)
                n = rows.num_rows
                part = rows.column(0).take(pa.array(np.repeat(np.arange(n), len(steps))))
                order = pa.concat_arrays([names] * n)
                columns = [part, order, pa.array(np.tile(steps, n))]
                columns += [pa.array(figures[c].ravel(), pa.int64()) for c in _COUNTS]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *_COUNTS])

    return parts.mapInArrow(expand, _RESULT)


_LETTER = "substr(filter_order, step, 1)"
_FAILS = "list_contains(fails, substr(o.filter_order, s.step, 1))"
_EARLIER = "list_has_any(fails, string_split(substr(o.filter_order, 1, s.step - 1), ''))"

SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, list_filter(string_split_regex(text, '[ \t-\r]+'), lambda x: x <> '') AS ws,
    min(doc_id) OVER (PARTITION BY text) AS first_id
  FROM d
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
    max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, list_filter([
    CASE WHEN len(ws) < 50 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(ws)) < 65 * len(ws) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' END,
    CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > first_id THEN 'E' END], lambda x: x IS NOT NULL) AS fails
  FROM w LEFT JOIN l USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT unnest(range(1, 6))::INT AS step),
figures AS (
  SELECT part, filter_order, step,
    sum(CASE WHEN NOT {_FAILS} AND NOT {_EARLIER} THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN {_FAILS} AND NOT {_EARLIER} THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN {_FAILS} AND {_EARLIER} THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN {_FAILS} AND len(fails) = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN {_FAILS} AND NOT {_EARLIER} THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN {_FAILS} AND NOT {_EARLIER} THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, orders o, steps s GROUP BY ALL
)
SELECT *, (sum(removed) OVER (PARTITION BY part, {_LETTER}))::BIGINT AS shapley FROM figures"""


@query("op12_filter_audit", SQL)
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents by source."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
