"""Words and their spelling variants, one inserted, deleted or replaced code point apart.

The index is one of variable-length grams. A gram dictionary is pruned by frequency: a gram is
extended by a further code point only if it is frequent among the words. A word is cut into the
longest gram at each of its places. One edit affects only the grams that contain its place, so the
largest number of grams over one place bounds the affected grams of a word, and two near words share
a gram among their so many plus one rarest. Only these lists are merged: a list holds the words that
agree in a gram and in all that stands on one side of it, as the edit is on one side of every gram
that it spares. Words alone in all their lists are done; the others are verified by what is left of
them without one code point, which is compared exactly.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import narrow, written
from goldseam.llm.registry import query
from goldseam.workloads.registry import table

_RUNS = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
LEAST_LENGTH = 5
LONGEST_GRAM = 8
#: Frequent grams of one length, at most; a gram is frequent from ``FREQUENT`` places on.
GRAMS_EACH, FREQUENT = 32_768, 16
_HELD = 200_000


def word_counts(
    docs: DataFrame, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``word, n``: letter runs with A-Z in lower case, of ``LEAST_LENGTH`` code points or more,
    that occur ``least_count`` times or more.

    Where 97 divides the crc32 of ``id:run``, the run loses the code point at that number modulo its
    length. Null and empty texts have no runs; a null id counts as empty in the crc32; repeated
    rows each count. Every task adds up before the shuffle, so a frequent word costs a row per task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def rows() -> pa.RecordBatch:
            columns = [pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{key.as_py()}:".encode() if key.is_valid else b":")
                found = Counter(_RUNS.findall(text.as_py().translate(_LOWER)))
                for run, n in found.items():
                    h = zlib.crc32(run.encode(), start)
                    if h % 97 == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= LEAST_LENGTH:
                        total[run] += n
                if len(total) > _HELD:
                    yield rows()
                    total.clear()
        if total:
            yield rows()

    texts = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    counted = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return written(counted.where(F.col("n") >= least_count), "words")


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """Frequent grams of 2 to ``LONGEST_GRAM - 1`` code points with their number of places.

    A gram is counted only if the gram without its last code point is frequent. The least number of
    places grows with the words so that at most ``GRAMS_EACH`` grams of a length are frequent.
    """
    places = words.agg(F.sum(F.length("word") - 1)).first()[0] or 0
    least = max(FREQUENT, -(-places // GRAMS_EACH))
    out: dict[str, int] = {}
    known = None
    for size in range(2, LONGEST_GRAM):
        long_enough = words.where(F.length("word") >= size)
        at = F.sequence(F.lit(1), F.length("word") - (size - 1))
        grams = long_enough.select(F.explode(at).alias("at"), "word")
        grams = grams.select(F.substring("word", F.col("at"), F.lit(size)).alias("gram"))
        if known is not None:
            grams = grams.withColumn("stem", F.substring("gram", 1, size - 1))
            # At most GRAMS_EACH rows of one short string.
            grams = grams.join(F.broadcast(known), "stem", "left_semi")
        frequent = grams.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= least).collect()
        if not frequent:
            break
        out.update((row["gram"], row["n"]) for row in frequent)
        known = words.sparkSession.createDataFrame([(row["gram"],) for row in frequent], "stem string")
    return out


def variable_grams(word: str, longest: int, frequent: dict[str, int]) -> tuple[list[tuple[int, int]], int]:
    """Place and length of the gram at each place, and the most grams that one edit affects.

    A gram depends on its own code points only, so an edit elsewhere leaves it as it is, but for
    a gram that ends with the word; an insertion there affects no more grams than a change of the
    last code point.
    """
    n = len(word)
    grams, cover = [], [0] * (n + 1)
    for at in range(n - 1):
        end = at + 2
        while end < n and end - at < longest and word[at:end] in frequent:
            end += 1
        grams.append((at, end - at))
        cover[at] += 1
        cover[end] -= 1
    most = now = 0
    for change in cover:
        now += change
        most = max(most, now)
    return grams, most


def gram_lists(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``list_key, word, n, size, cut``: the lists that a word belongs to.

    A pair of words of ``size`` and ``size`` or one more code points is looked for under ``size``, so
    a word is in lists of its own size and of the one below. Grams under ``size`` have at most
    ``size - 2`` code points, so a word always has more grams than an edit affects. ``cut`` is the
    number of code points before which all agree, or, below zero, minus one less the place from which
    all agree.
    """
    shared = words.sparkSession.sparkContext.broadcast(frequent)

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known, number = shared.value, xxhash.xxh64_intdigest
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                keys, cuts, rows, sizes = [], [], [], []
                for row, word in enumerate(part.column(0).to_pylist()):
                    for size in (len(word), len(word) - 1):
                        if size < LEAST_LENGTH:
                            continue
                        grams, most = variable_grams(word, min(LONGEST_GRAM, size - 2), known)
                        ranked = sorted((known.get(word[a : a + k], 0), word[a : a + k], a) for a, k in grams)
                        for _, gram, at in ranked[: most + 1]:
                            end = at + len(gram)
                            keys.append(number(f"{size} {at} {word[:end]}"))
                            cuts.append(end)
                            keys.append(number(f"{size} -{len(gram)} {word[at:]}"))
                            cuts.append(-1 - at)
                            rows += (row, row)
                            sizes += (size, size)
                at = pa.array(rows, pa.int32())
                signed = pa.array(keys, pa.uint64()).view(pa.int64())
                columns = [signed, part.column(0).take(at), part.column(1).take(at)]
                columns += [pa.array(sizes, pa.int32()), pa.array(cuts, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=["list_key", "word", "n", "size", "cut"])

    return words.mapInArrow(lists, "list_key long, word string, n long, size int, cut int")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, best, best_n`` of all words with a near one; ``best`` is the near word of the
    largest ``n``, of these the first in code-point order.

    ``words`` has distinct words of ``LEAST_LENGTH`` code points or more, with ``n``.
    """
    lists = gram_lists(words, gram_dictionary(words))
    shared = lists.groupBy("list_key").count().where("count > 1").select("list_key")
    met = lists.join(shared, "list_key", "left_semi")
    # The edit lies behind the shortest agreeing beginning, or before the last agreeing end.
    spans = met.groupBy("word", "n", "size").agg(
        F.min(F.when(F.col("cut") > 0, F.col("cut"))).alias("behind"),
        F.max(F.when(F.col("cut") < 0, -1 - F.col("cut"))).alias("before"),
    )
    place = F.explode(F.expr("sequence(0, length(word) - 1)")).alias("at")
    cut = spans.select("word", "n", "size", "behind", "before", place)
    cut = cut.where("coalesce(at >= behind, false) or coalesce(at < before, false)")
    rest = F.expr("substring(word, 1, at)"), F.expr("substring(word, at + 2)")
    # Of two near words the one with the smaller (-n, word) is the better form.
    entry = F.struct((-F.col("n")).alias("order"), F.col("word"))

    # Replaced: equal but for one place, so a class has at most a word for each letter there.
    pattern = F.concat(rest[0], F.lit("\0"), rest[1])
    classes = cut.where("size = length(word)").groupBy(pattern.alias("pattern"))
    classes = classes.agg(F.array_sort(F.collect_list(entry)).alias("members")).where("size(members) > 1")
    one = classes.select(
        F.explode("members").alias("own"),
        F.expr("members[0]").alias("first"),
        F.expr("members[1]").alias("second"),
        (F.size("members") - 1).cast("long").alias("n_near"),
    )
    first_of_others = F.when(F.col("own") == F.col("first"), F.col("second")).otherwise(F.col("first"))
    replaced = one.select(F.col("own.word").alias("word"), "n_near", first_of_others.alias("best"))

    # Deleted: of equal neighbours only the first, so every pair is met once.
    here, left = F.expr("substring(word, at + 1, 1)"), F.expr("substring(word, at, 1)")
    longer = cut.where("size < length(word)").where((F.col("at") == 0) | (here != left))
    longer = longer.select(F.concat(*rest).alias("shorter"), entry.alias("longer"))
    shorter = words.select(F.col("word").alias("shorter"), F.struct((-F.col("n")).alias("order"), "word").alias("own"))
    pairs = longer.join(shorter, "shorter").select(
        F.explode(
            F.array(
                F.struct(F.col("longer.word").alias("word"), F.col("own").alias("best")),
                F.struct(F.col("own.word").alias("word"), F.col("longer").alias("best")),
            )
        ).alias("link")
    )
    deleted = pairs.select("link.word", F.lit(1).cast("long").alias("n_near"), "link.best")
    near = replaced.unionByName(deleted).groupBy("word")
    near = near.agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return near.select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.order")).alias("best_n"))


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root``: the last form that follows from each word of ``word, form``.

    Every round doubles the steps that a row has gone. A form has twice its word's count, so there are
    at most 63 steps, and six rounds.
    """
    at = narrow(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        gone = at.join(on, "root", "left")
        gone = narrow(gone.select("word", F.coalesce("further", "root").alias("root"), "further"), "roots")
        if gone.where("further IS NOT NULL").isEmpty():
            return gone.select("word", "root")
        at = gone.select("word", "root")


def spelling_groups(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with counts ``n``.

    A word's form is its near word of largest ``n`` (of these the first in code-point order) if that
    is at least twice the word's own; the root is reached by following forms. A word without a near
    one has ``n_near`` 0, without a form null ``form`` and ``form_n`` and itself as root. An empty
    table gives no rows.
    """
    judged = words.join(near_words(words), "word", "left")
    formed = F.col("best_n") >= 2 * F.col("n")
    judged = written(
        judged.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
        ), "near-words",
    )
    roots = roots_of(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# The crc32 goes byte by byte through a table of 256 numbers, in rounds over all runs at once.
SQL = r"""
WITH RECURSIVE bits(b, c, k) AS (
  SELECT b, b, 0 FROM (SELECT unnest(range(256)) AS b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT b, c FROM bits WHERE k = 8),
runs AS (
  SELECT key, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') || ':' AS key, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) GROUP BY ALL
), texts AS (
  SELECT row_number() OVER () AS r, run, n, hex(encode(key || run)) AS h FROM runs
), steps(r, h, h_at, state) AS (
  SELECT r, h, 1, 4294967295 FROM texts
  UNION ALL
  SELECT r, h, h_at + 2, xor(state >> 8, c) FROM steps JOIN crc
    ON b = xor(state, ('0x' || substr(h, h_at, 2))::BIGINT) & 255
  WHERE h_at < length(h)
), hashed AS (
  SELECT run, n, xor(state, 4294967295) AS h
  FROM texts JOIN (SELECT r, state FROM steps WHERE h_at > length(h)) USING (r)
), spelled AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS z
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), links AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.z = y.z
    AND x.word <> y.word
  UNION
  SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.a || x.z = y.word
  UNION
  SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.a || x.z = y.word
), near AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS best, max(other_n) AS best_n
  FROM links GROUP BY word
), judged AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * n THEN best END AS form,
    CASE WHEN best_n >= 2 * n THEN best_n END AS form_n
  FROM words LEFT JOIN near USING (word)
), chains(word, root) AS (
  SELECT word, word FROM judged
  UNION ALL
  SELECT c.word, j.form FROM chains c JOIN judged j ON c.root = j.word WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n
FROM judged j JOIN chains c USING (word) JOIN judged last ON last.word = c.root AND last.form IS NULL"""


@query("op11_spelling_variants", SQL)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of the documents with their forms."""
    return spelling_groups(word_counts(table(spark, sf_dir, "documents")))
