"""Document quality: random-indexing word vectors, pooled, and a small calibrated network."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import ddl, map_frames
from goldseam.llm.pieces import batches_of
from goldseam.llm.registry import query
from goldseam.llm.sketch import summed
from goldseam.llm.words import column_bytes, grouped, text_slices, word_numbers
from goldseam.workloads.registry import table

BUCKETS, WIDTH, NONZERO = 8192, 32, 4
POOLED = 3 * WIDTH + 2
#: At most so many labelled rows are used to fit the network, those with the smallest hashes of
#: their ids. Word vectors are learned from all documents.
SAMPLE_ROWS = 20_000
REJECT_BELOW = 0.3
_RUNS, _DIGITS, _LETTERS = re.compile(r"(.)\1+"), re.compile(r"\d+"), re.compile(r"[^\W\d_]+")


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few non-zero components of each bucket's index vector."""
    rng = np.random.default_rng(7)
    places = np.argsort(rng.random((BUCKETS, WIDTH)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def _case(letters: str) -> str:
    return "x" if letters.islower() else "X" if letters.isupper() and len(letters) > 1 else "Xx"


def _bucket(unit: str) -> int:
    return zlib.crc32(unit.encode("utf-8", "replace")) % BUCKETS


def _units(word: str, shapes: dict[str, int]) -> int:
    """Buckets of a whole word's letters and of its shape (case, digits and marks, runs as one), as
    one number."""
    if word.isalpha():
        letters, shape = word.lower(), _case(word)
    else:
        letters = "".join(filter(str.isalpha, word)).lower()
        shape = _DIGITS.sub("9", _LETTERS.sub(lambda m: _case(m[0]), word))
        shape = _RUNS.sub(r"\1\1", shape)
    bucket = shapes.get(shape)
    if bucket is None:
        bucket = _bucket("s" + shape)
        shapes[shape] = bucket
    return _bucket("w" + letters) * BUCKETS + bucket


def units(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Letter buckets, shape buckets and number of words of texts, texts one after another. Each
    distinct word of about 1 MB of text is looked at once; nothing is kept between calls."""
    column = pa.array(texts, pa.large_string(), from_pandas=True)
    pairs, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in text_slices(column, 1 << 20):
        part = column.slice(lo, hi - lo)
        numbers, first, starts = word_numbers(part)
        kind, one = grouped(numbers)
        data = column_bytes(part)[0].tobytes()
        ends = np.append(starts[1:], len(data))[one].tolist()
        shapes: dict[str, int] = {}
        words = (data[s:e].rstrip().decode() for s, e in zip(starts[one].tolist(), ends))
        pairs.append(np.fromiter((_units(w, shapes) for w in words), np.int64, len(one))[kind])
        sizes.append(np.diff(first))
    both = np.concatenate(pairs)
    return both // BUCKETS, both % BUCKETS, np.concatenate(sizes)


def fit_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """One vector per bucket: the sum of the index vectors of all neighbouring words and shapes.

    Every task adds up a table of fixed size over its texts; the tables are summed by slices.
    """

    def count(frames: Iterator[pd.DataFrame]) -> np.ndarray:
        places, signs = _index_vectors()
        total = np.zeros(BUCKETS * WIDTH)
        for frame in batches_of(frames, text_col, 1_000_000):
            letters, shapes, sizes = units(frame[text_col])
            text = np.repeat(np.arange(len(sizes)), sizes)
            near = text[1:] == text[:-1]
            for left in (letters, shapes):
                for right in (letters, shapes):
                    for target, other in ((left[:-1][near], right[1:][near]), (left[1:][near], right[:-1][near])):
                        for k in range(NONZERO):
                            at = target * WIDTH + places[other, k]
                            total += np.bincount(at, signs[other, k], BUCKETS * WIDTH)
        return total

    vectors = summed(docs.select(text_col), BUCKETS * WIDTH, count)
    vectors = vectors.reshape(BUCKETS, WIDTH)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / (norms + 1)).astype(np.float32)


def pool(texts, vectors: np.ndarray) -> np.ndarray:
    """Of each text the mean vectors of its words, of its shapes and of its distinct words, and the
    logarithms of its numbers of words and of distinct words; zeros for a text without words."""
    letters, shapes, sizes = units(texts)
    n = len(sizes)
    out = np.zeros((n, POOLED))
    text = np.repeat(np.arange(n), sizes)
    different = np.unique(text * BUCKETS + letters)
    parts = ((text, letters), (text, shapes), (different // BUCKETS, different % BUCKETS))
    for k, (owner, bucket) in enumerate(parts):
        count = np.bincount(owner, minlength=n)
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        if len(starts):
            sums = np.add.reduceat(vectors[bucket], starts)
            some = count > 0
            out[some, k * WIDTH : (k + 1) * WIDTH] = sums / count[some, None]
    out[:, -2] = np.log1p(sizes)
    out[:, -1] = np.log1p(np.bincount(different // BUCKETS, minlength=n))
    return out


@dataclass
class Network:
    """Two layers over scaled inputs; the logit is divided by a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, rounds: int = 60) -> Network:
    """Fit by Adam on four fifths of the rows; the rest sets the temperature.

    Without rows every score is 0.5; with labels of one kind only, scores are near that label.
    """
    rng = np.random.default_rng(11)
    width = x.shape[1]
    if not len(x):
        zero = np.zeros(width)
        return Network(zero, zero + 1, np.zeros((width, hidden)), np.zeros(hidden), np.zeros(hidden), 0.0)
    order = rng.permutation(len(x))
    held = max(1, len(x) // 5) if len(x) >= 10 else 0
    test, train = order[:held], order[held:]
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    z, target = (x[train] - mean) / scale, y[train].astype(float)
    params = [rng.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for _ in range(rounds):
        shuffled = rng.permutation(len(z))
        for at in range(0, len(z), 128):
            rows = shuffled[at : at + 128]
            h = np.tanh(z[rows] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -500, 500)))
            error = (p - target[rows]) / len(rows)
            back = np.outer(error, params[2]) * (1 - h * h)
            grads = [z[rows].T @ back + 1e-4 * params[0], back.sum(axis=0), h.T @ error + 1e-4 * params[2], error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                rate = 3e-3 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                params[i] -= rate * first[i] / (np.sqrt(second[i]) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]))
    if held:
        logits, truth = net.logits(x[test]), y[test]
        steps = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.logaddexp(0, -np.where(truth == 1, logits, -logits) / t).mean() for t in steps]
        net.temperature = float(steps[int(np.argmin(loss))])
    return net


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class QualityModel:
    vectors: np.ndarray
    network: Network

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """All columns and ``_score`` (0 to 1); an existing ``_score`` is replaced."""
        docs = docs.drop("_score")
        shared = docs.sparkSession.sparkContext.broadcast((self.vectors, self.network))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            vectors, network = shared.value
            for frame in batches_of(frames, text_col, 1_000_000):
                yield frame.assign(_score=network.scores(pool(frame[text_col], vectors)))

        schema = ddl(docs)
        return map_frames(docs, run, f"{schema}, _score double")


def fit_quality(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> QualityModel:
    """Word vectors from all texts, the network from at most ``SAMPLE_ROWS`` labelled rows.

    Rows whose id is in the held-out fold are never learned from. Null labels and ids are left
    out; an id with several labels takes the smallest; rows that share an id are all learned
    from. Null and empty texts are texts without words. Labels, languages and sources are no
    inputs.
    """
    vectors = fit_vectors(docs, text_col)
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).dropna()
    known = known.where(~held_out(F.col("_id"))).groupBy("_id").agg(F.min("_label").alias("_label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_ROWS)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(known, "_id")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def pooled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, "_text", 1_000_000):
            x = pool(frame["_text"], shared.value).astype(np.float32)
            yield pd.DataFrame({"_id": frame["_id"], "_label": frame["_label"], "_x": [v.tobytes() for v in x]})

    kind = rows.schema["_id"].dataType.simpleString()
    sample = map_frames(rows, pooled, f"_id {kind}, _label int, _x binary")
    sample = sample.orderBy(F.xxhash64("_id"), "_id", "_x").limit(SAMPLE_ROWS).toPandas()
    x = np.frombuffer(b"".join(sample["_x"]), np.float32).reshape(-1, POOLED).astype(float)
    return QualityModel(vectors, fit_network(x, sample["_label"].to_numpy()))


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return model.score(docs).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )
