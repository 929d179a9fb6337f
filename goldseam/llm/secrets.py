"""Secret scan: fixed patterns, and strings that compression against known words cannot shorten."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import ddl, map_frames
from goldseam.llm.pieces import batches_of
from goldseam.llm.registry import query
from goldseam.workloads.registry import table

#: Kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Words beside which an incompressible string is reported.
SENSITIVE = re.compile(
    r"password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credential|"
    r"authorization|bearer|client[_-]?id|auth",
    re.ASCII | re.IGNORECASE,
)
LEAST_LENGTH = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST_LENGTH},}}")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_VOWEL = re.compile(r"[aeiouyAEIOUY]")
#: Share of vowels from which letters in parts of three or more read like words; random ones have 0.23.
LEAST_VOWELS = 0.28
#: Identifiers that prime the compressor.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key client_id client_secret "
    "authorization bearer credential username user_name config settings environment variable "
    "return function class import public private static const string integer boolean value "
    "default example placeholder changeme test_token your_token_here your_api_key_here "
    "getElementById addEventListener application/json content-type http https www localhost "
    "index identifier reference description implementation configuration connection database"
)
CONTEXT = 64
#: Smallest marginal bytes for each byte of a candidate; random base64 needs about 0.75.
LEAST_NOVELTY = 0.7


@lru_cache(maxsize=1)
def _compressor():
    import zstandard

    dictionary = zstandard.ZstdCompressionDict(
        IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    return zstandard.ZstdCompressor(level=19, dict_data=dictionary, write_content_size=False)


def novelty(before: str, candidate: str, after: str) -> float:
    """Marginal compressed bytes of a candidate for each of its bytes.

    The compressor is primed with identifier words and sees the surrounding text first, so names,
    repeated strings and parts of the context cost next to nothing.
    """
    size = lambda s: len(_compressor().compress(s.encode("utf-8", "replace")))
    around = before + after
    return (size(around + candidate) - size(around)) / len(candidate.encode("utf-8", "replace"))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Start, kind and end of the fixed patterns, leftmost without overlaps in each kind."""
    out = []
    folded = text.lower()
    if any(cue in folded for cue in _CUES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def _candidates(text: str) -> list[tuple[int, int]]:
    """Strings with a sensitive word at most ``CONTEXT`` characters before or after them.

    A word inside a string cuts it: the part before the first word, all that follows it, and the
    parts between two words count. So each character is in four strings at most, however many words
    a string holds.
    """
    words = [m.span() for m in SENSITIVE.finditer(text)]
    out: set[tuple[int, int]] = set()
    starts = [start for start, _ in words]
    for m in _CANDIDATE.finditer(text) if words else ():
        start, end = m.span()
        first, after = bisect_left(starts, start), bisect_left(starts, end)
        if first > 0 and start - words[first - 1][1] <= CONTEXT:
            out.add((start, end))
        if first == after:
            if after < len(words) and starts[after] - end <= CONTEXT:
                out.add((start, end))
            continue
        cuts = [(start, starts[first]), (words[first][1], end)]
        ends = [*starts[first + 1 : after], end]
        cuts += [(words[first + i][1], cut) for i, cut in enumerate(ends)]
        out.update((s, e) for s, e in cuts if e - s >= LEAST_LENGTH)
    return sorted(out, key=lambda x: (x[0], -x[1]))


def wordlike(candidate: str) -> bool:
    """Whether a string without digits reads like words or a name: long parts with vowels."""
    parts = _PART.findall(candidate)
    n = sum(map(len, parts))
    return n >= 3 * len(parts) and len(_VOWEL.findall(candidate)) >= LEAST_VOWELS * n


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Incompressible strings near a sensitive word, outside the spans that are known already."""
    out, last, done = [], -1, -1
    starts = [s for s, _, _ in base]
    reach = list(accumulate((e for _, _, e in base), max))
    for start, end in _candidates(text):
        known = bisect_left(starts, end)
        if start <= last or end <= done or (known and reach[known - 1] > start):
            continue
        candidate = text[start:end]
        if not re.search(r"[A-Za-z]", candidate) or not (re.search(r"\d", candidate) or not wordlike(candidate)):
            continue
        around = (text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT])
        if novelty(around[0], candidate, around[1]) >= LEAST_NOVELTY:
            out.append((start, 3, end))
            last, done = start, end
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def all_spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the fixed patterns, and these with the incompressible strings; none for a null text."""
    base = base_spans(text) if text else []
    return base, sorted(base + novel_spans(text, base)) if text else []


def scan_secrets(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, and ``_n_assign, _n_access, _n_hex, _base, _spans``.

    ``_base`` lists the spans of the fixed patterns, ``_spans`` also the incompressible strings,
    both as ``kind:start:end`` in code points. A null or empty text has none; the time for a text
    grows in proportion to its length; repeated rows are kept; an empty table gives no rows;
    existing columns of these names are replaced. One pass without a shuffle.
    """
    added = ["_n_assign", "_n_access", "_n_hex", "_base", "_spans"]
    docs = docs.drop(*added)

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, text_col):
            rows = []
            for text in frame[text_col]:
                base, spans = all_spans(text)
                n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
                rows.append((*n, joined(base), joined(spans)))
            yield frame.assign(**dict(zip(added, zip(*rows))))

    schema = ddl(docs)
    return map_frames(
        docs, scan, f"{schema}, _n_assign long, _n_access long, _n_hex long, _base string, _spans string"
    )


def redact(docs: DataFrame, text_col: str = "text", label: str = "[secret]") -> DataFrame:
    """The same columns, with every span that ``scan_secrets`` finds replaced by ``label``; overlapping
    spans as one. One pass: a scan and a replacement after it would hold two Python workers for
    each task, which executors keep for later stages."""

    def replace(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches_of(frames, text_col):
            out = []
            for text in frame[text_col]:
                done, at = [], 0
                for start, _, end in all_spans(text)[1]:
                    if end <= at:
                        continue
                    if start >= at:
                        done += [text[at:start], label]
                    at = end
                out.append("".join(done) + text[at:] if done else text)
            yield frame.assign(**{text_col: out})

    return map_frames(docs, replace, ddl(docs))


@query("op6_secret_scan")
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("_n_assign").alias("n_assign"),
        F.col("_n_access").alias("n_access"),
        F.col("_n_hex").alias("n_hex"),
        F.sha2("_base", 256).alias("base_sha256"),
        F.col("_spans").alias("spans"),
    )
