"""Byte-level BPE without merging: longest matches, backtracking over compatible neighbours."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldseam.llm.common import ddl, map_frames
from goldseam.llm.memory import worker_state
from goldseam.llm.pieces import SPACE, PieceEncoder, column_slices
from goldseam.llm.registry import query
from goldseam.workloads.registry import table


class BytePairs:
    """Encoder and decoder for a table of ranks (bytes to rank, lower merges first).

    A sequence of tokens is what merging by rank gives exactly if every two neighbours are: no
    merge of lower rank crosses their border. So the encoder takes the longest token at each
    place, checks it against its left neighbour, falls back to the token's next shorter prefix,
    and, when none fits, withdraws the neighbour. A place that was found hopeless is marked and
    never tried again, which keeps the work linear. All matches come from one Aho-Corasick
    automaton over bytes mapped to Latin-1; answers about neighbours are kept.
    """

    #: Answers about neighbours kept; the older half goes when they are full.
    KNOWN = 100_000

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.words: dict[int, bytes] = {rank: word for word, rank in ranks.items()}
        self.length = {rank: len(word) for word, rank in ranks.items()}
        self.shorter: dict[int, int] = {}
        self.merge_of: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.answers: dict[int, bool] = {}
        self.automaton = ahocorasick.Automaton()
        for rank in sorted(self.words):
            word = self.words[rank]
            self.automaton.add_word(word.decode("latin-1"), rank)
            cuts = range(len(word) - 1, 0, -1)
            self.shorter[rank] = next((ranks[word[:i]] for i in cuts if word[:i] in ranks), -1)
        for rank in sorted(self.words):
            self._split(rank)
        self.answers.clear()
        self.automaton.make_automaton()

    def _split(self, rank: int) -> None:
        """Find the last merge that makes a token; a token that no merge makes is its own part."""
        word, left = self.words[rank], self.shorter[rank]
        while left >= 0:
            right = self.ranks.get(word[self.length[left] :], -1)
            if 0 <= right < rank and left < rank and self._fits(left, right):
                self.merge_of[left, right] = rank
                self.parts[rank] = (left, right)
                return
            left = self.shorter[left]
        self.parts[rank] = (rank, rank)

    def _fits(self, left: int, right: int) -> bool:
        """Whether no merge crosses the border, undoing the later of both sides' last merges in turn."""
        before = float("inf")
        while True:
            merged = self.merge_of.get((left, right))
            if merged is not None and merged < before:
                return False
            undo_left = left > right
            for _ in range(2):
                if undo_left:
                    inner = self.parts[left][1]
                    if inner != left:
                        before, left = left, inner
                        break
                    before = right + 1
                else:
                    inner = self.parts[right][0]
                    if inner != right:
                        before, right = right + 1, inner
                        break
                    before = left
                undo_left = not undo_left
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        """``_fits`` with kept answers, at most ``KNOWN`` of them."""
        key = left << 32 | right
        answer = self.answers.get(key)
        if answer is None:
            if len(self.answers) >= self.KNOWN:
                self.answers = dict(islice(self.answers.items(), self.KNOWN // 2, None))
            answer = self.answers[key] = self._fits(left, right)
        return answer

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one match of the pre-tokenizer."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        length, shorter, fits = self.length, self.shorter, self.fits
        longest = [-1] * len(piece)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length[rank] + 1] = rank  # later ends are longer
        hopeless = bytearray(len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0] if piece else -1
        while at < len(piece):
            end = at + length[token] if token >= 0 else 0
            if token < 0:
                if not out:
                    raise ValueError("a byte is missing from the ranks")
                hopeless[at] = 1
                token = out.pop()
                at -= length[token]
                token = shorter[token]
            elif not hopeless[end] and (not out or fits(out[-1], token)):
                out.append(token)
                at = end
                token = longest[at] if at < len(piece) else -1
            else:
                token = shorter[token]
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.words.__getitem__, ids.tolist()))


def byte_pairs(path: str) -> BytePairs:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return BytePairs({base64.b64decode(word): int(rank) for word, rank in pairs})


class PairCoder(PieceEncoder):
    """A piece encoder over a file of ranks: matches of ``pattern`` (its ``\\s`` as tokenizer libraries
    read it), each by itself."""

    def __init__(self, path: str, pattern: str):
        import regex

        super().__init__(self._encode_new)
        self.pairs = byte_pairs(path)
        self.matches = regex.compile(
            pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")
        )

    def _encode_new(self, pieces: list[str]) -> Iterator[bytes]:
        for piece in pieces:
            ids: list[int] = []
            for match in self.matches.findall(piece):
                ids += self.pairs.encode(match.encode())
            yield np.array(ids, "<u4").tobytes()


def pair_coder(path: str, pattern: str) -> PairCoder:
    """Encoder and decoder of a worker; both use one table of ranks."""
    return worker_state(("pairs", path, pattern), lambda: PairCoder(path, pattern))


def encode_texts(
    docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False
) -> DataFrame:
    """``doc_id, ids``: the ids of every text as little-endian unsigned 32-bit integers; with ``decode``
    also ``decoded``, the bytes that these ids stand for.

    Null and empty texts have no ids; null and repeated document ids are kept; texts are taken whole,
    whatever their length; an empty table gives no rows; other columns are ignored.
    """

    names = ["doc_id", "ids", *["decoded"] * decode]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pair_coder(ranks, pattern)
        for keys, texts in column_slices(batches):
            ids = coder.encode_column(texts)
            columns = [keys, pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array([coder.pairs.decode(np.frombuffer(x, "<u4")) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encode, f"doc_id {kind}, ids binary" + ", decoded binary" * decode)


def decode_ids(encoded: DataFrame, ranks: str, ids_col: str = "ids") -> DataFrame:
    """All columns and ``decoded``, the bytes that the ids stand for; null ids decode to none."""

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pairs = worker_state(("ranks", ranks), lambda: byte_pairs(ranks))
        for frame in frames:
            ids = [np.frombuffer(x or b"", "<u4") for x in frame[ids_col]]
            yield frame.assign(decoded=[pairs.decode(x) for x in ids])

    schema = ddl(encoded)
    return map_frames(encoded, decode, f"{schema}, decoded binary")


@query("op4_byte_bpe")
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents")
    return encode_texts(docs, ranks, public_tokenizers.PATTERN, decode=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
