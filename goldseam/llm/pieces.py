"""Text to token ids by way of pieces that can be encoded separately.

A byte-level pre-tokenizer never lets a match run from a non-space character into white space,
nor from a letter into ASCII punctuation, so a text can be cut there. Most pieces repeat, and
their ids are kept in a bounded table per worker; the encoder sees only new pieces.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from goldseam.llm.memory import LONG_KEY, worker_state
from goldseam.llm.words import column_bytes, grouped, hashed_spans, text_slices

# White space as the tokenizer libraries define it (the Unicode property, fixed values).
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Letters after which ASCII punctuation or white space always begins a new match.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
_WIDE_SPACES = [chr(c) for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
#: Bytes of ids of pieces that a worker keeps: encoding a new piece takes ten times a look-up.
PIECE_BYTES = 32 << 20
_PIECES = re.compile(
    rf"[{SPACE}]*[{LETTERS}]+(?=[!-/:-@\[-`{{-~{SPACE}])|[{SPACE}]*[^{SPACE}]+|[{SPACE}]+"
)
_IS_SPACE, _IS_MARK, _IS_LETTER = (np.zeros(256, bool) for _ in range(3))
_IS_SPACE[[32, *range(9, 14)]] = True
_IS_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Byte-level vocabularies show a space so (fixed value).
_SHOWN_SPACE = "\u0120"


def piece_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where pieces begin: at texts, at ASCII white space behind anything else, and at ASCII
    punctuation behind a letter. ``ends`` are the places where texts begin, and the last end."""
    if not len(data):
        return np.zeros(0, np.int64)
    space = _IS_SPACE[data]
    cuts = np.zeros(len(data), bool)
    cuts[1:] = space[1:] & ~space[:-1]
    before = np.zeros(len(data), bool)  # a letter stands before
    before[1:] = _IS_LETTER[data[:-1]]
    lead, tail = data[:-2], data[1:-1]
    # Two-byte letters, but for the signs of multiplication and division.
    before[2:] |= (lead == 0xC3) & (tail >= 0x80) & (tail != 0x97) & (tail != 0xB7)
    before[2:] |= ((lead >= 0xC4) & (lead <= 0xC8) & (tail >= 0x80)) | ((lead == 0xC9) & (tail >= 0x80) & (tail < 0x90))
    cuts |= before & _IS_MARK[data]
    cuts[ends[:-1][np.diff(ends) > 0]] = True
    return np.flatnonzero(cuts)


def _stretches(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of stretches that begin somewhere and hold so many places, one after another."""
    at = np.cumsum(counts) - counts
    return np.repeat(begins - at, counts) + np.arange(int(counts.sum()))


class KeptIds:
    """Ids of pieces by their numbers, in ``limit`` bytes: an open table of half filled slots, and the
    ids in one array."""

    def __init__(self, limit: int):
        self.slots = max(64, limit // 20)
        self.most = self.slots // 2
        self.clear()

    def clear(self) -> None:
        self.used = self.n_ids = 0
        self.numbers = np.zeros(self.slots, np.uint64)  # 0: an empty slot
        self.begins = np.zeros(self.slots, np.uint32)
        self.counts, self.sizes = np.zeros(self.slots, np.uint16), np.zeros(self.slots, np.uint16)
        self.ids = np.zeros(self.slots, "<u4")

    def full(self) -> bool:
        return 10 * self.used > 9 * self.most or 10 * self.n_ids > 9 * len(self.ids)

    def _first_slots(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        numbers = np.maximum(numbers, 1)
        return numbers, ((numbers >> np.uint64(32)) * np.uint64(self.slots) >> np.uint64(32)).astype(np.int64)

    def find(self, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The slot of each number, -1 where there is none."""
        numbers, slot = self._first_slots(numbers)
        out = np.full(len(numbers), -1)
        left = np.arange(len(numbers))
        while self.used and len(left):
            there = self.numbers[slot[left]]
            same = there == numbers[left]
            out[left[same]] = slot[left[same]]
            left = left[~same & (there != 0)]
            slot[left] = (slot[left] + 1) % self.slots
        known = out >= 0
        if (self.sizes[out[known]] != sizes[known]).any():
            raise ValueError("two pieces of different length share a number")
        return out

    def ids_at(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids in slots one after another, and how many each has."""
        counts = self.counts[slots].astype(np.int64)
        return self.ids[_stretches(self.begins[slots].astype(np.int64), counts)], counts

    def put(self, numbers: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep distinct numbers that have no slot, as many as there is room for."""
        ends = np.cumsum(counts)
        n = min(len(numbers), self.most - self.used, int(np.searchsorted(ends, len(self.ids) - self.n_ids, "right")))
        if n <= 0:
            return
        numbers, slot = self._first_slots(numbers[:n])
        left = np.arange(n)
        while len(left):
            free = left[self.numbers[slot[left]] == 0]
            self.numbers[slot[free]] = numbers[free]
            left = left[self.numbers[slot[left]] != numbers[left]]
            slot[left] = (slot[left] + 1) % self.slots
        self.begins[slot] = self.n_ids + ends[:n] - counts[:n]
        self.counts[slot], self.sizes[slot] = counts[:n], sizes[:n]
        self.ids[self.n_ids : self.n_ids + ends[n - 1]] = ids[: ends[n - 1]]
        self.used, self.n_ids = self.used + n, self.n_ids + int(ends[n - 1])


class PieceEncoder:
    """Little-endian unsigned 32-bit ids of texts; ``encode_new`` encodes a list of pieces.

    Ids of pieces are kept within a number of bytes. ``added`` are tokens that a library looks for
    before anything else, with their ids: a text is cut at them, and what lies between is encoded
    by itself.
    """

    def __init__(
        self,
        encode_new: Callable[[list[str]], Iterable[bytes]],
        added: dict[str, bytes] | None = None,
        kept_bytes: int = PIECE_BYTES,
    ):
        self.encode_new = encode_new
        self.newer, self.older = KeptIds(kept_bytes // 2), KeptIds(kept_bytes // 2)
        self.added = added or {}
        longest = "|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))
        self.cut = re.compile(f"({longest})") if longest else None
        self.odd = re.compile("|".join(filter(None, [*_WIDE_SPACES, longest])).encode())

    def encode_batch(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text; none for a null or empty text."""
        return self.encode_column(pa.array(texts, pa.large_string(), from_pandas=True))

    def encode_column(self, column: pa.Array) -> list[bytes]:
        """The ids of each text of a string column.

        Texts are cut on their bytes, and equal pieces are found by a 64-bit number and their
        length, so that each distinct piece of the column is looked up once.
        """
        data, ends = column_bytes(column)
        starts = self._starts(column, data, ends)
        owner = np.searchsorted(starts, ends)
        sizes = np.diff(starts, append=len(data))
        numbers = hashed_spans(data, starts)
        kind, first = grouped(numbers)
        if (sizes != sizes[first][kind]).any():
            raise ValueError("two pieces of different length share a number")
        ids, count = self._ids_of(data, starts[first], sizes[first], numbers[first])
        before = np.cumsum(count) - count
        n = count[kind]
        tokens = ids[_stretches(before[kind], n)].tobytes()
        bounds = (4 * np.append(0, np.cumsum(n)))[owner].tolist()
        return [tokens[s:e] for s, e in zip(bounds, bounds[1:])]

    def _starts(self, column: pa.Array, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pieces begin. Texts with wider white space, or with an added token, are cut as strings."""
        starts = piece_starts(data, ends)
        places = [m.start() for m in self.odd.finditer(data)]
        odd = np.unique(np.searchsorted(ends, places, "right") - 1)
        if not len(odd):
            return starts
        own = [starts[~np.isin(np.searchsorted(ends, starts, "right") - 1, odd)]]
        for i in odd.tolist():
            sizes = np.fromiter(map(len, self.pieces(column[i].as_py())), np.int64)
            own.append(ends[i] + np.cumsum(sizes) - sizes)
        return np.sort(np.concatenate(own))

    def pieces(self, text: str) -> list[bytes]:
        """A text cut as a string."""
        out: list[str] = []
        for part in self.cut.split(text) if self.cut else [text]:
            out += [part] if part in self.added else _PIECES.findall(part)
        return [p.encode() for p in out]

    def _ids_of(
        self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, numbers: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces one after another, and how many each has. New ones are encoded; those
        of up to ``LONG_KEY`` bytes stand in the newer table afterwards, as far as it has room."""
        if self.newer.full():
            self.newer, self.older = self.older, self.newer
            self.newer.clear()
        count, parts = np.zeros(len(numbers), np.int64), []
        left = np.arange(len(numbers))
        for table in (self.newer, self.older):
            at = table.find(numbers[left], sizes[left])
            known, left = left[at >= 0], left[at < 0]
            ids, count[known] = table.ids_at(at[at >= 0])
            parts.append((known, ids))
        whole = data.tobytes() if len(left) else b""
        for lo in range(0, len(left), 4096):
            part = left[lo : lo + 4096]
            found = self._answers([whole[s : s + n] for s, n in zip(starts[part].tolist(), sizes[part].tolist())])
            count[part] = np.fromiter(map(len, found), np.int64, len(found)) // 4
            parts.append((part, np.frombuffer(b"".join(found), "<u4")))
        begin = np.cumsum(count) - count
        out = np.empty(int(count.sum()), "<u4")
        for which, ids in parts:
            out[_stretches(begin[which], count[which])] = ids
        for which, ids in parts[1:]:
            short = which[sizes[which] <= LONG_KEY]
            if len(short) < len(which):
                ids = out[_stretches(begin[short], count[short])]
            self.newer.put(numbers[short], sizes[short], ids, count[short])
        return out, count

    def _answers(self, pieces: list[bytes]) -> list[bytes]:
        texts = [p.decode() for p in pieces]
        ids = iter(self.encode_new([t for t in texts if t not in self.added]))
        return [self.added[t] if t in self.added else next(ids) for t in texts]


def _tokenizer_encoder(path: str, kept_bytes: int = PIECE_BYTES) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    added = {}
    for number, token in tokenizer.get_added_tokens_decoder().items():
        if token.lstrip or token.rstrip or token.single_word or token.normalized:
            raise ValueError(f"an added token that depends on its neighbours: {token.content}")
        added[token.content] = struct.pack("<I", number)
    vocabulary = tokenizer.get_vocab()
    begins = np.zeros(max(vocabulary.values()) + 1, bool)
    begins[[number for token, number in vocabulary.items() if token.startswith(_SHOWN_SPACE)]] = True
    # Of a space and what follows up to the next, only the first token begins with the space, so
    # many can be encoded as one text and cut apart again.
    spaced = re.compile(f" [^{SPACE}]+")
    if hasattr(tokenizer.model, "_resize_cache"):
        tokenizer.model._resize_cache(0)  # known pieces never reach it

    def ids_of(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_new(pieces: list[str]) -> list[bytes]:
        joined = [spaced.fullmatch(p) is not None for p in pieces]
        rest = iter(ids_of([p for p, one in zip(pieces, joined) if not one]))
        words = [p for p, one in zip(pieces, joined) if one]
        data, cuts = b"", [0]
        if words:
            ids = ids_of(["".join(words)])[0]
            data, cuts = ids.tobytes(), [*(4 * np.flatnonzero(begins[ids])).tolist(), 4 * len(ids)]
            if len(cuts) != len(words) + 1:
                raise ValueError("the tokenizer does not begin a match at every space")
        ranges = zip(cuts, cuts[1:])
        return [data[slice(*next(ranges))] if one else next(rest).tobytes() for one in joined]

    return PieceEncoder(encode_new, added, kept_bytes)


def tokenizer_encoder(path: str, kept_bytes: int = PIECE_BYTES) -> PieceEncoder:
    """A piece encoder over a tokenizers file, one per worker."""
    return worker_state(("tokenizer", path, kept_bytes), lambda: _tokenizer_encoder(path, kept_bytes))


def column_slices(
    batches: Iterable[pa.RecordBatch], limit: int = 1 << 20
) -> Iterator[tuple[pa.Array, pa.Array]]:
    """First and second column of record batches, cut to texts of about ``limit`` bytes; encoding takes
    about thirty bytes of memory for each."""
    for batch in batches:
        for lo, hi in text_slices(batch.column(1), limit):
            yield batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)


def batches_of(frames: Iterable, column: str, limit: int = 4_000_000):
    """Cut pandas frames so that the texts of a batch hold about ``limit`` characters."""
    for frame in frames:
        start, size = 0, 0
        for i, text in enumerate(frame[column]):
            size += len(text) if text is not None else 0
            if size >= limit:
                yield frame.iloc[start : i + 1]
                start, size = i + 1, 0
        if start < len(frame):
            yield frame.iloc[start:]
