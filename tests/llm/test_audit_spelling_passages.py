"""Filter audit, spelling variants and substring dedup against plain versions."""

import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from goldseam.llm import filteraudit, passages, spelling
from goldseam.llm.words import hashed_words, text_slices

SCHEMA = "doc_id long, text string, source string, id long, key string, word string, n long, part string"
LABELS = "doc_id long, quality int, toxic int"


def frame(spark, rows):
    """Rows of id, text and source beside columns with names that the operators use inside."""
    return spark.createDataFrame([(i, t, s, 7, "k", "w", 9, "p") for i, t, s in rows], SCHEMA)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(rng, n, letters="abcdeé"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows_for_audit():
    rng = random.Random(5)
    base = prose(rng, 70)
    rows = [
        (3, base, "a"), (1, base, "b"), (1, base, "b"), (2, base, None), (None, base, "a"), (None, base, ""),
        (4, None, None), (5, "", ""), (6, "", "c"), (7, "UPPER " * 60, "c"), (8, "one # two", "c"),
        (9, prose(rng, 49), "c"), (10, prose(rng, 50), "c"), (11, "ab " * 20_000 + "$", "c"), (12, "A" + "é" * 19, "d"),
        (2**60 + 1, "A" + "é" * 18, "d"), (2**60, base, "d"),
    ]
    return rows + [(100 + i, rng.choice([base, "x y z", prose(rng, 60) + "|"]), rng.choice("abc")) for i in range(60)]


def expected_audit(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    smallest = {}
    for i, text, _ in rows:
        if i is not None:
            smallest[text or ""] = min(i, smallest.get(text or "", i))
    fails = []
    for i, text, part in rows:
        text, found = text or "", words_of(text)
        bad = {
            "A": len(found) < 50, "B": 100 * len(set(found)) < 65 * len(found),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": i is not None and i > smallest[text],
        }
        fails.append((part or "", i, {k for k, v in bad.items() if v}))
    out = {}
    for part in {p for p, _, _ in fails}:
        mine = [(i, bad) for p, i, bad in fails if p == part]
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [(i, bad) for i, bad in left if letter in bad]
                left = [(i, bad) for i, bad in left if letter not in bad]
                shapley[letter] += len(gone)
                failing = sum(letter in bad for _, bad in mine)
                alone = sum(bad == {letter} for _, bad in mine)
                lost = sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)
                out[part, "".join(order), step] = [len(left), len(gone), failing - len(gone), alone, *lost]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(shapley[order[step - 1]])
    return out


def test_filter_audit(spark):
    rows = rows_for_audit()
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(1, 90)] + [(4, 1, None), (4, 0, 1), (None, 1, 1), (3, 1, 1)]
    known = spark.createDataFrame(labels, LABELS)
    got = filteraudit.filter_audit(frame(spark, rows).repartition(5), known).collect()
    assert {(r.part, r.filter_order, r.step): list(r)[3:] for r in got} == expected_audit(rows, labels)
    assert len(got) == 600 * len({s or "" for _, _, s in rows})


def test_filter_audit_empty(spark):
    nothing, unlabelled = frame(spark, []), spark.createDataFrame([], LABELS)
    assert filteraudit.filter_audit(nothing, unlabelled).count() == 0
    got = filteraudit.filter_audit(frame(spark, [(1, "a", "s")]), unlabelled).collect()
    assert len(got) == 600 and all(r.good_lost == r.toxic_lost == 0 for r in got)


def test_contractions_match_a_loop():
    tensor = np.random.default_rng(1).integers(0, 9, (2, 3, 2, 2, 2, 2, 2))
    got = filteraudit.audit(tensor)
    cells = list(itertools.product((0, 1), repeat=5))
    for s, (order, step) in enumerate(itertools.product(filteraudit.ORDERS, range(5))):
        axes = ["ABCDE".index(x) for x in order[: step + 1]]
        kept = sum(tensor[1, 0][c] for c in cells if not any(c[a] for a in axes))
        removed = sum(tensor[1, 0][c] for c in cells if c[axes[-1]] and not any(c[a] for a in axes[:-1]))
        assert (got["kept"][1, s], got["removed"][1, s]) == (kept, removed)


# --- spelling variants


def expected_counts(rows):
    counts = Counter()
    for i, text, *_ in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected_groups(counts):
    out = {}
    for w, n in counts.items():
        close = [v for v in counts if near(w, v)]
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = (form, n, len(close), counts.get(form))
    for w in list(out):
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w] = (*out[w], root)
    return out


def as_dict(groups):
    return {r.word: (r.form, r.n, r.n_near, r.form_n, r.root) for r in groups.collect()}


def test_word_counts(spark):
    rng = random.Random(8)
    text = " ".join(rng.choice(["Straße", "ÀÉÎõü", "HELLO", "hello", "a×b÷cdef", "don't", "word"]) for _ in range(3000))
    rows = [(1, text, "a"), (1, text, "a"), (None, text, "b"), (2, None, "b"), (3, "", None), (4, "z" * 50_000, "c")] * 2
    rows += [(i, "colour colours " + prose(rng, 30, "abcdefgh"), "d") for i in range(5, 300)]
    got = spelling.word_counts(frame(spark, rows).repartition(4))
    assert {r.word: r.n for r in got.collect()} == expected_counts(rows)
    assert spelling.word_counts(frame(spark, [])).count() == 0


@pytest.mark.parametrize("letters,most,prefix", [("ab", 9, ""), ("abé", 7, ""), ("abc", 5, "prefixprefix"), ("aab", 14, "")])
def test_spelling_groups(spark, letters, most, prefix, monkeypatch):
    monkeypatch.setattr(spelling, "FREQUENT", 4)
    rng = random.Random(most)
    counts = {}
    for _ in range(400):
        w = "".join(rng.choice(letters) for _ in range(rng.randint(5, most)))
        w = prefix + w if rng.random() < 0.5 else w + prefix
        counts[w] = rng.choice([3, 3, 4, 6, 8, 12, 24, 50, 100])
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert as_dict(spelling.spelling_groups(table)) == expected_groups(counts)


def test_spelling_chain_and_empty(spark):
    chain = {"aaaaaa"[:k] + "b" * (9 - k): 3 * 2**k for k in range(7)} | {"aaaaabbbbb": 3, "zzzzzzz": 10}
    table = spark.createDataFrame(list(chain.items()), "word string, n long")
    assert as_dict(spelling.spelling_groups(table)) == expected_groups(chain)
    assert spelling.spelling_groups(table.where("n < 0")).count() == 0


def test_every_word_has_more_grams_than_an_edit_affects():
    rng = random.Random(2)
    known = {"ab": 50, "aba": 30, "abab": 20, "ababa": 9, "ba": 40, "bab": 11, "aa": 5}
    for _ in range(500):
        w = "".join(rng.choice("ab") for _ in range(rng.randint(5, 20)))
        for size in (len(w), len(w) - 1):
            if size >= 5:
                grams, most = spelling.variable_grams(w, min(8, size - 2), known)
                assert len(grams) > most


# --- substring dedup


def expected_dedup(rows, size=13):
    first, split = {}, [words_of(t) for _, t, *_ in rows]
    for (i, *_), ws in zip(rows, split):
        for k in range(len(ws) - size + 1 if i is not None else 0):
            w = tuple(ws[k : k + size])
            first[w] = min(i, first.get(w, i))
    out = []
    for (i, *_), ws in zip(rows, split):
        gone = set()
        for k in range(len(ws) - size + 1 if i is not None else 0):
            if first[tuple(ws[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone)))
    return sorted(out, key=repr)


def passage_rows(seed):
    rng = random.Random(seed)
    shared = [prose(rng, n, "ab") for n in (12, 13, 14, 40, 70)] + ["a " * 30, "x y " * 20]
    rows = []
    for i in range(60):
        parts = [rng.choice(shared) if rng.random() < 0.5 else prose(rng, rng.randint(1, 30), "abcdef") for _ in range(6)]
        rows.append((rng.choice([i, i, 5, None]), rng.choice([" ", "\n\t "]).join(parts), "s"))
    long = prose(rng, 20_000, "abc")
    rows += [(70, long, "s"), (71, "x " + long, "s"), (71, "x " + long, "s"), (71, shared[3] + " tail", "s")]
    rows += [(72, None, "s"), (73, "", "s"), (74, " \n ", "s"), (None, None, "s"), (2**60 + 1, shared[4], "s")]
    return rows + [(75, "w" * 5000 + " " + shared[4] + " " + "é" * 70, "s"), (76, "日本 " * 40, "s"), (77, "日本 " * 41, "s")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_remove_repeats(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(passages, "CHUNK_WORDS", 50)
    rows = passage_rows(seed)
    got = passages.remove_repeats(frame(spark, rows).repartition(6))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == expected_dedup(rows)


def test_remove_repeats_empty(spark):
    assert passages.remove_repeats(frame(spark, [])).count() == 0
    short = frame(spark, [(1, "a b", "s"), (2, "a b", "s")])
    assert sorted(passages.remove_repeats(short).collect()) == [(1, 2, 0, "a b"), (2, 2, 0, "a b")]


def test_equal_numbers_of_different_windows(monkeypatch):
    """Windows that share a number are told apart word by word."""
    words = np.random.default_rng(0).integers(0, 3, 400, np.uint64)
    places = np.arange(len(words) - 3)
    monkeypatch.setattr(passages, "_WINDOW", 0)
    monkeypatch.setattr(passages, "mixed", lambda x: x & np.uint64(0))
    order, heads = passages._first_places(words, places, 4)
    kinds = defaultdict(set)
    for lo, hi in zip(heads, [*heads[1:], len(order)]):
        for p in order[lo:hi]:
            kinds[int(lo)].add(tuple(words[p : p + 4]))
    assert all(len(k) == 1 for k in kinds.values())
    assert len(kinds) == len({tuple(words[p : p + 4]) for p in places})


def test_packed_rows():
    rng = np.random.default_rng(4)
    lengths = rng.integers(13, 30, 50)
    groups = np.bincount(np.sort(rng.integers(0, passages.GROUPS, 50)), minlength=passages.GROUPS)
    least, most = rng.integers(-(2**61), 2**61, 50), rng.integers(-(2**61), 2**61, 50)
    words = rng.integers(0, 2**64, 90_000, np.uint64)[rng.integers(0, 90_000, int(lengths.sum()))]
    back = passages.Packed(passages._packed(groups, lengths, least, most, words))
    parts = [np.concatenate(x) for x in zip(*[back.group(i) for i in range(passages.GROUPS)])]
    for part, want in zip(parts, (lengths, least, most, words)):
        assert (part == want).all()


def test_hashed_words(monkeypatch):
    from goldseam.llm import words

    rng = random.Random(6)
    texts = [None, "", " ", "a", "日本\x1c語 é", "x" * 200 + "\x0b" + "x" * 201, prose(rng, 500), " " + "y" * 3000, prose(rng, 500)]
    column = pa.array(texts)
    want = hashed_words(column)
    monkeypatch.setattr(words, "_CHUNK", 64)
    got = hashed_words(column)
    assert all((a == b).all() for a, b in zip(got, want))
    flat = [w for t in texts for w in words_of(t)]
    assert np.diff(want[1]).tolist() == [len(words_of(t)) for t in texts]
    assert len(set(zip(flat, want[0].tolist()))) == len(set(flat)) == len(set(want[0].tolist()))
    part = hashed_words(column.slice(4, 3))
    assert (part[0] == want[0][want[1][4] : want[1][7]]).all()
    assert [x for lo, hi in text_slices(column, 100) for x in range(lo, hi)] == list(range(len(texts)))
