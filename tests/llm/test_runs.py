"""Periodic runs against trying every period at every place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from commentloom.llm import queries, runs
from conftest import SMALL
from llm.fixtures import answers, documents, empty, ordered, rows


def plain(words, least=24, repeats=3):
    """(start, length, period) of all runs, by comparing all words a period apart, for every period."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, repeats * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j + 1
    return sorted(((a, size, q) for (a, size), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {i for a, size, q in found for i in range(a + q, a + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def found_in(words, least=24, repeats=3):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    values = np.array([numbers[w] for w in words], np.int64)
    low, high, period = runs.runs_of(values, np.zeros(len(values), np.int64), least, repeats)
    return list(zip(low.tolist(), (high - low).tolist(), period.tolist(), strict=True))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 5)), max_size=8)


@settings(max_examples=200, deadline=None)
@given(pieces, st.sampled_from([(24, 3), (9, 3), (12, 4)]))
def test_repeated_pieces(parts, limits):
    words = [w for unit, times, more in parts for w in unit * times + unit[:more]]
    assert found_in(words, *limits) == plain(words, *limits)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=300))
def test_two_words(words):
    assert found_in(words, 9, 3) == plain(words, 9, 3)


def test_words_that_nest():
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    thue = [bin(i).count("1") % 2 for i in range(700)]
    nested = ([1, 1, 1, 2] * 8 + [3]) * 8
    for words in (fib[-1], thue, nested, nested[5:] + [9] + nested, [7] * 1000, list(range(500)), [], [1]):
        assert found_in(words) == plain(words)


def test_texts_of_one_batch_stay_apart():
    texts = [[1, 2] * 20, [1, 2] * 30, [], [1, 2] * 5, [2, 1] * 20]
    words = np.array([w for t in texts for w in t], np.int64)
    low, high, period = runs.runs_of(words, np.repeat(np.arange(5), list(map(len, texts))))
    assert low.tolist() == [0, 40, 110] and high.tolist() == [40, 100, 150] and set(period.tolist()) == {2}


def test_rules_are_replayed_by_the_derivation():
    rng = random.Random(2)
    words = np.array([rng.randrange(3) for _ in range(400)] * 3, np.int64)
    symbol, start, middle, end = runs.derivation(words, np.zeros(len(words), np.int64))
    of = {}
    for s, a, m, b in zip(symbol, start, middle, end, strict=True):
        assert of.setdefault(s, (words[a:b].tolist(), m - a)) == (words[a:b].tolist(), m - a)
    assert (start.min(), end.max()) == (0, len(words)) and len(of) < len(symbol) < len(words)


def test_long_agreements_are_read_in_blocks(monkeypatch):
    monkeypatch.setattr(runs, "LEVELS", 3)
    monkeypatch.setattr(runs, "CHUNK_TRIES", 7)
    rng = random.Random(6)
    unit = [rng.randrange(9) for _ in range(101)]
    words = [8, 8] + unit * 5 + unit[:33] + [5] * 50
    assert found_in(words) == plain(words)


def test_limits():
    with pytest.raises(ValueError):
        runs.runs_of(np.zeros(9, np.int64), np.zeros(9, np.int64), 24, 2)


def test_tables(spark, monkeypatch):
    monkeypatch.setattr(runs, "CHUNK_WORDS", 500)
    data = rows()
    data += [(600 + i, " ".join(["again and again"] * (5 + i)) + " end", "en", "src0", 0) for i in range(12)]
    data += [(700, "a b\tc\n" * 5000 + " a b a b", "en", "src0", 0), (701, "x " * 30, None, None, None)]
    want = []
    for doc_id, text, *_ in data:
        words = split(text)
        found = plain(words)
        want.append((doc_id, len(words), [tuple(r) for r in found], collapse(words, found)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.find_runs(documents(spark, data)).collect()]
    assert ordered(got) == ordered(want)
    assert runs.find_runs(empty(spark)).count() == 0


def contract(doc_id, text):
    words, h = split(text), zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(split(text))
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{a},{size},{q}\n" for a, size, q in found)
    four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *four, sha(listed), sha(collapse(words, found)))


def test_query(spark):
    out = queries.QUERIES["op12_periodic_runs"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = ordered(contract(*r) for r in docs)
    assert answers(out) == want and sum(r[1] > 0 for r in want) > 5
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
