"""Periodic runs of words, found on a grammar.

A run is a stretch of words with smallest period q that has at least ``least`` words and ``repeats`` periods and that no
neighbouring word extends.  Texts become word numbers, and a text's numbers become a grammar by Re-Pair: pairs that
occur twice or more become nonterminals until none does; pairs are replaced in rounds, in each the more frequent
one wherever two overlap.  The symbols that are left are joined in a balanced tree, whose nodes are nonterminals that occur once.

A run lies within some node of the derivation and crosses the boundary between that node's two parts, so for each
nonterminal, once, all runs across its boundary are computed (``across``), translated to every position that derives it,
and of intervals with one period only the maximal ones stay.  Across a boundary, at least half of a run lies on one side, so the
few words beside the boundary occur again a period away: that gives the periods to try, of which a nonterminal of n
words has at most 2 n / ``repeats``.  How far a period reaches both ways is read off exact names of blocks of
2**k words.  Texts of a batch are worked on together; symbols of different texts never compare equal.

Null and empty texts and texts of white space have no words and no runs.  Repeated rows and null ids are kept row by
row; an empty table gives an empty result; columns other than the id and the text are not read.  A task holds
``CHUNK_WORDS`` words at a time, besides one text's own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.common import keyed

CHUNK_WORDS = 200_000
CHUNK_TRIES = 1 << 20  # periods tried at a time
LEVELS = 12  # blocks of up to 2**12 words have names; longer agreements are read in blocks of that size
RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _named(*columns: np.ndarray) -> np.ndarray:
    """Numbers 0.. that are equal where all columns are."""
    key = columns[0].astype(np.int64)
    for c in columns[1:]:
        key = key * (int(c.max(initial=0)) + 1) + c
    return np.unique(key, return_inverse=True)[1]


def _local_maxima(rank: np.ndarray) -> np.ndarray:
    """Places of pairs to replace: by falling rank, none overlapping another; rank 0 is never taken."""
    rank = rank.copy()
    # In a row of one word the same pair overlaps itself: every second one counts.
    same = np.concatenate([[False], (rank[1:] == rank[:-1]) & (rank[1:] > 0)])
    place = np.arange(len(rank))
    rank[(place - np.maximum.accumulate(np.where(same, 0, place))) % 2 == 1] = 0
    taken = np.zeros(len(rank), bool)
    while True:
        padded = np.concatenate([[0], rank, [0]])
        now = (rank > padded[:-2]) & (rank > padded[2:])
        if not now.any():
            return taken
        taken |= now
        near = np.concatenate([[False], now, [False]])
        rank[near[1:-1] | near[:-2] | near[2:]] = 0


def derivation(symbols: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbol, start, middle, end) of every node of the texts' derivations; ``text`` rises and says whose each word is.

    Equal numbers in ``symbol`` are one nonterminal.
    """
    seq, at = symbols.astype(np.int64), np.arange(len(symbols) + 1)
    fresh = int(seq.max(initial=-1)) + 1
    rng, nodes = np.random.default_rng(1), []

    def replace(places: np.ndarray, names: np.ndarray) -> None:
        nonlocal seq, at
        nodes.append((names, at[places], at[places + 1], at[places + 2]))
        seq[places] = names
        stay = np.ones(len(seq), bool)
        stay[places + 1] = False
        seq, at = seq[stay], np.concatenate([at[:-1][stay], at[-1:]])

    open_ = np.ones(len(seq), bool)  # a pair seen once never occurs again
    while len(seq) > 1:
        open_[:-1] &= text[at[:-2]] == text[at[1:-1]]
        open_[-1] = False
        where = np.flatnonzero(open_)
        if not len(where):
            break
        _, pair, count = np.unique(seq[where] * fresh + seq[where + 1], return_inverse=True, return_counts=True)
        rank = np.zeros(len(count), np.int64)
        rank[np.lexsort((rng.permutation(len(count)), count))] = np.arange(1, len(count) + 1)
        ranks = np.zeros(len(seq), np.int64)
        ranks[where] = np.where(count > 1, rank, 0)[pair]
        places = np.flatnonzero(_local_maxima(ranks))
        if not len(places):
            break
        _, names = np.unique(ranks[places], return_inverse=True)
        open_ = ranks > 0
        first = fresh
        names = names + fresh
        fresh = int(names.max()) + 1
        stay = np.ones(len(seq), bool)
        stay[places + 1] = False
        replace(places, names)
        open_ = open_[stay]
        made = seq >= first
        open_ |= made
        open_[:-1] |= made[1:]
    while True:  # what is left becomes a balanced tree
        own = text[at[:-1]]
        begin = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
        place = np.arange(len(seq))
        even = (place - np.maximum.accumulate(np.where(begin, place, 0))) % 2 == 0
        places = np.flatnonzero(even[:-1] & ~begin[1:])
        if not len(places):
            break
        names = fresh + np.arange(len(places))
        fresh += len(places)
        replace(places, names)
    if not nodes:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(c) for c in zip(*nodes, strict=True))


class Blocks:
    """Exact names of all blocks of 2**k symbols, by which agreements are measured."""

    def __init__(self, symbols: np.ndarray):
        self.names = [symbols]
        for k in range(LEVELS):
            half = self.names[-1]
            if len(half) <= 1 << k:
                break
            whole = _named(half[: -(1 << k)], half[1 << k :])
            self.names.append(whole.astype(np.int32))
            if len(whole) == 0 or whole.max() + 1 == len(whole):  # no two agree
                break

    def agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols agree from ``a`` and ``b`` on, or before them, at most ``most``."""
        out, left, last = np.zeros(len(a), np.int64), most.copy(), len(self.names) - 1
        for k in [last, *range(last, -1, -1)]:
            names, size = self.names[k], 1 << k
            todo = np.flatnonzero(left >= size)
            while len(todo):
                x, y = (v[todo] - out[todo] - size if back else v[todo] + out[todo] for v in (a, b))
                todo = todo[names[x] == names[y]]
                out[todo] += size
                left[todo] -= size
                todo = todo[left[todo] >= size] if k == last else todo[:0]
        return out


def _gram(least: int, repeats: int) -> int:
    """Words beside a boundary that surely occur again a period away, on the side with half of the run."""
    return min(math.ceil(max(least, repeats * q) / 2) - q for q in range(1, least + 2))


def across(
    symbols: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, least: int, repeats: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(node, start, end, period) of the runs within [start, end) that meet the boundary at ``middle``."""
    size, n = _gram(least, repeats), len(symbols)
    if n < least or not len(start):
        return
    gram = symbols[: n - size + 1]
    for k in range(1, size):
        gram = _named(gram, symbols[k : n - size + 1 + k])
    key = np.sort(gram * np.int64(n) + np.arange(len(gram)))
    most = (end - start) // repeats
    tries = []
    # The words behind the boundary again further on, or those before it further back.
    for anchor, low, high in (
        (middle, middle + 1, np.minimum(end - size, middle + most)),
        (middle - size, np.maximum(start, middle - size - most), middle - size - 1),
    ):
        fit = np.flatnonzero((high >= low) & (anchor >= start) & (anchor + size <= end))
        name = gram[anchor[fit]] * np.int64(n)
        first = np.searchsorted(key, name + low[fit], "left")
        count = np.searchsorted(key, name + high[fit], "right") - first
        some = count > 0
        tries.append((fit[some], first[some], count[some], anchor[fit[some]]))
    if not any(len(t[0]) for t in tries):
        return
    blocks = Blocks(symbols)
    for nodes, first, count, anchor in tries:
        cut = np.searchsorted(np.cumsum(count), np.arange(0, count.sum() + CHUNK_TRIES, CHUNK_TRIES), "left")
        for lo, hi in zip(cut, [*cut[1:], len(nodes)], strict=True):
            if lo == hi:
                continue
            each = count[lo:hi]
            node = np.repeat(nodes[lo:hi], each)
            offset = np.arange(len(node)) - np.repeat(np.cumsum(each) - each, each)
            other = key[np.repeat(first[lo:hi], each) + offset] % n
            period = np.abs(other - np.repeat(anchor[lo:hi], each))
            x = np.where(other > np.repeat(anchor[lo:hi], each), middle[node], middle[node] - period)
            far = blocks.agree(x, x + period, end[node] - x - period)
            near = blocks.agree(x, x + period, x - start[node], back=True)
            low, high = x - near, x + period + far
            good = high - low >= np.maximum(least, repeats * period)
            yield node[good], low[good], high[good], period[good]


def runs_of(words: np.ndarray, text: np.ndarray, least: int = 24, repeats: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of the texts, in order of start, then period; places count through all texts."""
    if repeats < 3 or _gram(least, repeats) < 1:
        raise ValueError("runs need at least 3 periods and 2 words")
    symbols = _named(text, words) if len(words) else words
    symbol, start, middle, end = derivation(symbols, text)
    long = end - start >= least
    symbol, start, middle, end = symbol[long], start[long], middle[long], end[long]
    _, once = np.unique(symbol, return_index=True)
    found = list(across(symbols, start[once], middle[once], end[once], least, repeats))
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    node, low, high, period = (np.concatenate(c) for c in zip(*found, strict=True))
    # Of periods of one stretch the smallest is its own.
    order = np.lexsort((period, high, low, node))
    node, low, high, period = node[order], low[order], high[order], period[order]
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    node, low, high, period = node[new], low[new], high[new], period[new]
    # Every position that derives the nonterminal has its runs.
    by_symbol = np.argsort(symbol, kind="stable")
    sorted_ = symbol[by_symbol]
    first = np.searchsorted(sorted_, symbol[once][node], "left")
    count = np.searchsorted(sorted_, symbol[once][node], "right") - first
    places = start[by_symbol[np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]]
    shift = places - np.repeat(start[once][node], count)
    low, high, period = np.repeat(low, count) + shift, np.repeat(high, count) + shift, np.repeat(period, count)
    # A piece of a run lies within it; pieces of one period that share a period's words are one run.
    order = np.lexsort((-high, low, period))
    low, high, period = low[order], high[order], period[order]
    reach = period * np.int64(len(words) + 1) + high
    new = np.ones(len(low), bool)
    new[1:] = reach[1:] > np.maximum.accumulate(reach)[:-1]
    low, high, period = low[new], high[new], period[new]
    order = np.lexsort((period, low))
    return low[order], high[order], period[order]


def _collapsed(n: int, low: np.ndarray, high: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words stays: no run has it after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, low + period, 1)
    np.add.at(edge, high, -1)
    return np.cumsum(edge[:-1]) == 0


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 24, repeats: int = 3
) -> DataFrame:
    """(id, n_words, runs, collapsed): every row's runs (start, length, period) and its text without their repeats.

    ``collapsed`` has the words that no run holds after its first period, joined by one space.
    """
    texts = keyed(docs, id_col, text_col)
    kind = texts.schema["_id"].dataType.simpleString()
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def find(batches):
        for batch in batches:
            column, rows, at, size = batch.column("_text"), [], 0, 0
            for k in range(len(column)):
                rows.append(column[k].as_py().encode().split())
                size += len(rows[-1])
                if size >= CHUNK_WORDS or k == len(column) - 1:
                    yield build(batch.column("_id").slice(at, len(rows)), rows)
                    at, size, rows = at + len(rows), 0, []

    def build(ids, rows):
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        words = pa.array(list(chain.from_iterable(rows)), pa.large_binary()).dictionary_encode().indices.to_numpy()
        low, high, period = runs_of(words, np.repeat(np.arange(len(rows)), counts), least, repeats)
        ends = np.cumsum(counts)
        begins = ends - counts
        whose = np.searchsorted(ends, low, "right")
        bounds = np.searchsorted(whose, np.arange(len(rows) + 1))
        texts_ = []
        for i, own in enumerate(rows):
            a, b = bounds[i], bounds[i + 1]
            if a < b:
                stay = _collapsed(len(own), low[a:b] - begins[i], high[a:b] - begins[i], period[a:b])
                own = [own[j] for j in np.flatnonzero(stay)]
            texts_.append(b" ".join(own).decode())
        found = pa.StructArray.from_arrays(
            [pa.array(low - begins[whose]), pa.array(high - low), pa.array(period)], fields=list(run_type)
        )
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), found), pa.array(texts_, pa.string())],
            names=["_id", "n_words", "runs", "collapsed"],
        )

    found = texts.mapInArrow(find, f"_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string")
    return found.select(F.col("_id").alias(id_col), "n_words", "runs", "collapsed")
