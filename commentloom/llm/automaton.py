"""A minimal acyclic transducer: sorted words to their ordinal, states with equal futures shared.

Every arc carries the number of words that sort before those behind it, so the outputs along a word's path
sum to the word's ordinal, and the ordinal addresses the word's ids.  The compiled form is a handful of
flat arrays in one buffer, made to be memory-mapped.
"""

from __future__ import annotations

import struct

import numpy as np

_SHIFT = np.uint64(21)  # bits of a code point


def _minimal(words: list[str]) -> tuple[list[dict[int, int]], list[bool], int]:
    """States of the minimal automaton of sorted distinct words (Daciuk's incremental way)."""
    arcs: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    register: dict[tuple, int] = {}

    def settle(path: list[tuple[int, int]], keep: int) -> None:
        while len(path) > keep:
            parent, letter = path.pop()
            child = arcs[parent][letter]
            key = (final[child], tuple(arcs[child].items()))
            arcs[parent][letter] = register.setdefault(key, child)

    path: list[tuple[int, int]] = []
    last = ""
    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(path, common)
        state = arcs[path[-1][0]][path[-1][1]] if path else 0
        for letter in map(ord, word[common:]):
            arcs.append({})
            final.append(False)
            arcs[state][letter] = len(arcs) - 1
            path.append((state, letter))
            state = len(arcs) - 1
        final[state] = True
        last = word
    settle(path, 0)
    return arcs, final, 0


def compile_lexicon(entries: dict[str, list[int]]) -> bytes:
    """The automaton of ``entries`` (word to ids) as one buffer."""
    words = sorted(w for w in entries if w)
    arcs, final, _ = _minimal(words)
    below: dict[int, int] = {}
    order: list[int] = []
    stack = [(0, False)]
    while stack:  # states behind their targets, so counts add up without recursion
        state, done = stack.pop()
        if done:
            order.append(state)
            below[state] = final[state] + sum(below[t] for t in arcs[state].values())
        elif state not in below:
            below[state] = -1
            stack.append((state, True))
            stack.extend((t, False) for t in arcs[state].values() if t not in below)
    number = {s: i for i, s in enumerate(reversed(order))}  # the root is 0
    keys, targets, outs = [], [], []
    for state in reversed(order):
        before = int(final[state])
        for letter in sorted(arcs[state]):
            target = arcs[state][letter]
            keys.append(number[state] << int(_SHIFT) | letter)
            targets.append(number[target])
            outs.append(before)
            before += below[target]
    ids = [entries[w] for w in words]
    parts = [
        np.array(keys, np.uint64),
        np.array(targets, np.uint32),
        np.array(outs, np.uint32),
        np.array([final[s] for s in reversed(order)], np.uint8),
        np.cumsum([0, *map(len, ids)]).astype(np.uint32),
        np.array([i for x in ids for i in x], np.uint32),
    ]
    head = struct.pack("<6Q", *map(len, parts))
    return head + b"".join(x.tobytes() + b"\0" * (-x.nbytes % 8) for x in parts)


class Lexicon:
    """Lookups in a compiled buffer, many words at a time."""

    def __init__(self, buffer):
        sizes, at, parts = struct.unpack_from("<6Q", buffer), 48, []
        for n, kind in zip(sizes, (np.uint64, np.uint32, np.uint32, np.uint8, np.uint32, np.uint32), strict=True):
            parts.append(np.frombuffer(buffer, kind, n, at))
            at += -(-n * np.dtype(kind).itemsize // 8) * 8
        self.keys, self.targets, self.outs, self.final, self.starts, self.ids = parts

    def __len__(self) -> int:
        return len(self.starts) - 1

    def find(self, words: list[str]) -> np.ndarray:
        """Each word's ordinal, or -1."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        found = np.full(len(words), -1, np.int64)
        if not len(self.keys) or not len(words):
            return found
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        live = np.flatnonzero(lengths > 0)
        state = np.zeros(len(live), np.uint64)
        total = np.zeros(len(live), np.int64)
        step = 0
        while len(live):
            key = state << _SHIFT | letters[starts[live] + step].astype(np.uint64)
            arc = np.searchsorted(self.keys, key)
            arc[arc == len(self.keys)] = 0
            hit = self.keys[arc] == key
            live, arc, total = live[hit], arc[hit], total[hit]
            state = self.targets[arc].astype(np.uint64)
            total = total + self.outs[arc]
            step += 1
            ended = lengths[live] == step
            good = ended & (self.final[state.astype(np.int64)] == 1)
            found[live[good]] = total[good]
            live, state, total = live[~ended], state[~ended], total[~ended]
        return found

    def ids_of(self, ordinal: int) -> list[int]:
        return self.ids[self.starts[ordinal] : self.starts[ordinal + 1]].tolist()
