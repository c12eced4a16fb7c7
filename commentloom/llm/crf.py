"""A linear-chain conditional random field over the words of a text, in numpy.

A word's potentials come from its character n-grams between boundary marks (those at a mark are its affixes),
hashed into ``2**HASH_BITS`` rows of weights, and from a lexicon of words frequent in one label;
transitions between the labels of neighbouring words are learned with them.  Training maximises the
likelihood of labelled sequences by forward-backward and Adagrad; labelling uses the same recursions on many texts
at a time: texts are cut into blocks, each block's transfer matrix is computed for all blocks at once, messages
run over blocks, and then inside every block.  Blocks change nothing in the result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np

HASH_BITS = 18
GRAMS = (1, 2, 3, 4)
BLOCK = 256
RESCALE = 6  # steps between rescalings; potentials are cut at 30 below a word's best
WORD = re.compile(r"[^\W\d_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(w[0].isalpha() or any(map(str.isalpha, w)) for w in words)


def _coded(words: list[str]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """All letters between boundary marks, each word's count of them, and by length the n-grams' places and hashed rows."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    flat = np.frombuffer(("\2" + "\3\2".join(words) + "\3").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))
    code, codes = np.zeros(len(flat), np.uint64), []
    for n in GRAMS:
        code = (code[: len(flat) - n + 1] ^ flat[n - 1 :]) * _MULTIPLIER
        code ^= code >> np.uint64(29)
        at = np.flatnonzero(left[: len(code)] >= n)
        codes.append((at, (code[at] >> np.uint64(64 - HASH_BITS)).astype(np.int64)))
    return flat, sizes, codes


def _grams_in(sizes: np.ndarray) -> np.ndarray:
    return sum(np.maximum(sizes - n + 1, 0) for n in GRAMS)


def gram_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words, and how many each word has; the words' n-grams follow one another."""
    flat, sizes, codes = _coded(words)
    owner = np.repeat(np.arange(len(words)), sizes)
    owners = np.concatenate([owner[at] for at, _ in codes])
    return np.concatenate([rows for _, rows in codes])[np.argsort(owners, kind="stable")], _grams_in(sizes)


@dataclass
class Model:
    labels: list[str]
    lexicon: dict[str, int] = field(default_factory=dict)
    grams: np.ndarray = None
    words: np.ndarray = None
    moves: np.ndarray = None

    @classmethod
    def blank(cls, labels: list[str], lexicon: dict[str, int]) -> Model:
        n = len(labels)
        return cls(labels, lexicon, np.zeros((1 << HASH_BITS, n), np.float32), np.zeros((len(lexicon) + 1, n), np.float32), np.zeros((n, n)))

    def potentials(self, words: list[str]) -> np.ndarray:
        """Words by labels; the last row of ``words`` stands for words outside the lexicon and stays zero."""
        flat, sizes, codes = _coded(words)
        summed = np.zeros((len(flat), len(self.labels)), np.float32)
        for at, rows in codes:
            summed[at] += self.grams[rows]
        starts = np.cumsum(sizes) - sizes
        known = np.fromiter((self.lexicon.get(w, len(self.lexicon)) for w in words), np.int64, len(words))
        return np.add.reduceat(summed, starts, axis=0) / np.sqrt(_grams_in(sizes))[:, None] + self.words[known]


def train(model: Model, sequences: list[tuple[list[str], np.ndarray]], rounds: int = 3, batch: int = 64, rate: float = 0.5, seed: int = 5) -> Model:
    """Fits ``model`` to sequences of one length (words, label numbers)."""
    rng = np.random.default_rng(seed)
    seen = [np.full(p.shape, 1e-2, np.float64) for p in (model.grams, model.words, model.moves)]
    for _ in range(rounds):
        order = rng.permutation(len(sequences))
        for at in range(0, len(order), batch):
            part = [sequences[i] for i in order[at : at + batch]]
            _step(model, seen, [w for s, _ in part for w in s], np.stack([y for _, y in part]), rate)
    return model


def _step(model: Model, seen: list[np.ndarray], words: list[str], gold: np.ndarray, rate: float) -> None:
    n, steps = gold.shape
    count = len(model.labels)
    rows, sizes = gram_rows(words)
    starts, scale = np.cumsum(sizes) - sizes, 1 / np.sqrt(sizes)
    known = np.fromiter((model.lexicon.get(w, len(model.lexicon)) for w in words), np.int64, len(words))
    raw = np.add.reduceat(model.grams[rows], starts, axis=0) * scale[:, None] + model.words[known]
    e = np.exp(raw - raw.max(axis=1, keepdims=True)).reshape(n, steps, count)
    a_moves = np.exp(model.moves)
    ahead, back = np.zeros((steps, n, count)), np.ones((steps, n, count))
    message = np.full((n, count), 1 / count)
    for t in range(steps):
        message = (message @ a_moves) * e[:, t]
        message /= message.sum(axis=1, keepdims=True)
        ahead[t] = message
    for t in range(steps - 1, 0, -1):
        message = (e[:, t] * back[t]) @ a_moves.T
        back[t - 1] = message / message.sum(axis=1, keepdims=True)
    marginal = ahead * back
    marginal /= marginal.sum(axis=2, keepdims=True)
    error = marginal.transpose(1, 0, 2).reshape(-1, count).copy()
    error[np.arange(len(error)), gold.reshape(-1)] -= 1
    moved = np.zeros((count, count))
    for t in range(1, steps):
        pair = ahead[t - 1][:, :, None] * a_moves[None] * (e[:, t] * back[t])[:, None, :]
        moved += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    np.add.at(moved, (gold[:, :-1].reshape(-1), gold[:, 1:].reshape(-1)), -1)
    spread = np.repeat(error * scale[:, None], sizes, axis=0)
    for weights, where, change, past in ((model.grams, rows, spread, seen[0]), (model.words, known, error, seen[1])):
        hit, inverse = np.unique(where, return_inverse=True)
        slope = np.stack([np.bincount(inverse, change[:, k], len(hit)) for k in range(count)], axis=1) / n
        past[hit] += slope**2
        weights[hit] -= (rate * slope / np.sqrt(past[hit])).astype(np.float32)
    model.words[-1] = 0
    moved /= n
    seen[2] += moved**2
    model.moves -= rate * moved / np.sqrt(seen[2])


def marginals(model: Model, potentials: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of texts that follow one another in ``potentials``; no text is empty."""
    count = potentials.shape[1]
    e = np.exp(np.maximum(potentials - potentials.max(axis=1, keepdims=True), -30.0)).astype(np.float64)
    moves = np.exp(np.maximum(model.moves - model.moves.max(), -30.0))
    blocks = -(-lengths // BLOCK)
    starts = np.cumsum(lengths) - lengths
    text = np.repeat(np.arange(len(lengths)), blocks)
    place = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    begin = starts[text] + place * BLOCK
    size = np.minimum(lengths[text] - place * BLOCK, BLOCK)
    order = np.argsort(-size, kind="stable")  # at a step the blocks that are still running come first
    begin, size, text, place = begin[order], size[order], text[order], place[order]
    running = np.searchsorted(-size, -np.arange(BLOCK), "left")
    steps = int(size[0])
    where = np.minimum(begin + np.arange(steps)[:, None], len(e) - 1)
    by_step = e[where]
    enter, leave = np.full((len(size), count), 1 / count), np.ones((len(size), count))
    if int(blocks.max()) > 1:
        _exchange(by_step, moves, running, blocks, text, place, enter, leave)
    ahead = np.empty_like(by_step)
    message = enter
    for t in range(steps):
        m = running[t]
        message = np.multiply(message[:m] @ moves, by_step[t, :m], out=ahead[t, :m])
        if t % RESCALE == 0:
            message /= message.sum(axis=1, keepdims=True)
    message, back = leave, moves.T.copy()
    for t in range(steps - 1, -1, -1):
        m = running[t]
        now = message[:m]
        ahead[t, :m] *= now
        now = (by_step[t, :m] * now) @ back
        if t % RESCALE == 0:
            now /= now.sum(axis=1, keepdims=True)
        message[:m] = now
    inside = np.arange(steps)[:, None] < size
    out = np.empty_like(e)
    out[where[inside]] = ahead[inside]
    return out / out.sum(axis=1, keepdims=True)


def _exchange(by_step, moves, running, blocks, text, place, enter, leave) -> None:
    """Sends the messages over the blocks of each text: what enters a block from the left, and from the right."""
    count = by_step.shape[2]
    several = blocks[text] > 1
    slot = np.cumsum(several) - 1  # among the blocks of texts of several blocks, in the same order
    transfer = np.broadcast_to(np.eye(count), (int(several.sum()), count, count)).copy()
    upto = np.concatenate([[0], np.cumsum(several)])
    pick = np.flatnonzero(several)
    for t in range(len(by_step)):
        m = upto[running[t]]
        step = (transfer[:m].reshape(-1, count) @ moves).reshape(m, count, count)
        step *= by_step[t, pick[:m], None, :]
        if t % RESCALE == 0:
            step /= step.max(axis=(1, 2), keepdims=True)
        transfer[:m] = step
    row_of = np.empty((len(blocks), int(blocks.max())), np.int64)
    row_of[text, place] = np.arange(len(text))
    for k in range(1, int(blocks.max())):
        on = np.flatnonzero(blocks > k)
        now, before = row_of[on, k], row_of[on, k - 1]
        message = np.einsum("nj,njk->nk", enter[before], transfer[slot[before]])
        enter[now] = message / message.sum(axis=1, keepdims=True)
    for k in range(int(blocks.max()) - 1, 0, -1):
        on = np.flatnonzero(blocks > k)
        now, before = row_of[on, k], row_of[on, k - 1]
        message = np.einsum("njk,nk->nj", transfer[slot[now]], leave[now])
        leave[before] = message / message.sum(axis=1, keepdims=True)
