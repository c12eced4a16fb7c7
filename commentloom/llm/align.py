"""Alignment of two tokenizers' tokens over whole texts, and how often id pairs are linked in the corpus.

A is a byte-level tokenizer of ``tokenizers``, B a sentencepiece model that adds a space in front; both see space + text.
A text is cut into units before every space that stands between two characters that are no white space: neither
tokenizer's tokens cross such a place, and what stands before it does not change what follows (a test compares with whole
texts).  A distinct unit is aligned once, and a worker keeps up to ``CACHE_SIZE`` of them, when there are more those that it met again.

Within a unit, A's character offsets and the spans of B's proto give coarse cuts: places where a token of either ends
and the next begins.  Only between coarse cuts that enclose a token whose offsets do not tell where its bytes end (part
of a character, a byte-fallback token, the space that B adds) the bytes of the entries are decoded, and the byte
offsets at which tokens of both end cut further.  A unit whose decoded bytes differ from its own leaves its text without tokens.

Counts are pre-aggregated: a chunk of texts makes one row with its distinct id pairs and the number of its texts that link
each, and a short row per text with the pairs that it links and how often, as bytes.  Chunks' counts are summed per pair, an
id's highest count is taken, and both go back to the chunks' pairs, not to every text's; so a pair that all texts share costs
a row per chunk.  Chunks' pairs and texts then meet sorted by chunk, and a worker holds the counts of one chunk at a time.
Nothing of the corpus' pairs is broadcast or collected.

A worker's memory does not grow with the table: units are encoded ``SLICE`` at a time in the worker's own thread, texts
come in batches of ``BATCH_BYTES``, and what a chunk took is given back before the next.

Null and empty texts have no tokens.  Repeated rows are texts of their own; null ids are kept row by row.  An empty table
gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.common import give_back, keyed, numbered, setting, stored, summed, worker_state

CACHE_SIZE = 350_000
CHUNK_CHARS = 1_500_000  # characters of a chunk, besides one text's own
SLICE = 10_000  # new units that the libraries see at a time
BATCH_BYTES = "4m"  # of texts that go to a worker at a time, besides one text's own
BLOCK_BYTES = 16 << 20  # of chunks that a writer holds
B_BITS = 16  # bits of a pair's code that hold the B id
# A space with another character than white space on both sides; some code points count as white space to be safe.
_GAP = "\\s\u180e\u200b\u2060\ufeff\x1c-\x1f"
_CUT = re.compile(f"(?<=[^{_GAP}]) (?=[^{_GAP}])")
_SPACE = "▁"
# A unit that neither begins nor ends with white space and holds no character that B would read as a space.
_PLAIN = re.compile(f"[^{_GAP}{_SPACE}](?:[^{_SPACE}]*[^{_GAP}{_SPACE}])?\\Z")
TOGETHER = 200


def units_of(text: str) -> list[str]:
    """The text in units, each without its first space."""
    return _CUT.split(text)


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in own}
    others = [b for b in range(256) if chr(b) not in letters]
    return letters | {chr(0x100 + i): b for i, b in enumerate(others)}


class Pair:
    """Both tokenizers, the bytes of their entries, and a cache of aligned units."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core, and each thread keeps memory of its own
        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=path_b)
        letters = _byte_letters()
        entries = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(letters[c] for c in e) if all(c in letters for c in e) else e.encode() for e in entries]
        if max(len(entries), self.b.get_piece_size()) > 1 << B_BITS:
            raise ValueError(f"a tokenizer has more than {1 << B_BITS} entries")
        pieces = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if f else p.replace(_SPACE, " ").encode() for p, f in pieces]
        self.size_a, self.size_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.places: dict[str, int] = {}
        self.known = self.aligned([])
        self.used = np.zeros(0, bool)  # whether a kept unit was met again

    def align(self, units: list[str]) -> tuple[Block, np.ndarray]:
        """A block of the distinct ``units``, and the place of each in it."""
        kept = list(map(self.places.get, units))
        held = np.array([x for x in kept if x is not None], np.int64)
        fresh = [u for u, x in zip(units, kept, strict=True) if x is None]
        self.used[held] = True
        parts = [self.aligned(fresh[i : i + SLICE]) for i in range(0, len(fresh), SLICE)]
        block = _joined([_taken(self.known, held), *parts])
        is_fresh = np.array([x is None for x in kept], bool)
        places = np.where(is_fresh, len(held) + np.cumsum(is_fresh) - 1, np.cumsum(~is_fresh) - 1)
        short = [i for i, u in enumerate(fresh) if len(u) <= 48]
        self.places.update((fresh[i], place) for place, i in enumerate(short, len(self.used)))
        self.known = _joined([self.known, _taken(block, len(held) + np.array(short, np.int64))])
        self.used = np.concatenate([self.used, np.zeros(len(short), bool)])
        if len(self.used) > CACHE_SIZE:  # what was met once goes
            names = [u for u, place in self.places.items() if self.used[place]][: CACHE_SIZE // 2]
            self.known = _taken(self.known, np.array([self.places[u] for u in names], np.int64))
            self.places = {u: place for place, u in enumerate(names)}
            self.used = np.zeros(len(names), bool)
        return block, places

    def aligned(self, units: list[str], alone: bool = False) -> Block:
        """The units' groups and links.  The libraries see up to ``TOGETHER`` units at a time as one text, unless ``alone``."""
        texts, n_units = _together(units, 1 if alone else TOGETHER)
        raws = [b" " + t.encode() for t in texts]
        whole, sizes = b"".join(raws), np.fromiter(map(len, raws), np.int64, len(raws))
        bases = np.cumsum(sizes) - sizes
        encoded_a = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False) if texts else []
        encoded_b = [x.pieces for x in self.b.encode(texts, return_type="proto", num_threads=1)] if texts else []
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(texts)) for x in (encoded_a, encoded_b))
        # A's offsets count characters: the byte at which each character of all texts begins.
        begins = np.flatnonzero(np.frombuffer(whole + b" ", np.uint8) & 0xC0 != 0x80)
        first = np.repeat(np.searchsorted(begins, bases), n_a)
        spans = _flat(chain.from_iterable(x.offsets) for x in encoded_a).reshape(-1, 2)
        a = _Tokens(_flat(x.ids for x in encoded_a), n_a, self.size_a, begins[first + spans[:, 0]], begins[first + spans[:, 1]])
        # B's spans count bytes behind the space that it adds.
        low, high = (_flat([getattr(p, c) for p in x] for x in encoded_b) + np.repeat(bases + 1, n_b) for c in ("begin", "end"))
        low[(np.cumsum(n_b) - n_b)[n_b > 0]] = bases[n_b > 0]
        b = _Tokens(_flat([p.id for p in x] for x in encoded_b), n_b, self.size_b, low, high)
        good = self._same(a, self.bytes_a, raws, whole) & self._same(b, self.bytes_b, raws, whole)
        if (n_units[~good] > 1).any():
            return self.aligned(units, alone=True)
        if not good.all():
            good = np.repeat(good, n_units)
            return _spread(self.aligned([u for u, g in zip(units, good, strict=True) if g], alone), good)
        return _block(a, b, np.cumsum(np.fromiter((len(u.encode()) + 1 for u in units), np.int64, len(units))))

    def _same(self, tokens: _Tokens, entries: list[bytes], raws: list[bytes], whole: bytes) -> np.ndarray:
        """Whether each text is what its tokens' entries decode to."""
        stops = np.cumsum(tokens.counts)
        parts = list(map(entries.__getitem__, tokens.ids.tolist()))
        decoded = summed(tokens.sizes, tokens.counts)
        if b"".join(parts) == whole and decoded.tolist() == list(map(len, raws)):
            return np.ones(len(raws), bool)
        return np.array([b"".join(parts[e - n : e]) == r for e, n, r in zip(stops, tokens.counts, raws, strict=True)], bool)


def _together(units: list[str], most: int) -> tuple[list[str], np.ndarray]:
    """The units in texts of at most ``most``, joined by a space where a cut would part them again, and the number in each."""
    texts, counts, own, open_ = [], [], [], False
    for unit in units:
        plain = _PLAIN.match(unit) is not None
        if own and (not plain or not open_ or len(own) == most):
            texts.append(" ".join(own))
            counts.append(len(own))
            own = []
        own.append(unit)
        open_ = plain
    if own:
        texts.append(" ".join(own))
        counts.append(len(own))
    return texts, np.array(counts, np.int64)


class _Tokens:
    """The tokens of many texts: ids, how many each text has, bytes of their entries, and the offsets that the library gives."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, table: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.ids, self.counts, self.sizes, self.high = ids, counts, table[ids], high
        # Tokens that share a character have offsets that overlap, or no width but the last of them.
        following = np.append(low[1:], high[-1:])
        self.sure = (low < high) & (following == high)


class Block(NamedTuple):
    """Aligned units: A tokens, B tokens, groups and links of each, groups as text, whether its bytes agree, and the codes of all links."""

    counts: np.ndarray
    shown: pa.LargeStringArray
    good: np.ndarray
    codes: np.ndarray


def _flat(lists: Iterable) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64)


def _joined(blocks: list[Block]) -> Block:
    counts, shown, good, codes = zip(*blocks, strict=True)
    return Block(np.concatenate(counts, axis=1), pa.concat_arrays(shown), np.concatenate(good), np.concatenate(codes))


def _taken(block: Block, places: np.ndarray) -> Block:
    """The units at ``places``."""
    each = block.counts[3].astype(np.int64)
    begin = np.cumsum(each) - each
    own = each[places]
    inner = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
    codes = block.codes[np.repeat(begin[places], own) + inner]
    return Block(block.counts[:, places], block.shown.take(pa.array(places)), block.good[places], codes)


def _spread(part: Block, good: np.ndarray) -> Block:
    """The block of all units when ``part`` has the good ones."""
    counts = np.zeros((4, len(good)), np.int32)
    counts[:, good] = part.counts
    place = np.where(good, np.cumsum(good) - 1, -1)
    return Block(counts, pc.fill_null(part.shown.take(pa.array(place, mask=~good)), ""), good, part.codes)


def _cuts(at_a: np.ndarray, count_a: np.ndarray, at_b: np.ndarray, count_b: np.ndarray) -> np.ndarray:
    """(offset, A tokens before it, B tokens before it) of the offsets on both sides."""
    at, x, y = np.intersect1d(at_a, at_b, assume_unique=True, return_indices=True)
    return np.stack([at, count_a[x], count_b[y]])


def _groups(cuts: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(end offset, first A token, A tokens, first B token, B tokens) of the groups between cuts."""
    all_ = np.concatenate(cuts, axis=1)
    _, keep = np.unique(all_[0], return_index=True)
    end, to_a, to_b = all_[:, keep]
    n_a, n_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    return end, to_a - n_a, n_a, to_b - n_b, n_b


def _block(a: _Tokens, b: _Tokens, ends: np.ndarray) -> Block:
    """Groups and links of units that end at the bytes ``ends`` and whose bytes agree, all at once."""
    sure_a, sure_b = np.flatnonzero(a.sure), np.flatnonzero(b.sure)
    to_a, to_b = (np.searchsorted(np.cumsum(t.sizes), ends, "right") for t in (a, b))
    cuts = [np.stack([ends, to_a, to_b]), _cuts(a.high[sure_a], sure_a + 1, b.high[sure_b], sure_b + 1)]
    _, from_a, in_a, from_b, in_b = _groups(cuts)
    vague = np.zeros(len(in_a), bool)
    for tokens, first, n in ((a, from_a, in_a), (b, from_b, in_b)):
        upto = np.concatenate([[0], np.cumsum(tokens.sure)])
        vague |= upto[first + n] - upto[first] != n
    if vague.any():
        # Between these cuts the entries' own bytes tell where tokens end.
        fine_a, fine_b = np.flatnonzero(np.repeat(vague, in_a)), np.flatnonzero(np.repeat(vague, in_b))
        cuts.append(_cuts(np.cumsum(a.sizes)[fine_a], fine_a + 1, np.cumsum(b.sizes)[fine_b], fine_b + 1))
    end, from_a, in_a, from_b, in_b = _groups(cuts)
    each = in_a * in_b
    total = int(each.sum())
    group = np.repeat(np.arange(len(each)), each)
    inner = np.arange(total) - np.repeat(np.cumsum(each) - each, each)
    codes = a.ids[from_a[group] + inner // in_b[group]] << B_BITS | b.ids[from_b[group] + inner % in_b[group]]
    codes = codes.astype(np.uint32)
    per_unit = np.diff(np.searchsorted(end, ends, "right"), prepend=0)
    sides = [_strings(pa.array(t.ids).cast(pa.large_string()), n, ",") for t, n in ((a, in_a), (b, in_b))]
    shown = _strings(pc.binary_join_element_wise(*sides, pa.scalar("|", pa.large_string())), per_unit, ";")
    counts = np.stack([np.diff(to_a, prepend=0), np.diff(to_b, prepend=0), per_unit, summed(each, per_unit)]).astype(np.int32)
    return Block(counts, shown, np.ones(len(ends), bool), codes)


def _strings(pieces: pa.LargeStringArray, counts: np.ndarray, mark: str) -> pa.LargeStringArray:
    """Runs of ``pieces`` joined by ``mark``."""
    bounds = pa.array(np.concatenate([[0], np.cumsum(counts)]))
    return pc.binary_join(pa.LargeListArray.from_arrays(bounds, pieces), pa.scalar(mark, pa.large_string()))


def pair_for(path_a: str, path_b: str) -> Pair:
    state = worker_state("align")
    if (path_a, path_b) not in state:
        state[path_a, path_b] = Pair(path_a, path_b)
    return state[path_a, path_b]


def _narrow(n: int) -> np.dtype:
    """The narrowest type that holds 0 to ``n``."""
    return np.min_scalar_type(max(0, int(n)))


def _blobs(values: np.ndarray, bounds: np.ndarray, kind: np.dtype) -> pa.BinaryArray:
    """The bytes of each run of ``values``."""
    raw = values.astype(kind)
    offsets = (bounds * raw.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def _bytes(blobs: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the blobs, and how many each has."""
    _, offsets, data = blobs.buffers()
    at = np.frombuffer(offsets, np.int32)[blobs.offset : blobs.offset + len(blobs) + 1]
    return np.frombuffer(data or b"", np.uint8)[at[0] : at[-1]], np.diff(at)


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", groups: bool = False) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row, with ``groups`` also the groups as text.

    A pair's count is the number of rows that link it; ``n_best`` counts links whose pair has its A id's
    highest count, ``count_sum`` adds the counts over the links.
    """
    texts = keyed(docs, id_col, text_col)
    kind = texts.schema["_id"].dataType.simpleString()

    def run(batches):
        pair, serial, ids, rows, size = pair_for(path_a, path_b), 0, [], [], 0
        for batch in batches:
            column, at = batch.column("_text"), 0
            for k in range(len(column)):
                text = column[k].as_py()
                rows.append(units_of(text) if text else [])
                size += len(text)
                if size >= CHUNK_CHARS:
                    ids.append(batch.column("_id").slice(at, k + 1 - at))
                    yield from build(pair, TaskContext.get().partitionId() << 32 | serial, pa.concat_arrays(ids), rows)
                    give_back()
                    at, ids, rows, size, serial = k + 1, [], [], 0, serial + 1
            ids.append(batch.column("_id").slice(at))
        if rows:
            yield from build(pair, TaskContext.get().partitionId() << 32 | serial, pa.concat_arrays(ids), rows)
            give_back()

    def build(pair, chunk, ids, rows):
        distinct, numbers, lengths = numbered(rows)
        block, places = pair.align(distinct)
        numbers = places[numbers]
        whose = np.repeat(np.arange(len(rows)), lengths)
        bad = np.unique(whose[~block.good[numbers]])
        if len(bad):  # such texts have no units left
            stay = ~np.isin(whose, bad)
            numbers, whose = numbers[stay], whose[stay]
            lengths = lengths.copy()
            lengths[bad] = 0
        counts = [pa.array(summed(c[numbers].astype(np.int64), lengths)) for c in block.counts]
        strings = _strings(block.shown.take(pa.array(numbers)), lengths, ";")
        shas = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in (x.as_py() for x in strings)]
        # Which pairs each text links, and how often.
        each = block.counts[3].astype(np.int64)
        begin = np.cumsum(each) - each
        many = each[numbers]
        inner = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pairs, slot = np.unique(block.codes[np.repeat(begin[numbers], many) + inner], return_inverse=True)
        key, times = np.unique(np.repeat(whose, many) * np.int64(max(1, len(pairs))) + slot, return_counts=True)
        doc, own = np.divmod(key, max(1, len(pairs)))
        held = np.bincount(own, minlength=len(pairs))
        bounds = np.searchsorted(doc, np.arange(len(rows) + 1))
        blobs = [_blobs(own, bounds, _narrow(len(pairs))), _blobs(times, bounds, _narrow(times.max(initial=0)))]
        fields = [ids, *counts, pa.array(shas, pa.string()), *blobs] + [strings.cast(pa.string())] * groups
        listed = lambda x: pa.array([x.astype(np.int64)])
        no_text = pa.nulls(1, pa.struct([(n, x.type) for n, x in zip(names, fields, strict=True)]))
        no_pairs = pa.nulls(len(rows), pa.list_(pa.int64()))
        yield row_batch(chunk, listed(pairs), listed(held), no_text)
        yield row_batch(chunk, no_pairs, no_pairs, pa.StructArray.from_arrays(fields, names=names))

    def row_batch(chunk, *columns):
        chunks = pa.array(np.full(len(columns[0]), chunk, np.int64))
        return pa.RecordBatch.from_arrays([chunks, *columns], names=["chunk", "pairs", "held", "doc"])

    def sums(batches):
        worker_state("align_sums")  # the tokenizers and what they left are not needed any more
        give_back()
        at, known, best = None, [], None
        for batch in batches:
            chunk, slot = batch.column("chunk").to_numpy(), batch.column("slot")
            packed = pc.fill_null(batch.column("packed"), 0).to_numpy()
            is_text = slot.is_null().to_numpy(zero_copy_only=False)
            cuts = (np.flatnonzero((chunk[1:] != chunk[:-1]) | (is_text[1:] != is_text[:-1])) + 1).tolist()
            for begin, end in zip([0, *cuts], [*cuts, len(chunk)], strict=True):
                if begin == end:  # an empty batch
                    continue
                if chunk[begin] != at:
                    at, known, best = chunk[begin], [], None
                if not is_text[begin]:  # a chunk's pairs come before its texts, in the order of their slots
                    known.append(packed[begin:end])
                    continue
                if best is None:
                    known = np.concatenate([np.zeros(0, np.int64), *known])
                    known, best = known >> 1, known & 1
                fields = dict(zip(names, batch.column("doc").slice(begin, end - begin).flatten(), strict=True))
                (own, sizes), (times, _) = _bytes(fields.pop("own")), _bytes(fields.pop("times"))
                width = _narrow(len(known))
                own = own.view(width)
                times = times.view(f"u{max(1, len(times) // max(1, len(own)))}").astype(np.int64)
                for name, x in (("n_best", best), ("count_sum", known)):
                    fields[name] = pa.array(summed(x[own] * times, sizes // width.itemsize))
                yield pa.RecordBatch.from_arrays([fields[c] for c in shown], names=shown)

    names = ["_id", *_COUNTS, "groups_sha256", "own", "times"] + ["groups"] * groups
    kinds = [kind, *["bigint"] * 4, "string", "binary", "binary"] + ["string"] * groups
    doc = f"struct<{','.join(f'{n}:{k}' for n, k in zip(names, kinds, strict=True))}>"
    schema = f"chunk bigint, pairs array<bigint>, held array<bigint>, doc {doc}"
    shown = ["_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"] + ["groups"] * groups
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        chunks, _ = stored(texts.mapInArrow(run, schema), "chunks", **{"parquet.block.size": BLOCK_BYTES})
    counts, _ = stored(pair_counts(chunks), "pairs")
    packed = F.shiftleft("n", 1) + F.col("best").cast("bigint")
    placed = chunks.select("chunk", F.posexplode("pairs").alias("slot", "pair")).join(counts, "pair")
    placed = placed.select("chunk", "slot", packed.alias("packed"), F.lit(None).cast(doc).alias("doc"))
    rows = chunks.filter("pairs IS NULL").select("chunk", F.lit(None).cast("int").alias("slot"), F.lit(None).cast("bigint").alias("packed"), "doc")
    met = placed.union(rows).repartition("chunk").sortWithinPartitions("chunk", F.asc_nulls_last("slot"))
    of = dict(zip(names, kinds, strict=True))
    out = met.mapInArrow(sums, ", ".join(f"`{c}` {of.get(c, 'bigint')}" for c in shown))
    return out.withColumnRenamed("_id", id_col)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, n, best): in how many texts each id pair is linked, and whether none of its A id's pairs has more."""
    held = chunks.select(F.explode(F.arrays_zip("pairs", "held")).alias("x")).select("x.pairs", "x.held")
    summed_ = held.groupBy(F.col("pairs").alias("pair")).agg(F.sum("held").alias("n"))
    a = F.shiftright("pair", B_BITS)
    most = summed_.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return summed_.join(most, F.shiftright("pair", B_BITS) == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
