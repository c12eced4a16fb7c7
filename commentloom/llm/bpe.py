"""BPE encoding and decoding through a minimal acyclic transducer of frequent words.

Texts are cut into words as the tokenizer's file says (special strings, NFC, lower case, its split pattern).
The ``lexicon_size`` words most frequent in all texts, counted in a first pass, are compiled with their ids into
one automaton with shared suffixes (``automaton.py``); the buffer is broadcast and every Python worker maps
it from an unlinked file in its own temporary folder.  Words that the automaton lacks are merged exactly by
the tokenizer's own model and kept in a bounded cache.  The counts change only the speed.

Texts with characters from U+0250 on are normalised and cut by the library itself; below that, plain patterns
do the same (a test compares every such character).

Null and empty texts encode to no ids and decode to the empty text.  Repeated rows and null ids are kept row
by row; an empty table gives an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import mmap
import re
import tempfile
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.automaton import Lexicon, compile_lexicon
from commentloom.llm.common import keyed, numbered, summed, worker_state

CACHE_SIZE = 100_000
COUNTED = 100_000  # distinct words that a task counts before it hands them on

# Letters, numbers and white space below U+0250, as the split pattern of the tokenizer's file sees them.
_LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ɏ"
_NUMBERS = "0-9²³¹¼-¾"
_BLANKS = "\t-\r \u0085 "
_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
)
_WIDE = re.compile("[ɐ-\U0010ffff]")
# Controls, which mark words below, and letters whose lower case is longer or lies beyond.
_FAR = "".join(c for c in map(chr, range(0x250)) if max(c.lower()) >= "ɐ" or len(c.lower()) > 1)
_ODD = re.compile(f"[\0-\x08\x0e-\x1f\x7f-\xa0\xad{_FAR}]")


class Codec:
    """The tokenizer of one file: cutting texts into words, and exact merges of one word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.model = self.library.model
        self.names = [self.library.id_to_token(i) or "" for i in range(self.library.get_vocab_size(True))]
        byte_letters = self.library.pre_tokenizer.pre_tokenize_str
        # The letter that stands for a byte is found by cutting a character that needs this byte only.
        self.letters = {c: "".join(w for w, _ in byte_letters(c)) for c in map(chr, range(0x21, 0x250))}

    def words(self, text: str) -> list[str]:
        """Words and special strings in order; a special string is a word only as a whole piece of ``cut``."""
        if "<|" not in text:
            return self._plain(text)
        out: list[str] = []
        for k, piece in enumerate(self.cut.split(text)):
            if k % 2:
                out.append("\0" + piece)  # marked: a plain piece of text never equals it
            else:
                out.extend(self._plain(piece))
        return out

    def _plain(self, text: str) -> list[str]:
        if _WIDE.search(text) or _ODD.search(text):
            text = self.library.normalizer.normalize_str(text)
            return ["\1" + w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return _WORDS.findall(text.lower())

    def merge(self, word: str) -> list[int]:
        """The ids of one word by the library's own merges."""
        if word[0] == "\0":
            return [self.special[word[1:]]]
        if word[0] == "\1":  # in the library's byte letters already
            word = word[1:]
        elif not word.isascii():
            word = "".join(map(self.letters.__getitem__, word))
        return [t.id for t in self.model.tokenize(word)]


def codec(path: str) -> Codec:
    state = worker_state("bpe")
    if path not in state:
        state[path] = Codec(path)
    return state[path]


def word_counts(texts: DataFrame, path: str) -> DataFrame:
    """(word, seen) of every word of at most 48 characters that plain patterns cut, counted over all texts."""

    def count(batches):
        own, seen = codec(path), Counter()
        for batch in batches:
            for text in batch.column("_text"):
                seen.update(own.words(text.as_py()))
                if len(seen) >= COUNTED:
                    yield counts(seen)
                    seen = Counter()
        yield counts(seen)

    def counts(seen):
        kept = {w: n for w, n in seen.items() if len(w) <= 48 and w[0] > "\1"}
        return pa.RecordBatch.from_pydict({"word": list(kept), "seen": list(kept.values())}, schema=schema)

    schema = pa.schema([("word", pa.string()), ("seen", pa.int64())])
    counted = texts.select("_text").mapInArrow(count, "word string, seen bigint")
    return counted.groupBy("word").agg(F.sum("seen").alias("seen"))


def build_lexicon(texts: DataFrame, path: str, lexicon_size: int) -> bytes:
    """The compiled automaton of the words most frequent in all texts, of equally frequent ones the first by their code points."""

    def build(batches):  # ``lexicon_size`` words at most
        own = codec(path)
        words = [w for batch in batches for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_pydict({"raw": [compile_lexicon({w: own.merge(w) for w in words})]})

    often = word_counts(texts, path).where("seen > 1").orderBy(F.desc("seen"), "word").limit(lexicon_size)
    built = often.select("word").repartition(1).mapInArrow(build, "raw binary").first()
    return bytes(built.raw) if built else compile_lexicon({})


class Entries:
    """The automaton with its words' ids and tokens as strings, each joined by a space, by the words' ordinals."""

    def __init__(self, lexicon: Lexicon, names: list[str]):
        self.find, starts = lexicon.find, pa.array(lexicon.starts.astype(np.int64))
        self.sizes = np.diff(lexicon.starts.astype(np.int64))
        ids = pa.array(lexicon.ids)
        tokens = pa.array(names, pa.large_string()).take(ids)
        self.strings = [_by_space(starts, ids.cast(pa.large_string())), _by_space(starts, tokens)]


def mapped(own: Codec, buffer: bytes) -> Entries:
    """The automaton over a memory-mapped copy that vanishes with the process."""
    mark, state = hashlib.blake2b(buffer).digest(), worker_state("bpe")
    if state.get("mark") != mark:
        with tempfile.TemporaryFile() as file:
            file.write(buffer)
            file.flush()
            lexicon = Lexicon(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ))
        state["lexicon"], state["mark"] = Entries(lexicon, own.names), mark
    return state["lexicon"]


def _resolve(own: Codec, entries: Entries, words: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Each word's place among the entries and the words that they lack, and there the number of ids, the ids and the tokens."""
    cache, names = own.cache, own.names.__getitem__
    places = entries.find(words)
    lacking = np.flatnonzero(places < 0)
    places[lacking] = len(entries.sizes) + np.arange(len(lacking))
    merged = []
    for word in map(words.__getitem__, lacking.tolist()):
        entry = cache.get(word)
        if entry is None:
            ids = own.merge(word)
            entry = len(ids), " ".join(map(str, ids)), " ".join(map(names, ids))
            if len(word) <= 64:
                if len(cache) >= CACHE_SIZE:
                    cache.clear()
                cache[word] = entry
        merged.append(entry)
    sizes, *strings = zip(*merged, strict=True) if merged else ((), (), ())
    both = [pa.concat_arrays([x, pa.array(y, pa.large_string())]) for x, y in zip(entries.strings, strings, strict=True)]
    return places, np.concatenate([entries.sizes, np.array(sizes, np.int64)]), *both


def _by_space(ends: pa.Array, strings: pa.Array) -> pa.Array:
    return pc.binary_join(pa.LargeListArray.from_arrays(ends, strings), pa.scalar(" ", pa.large_string()))


def _joined(pieces: pa.Array, numbers: np.ndarray, lengths: np.ndarray) -> list[str]:
    """For each text the pieces of its words, joined by a space."""
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]))
    return _by_space(ends, pieces.take(pa.array(numbers))).to_pylist()


def encode(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lexicon_size: int = 150_000,
    digests: bool = False,
) -> DataFrame:
    """(id, ids, decoded) for every row, or (id, n_tokens, ids_sha256, decoded_sha256) with ``digests``.

    ``decoded`` is what the tokenizer's decoder makes of the ids, special tokens kept.
    """
    texts = keyed(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(build_lexicon(texts, path, lexicon_size))
    kind = texts.schema["_id"].dataType.simpleString()

    def run(batches):
        own = codec(path)
        entries = mapped(own, shared.value)
        for batch in batches:
            rows, size, at = [], 0, 0
            columns = batch.column("_text")
            for k in range(len(columns)):
                rows.append(own.words(columns[k].as_py()))
                size += len(rows[-1])
                if size >= 100_000 or k == len(columns) - 1:  # words held at a time, besides one text's own
                    yield build(own, entries, batch.column("_id").slice(at, len(rows)), rows)
                    at, size, rows = at + len(rows), 0, []

    def build(own, entries, ids, rows):
        distinct, numbers, lengths = numbered(rows)
        places, sizes, ids_of, tokens_of = _resolve(own, entries, distinct)
        numbers = places[numbers]
        counts = summed(sizes[numbers], lengths)
        encoded, decoded = _joined(ids_of, numbers, lengths), _joined(tokens_of, numbers, lengths)
        if digests:
            sha = lambda xs: [hashlib.sha256(x.encode()).hexdigest() for x in xs]
            values = [pa.array(counts, pa.int64()), pa.array(sha(encoded)), pa.array(sha(decoded))]
        else:
            lists = [[int(i) for i in x.split()] for x in encoded]
            values = [pa.array(counts, pa.int64()), pa.array(lists, pa.list_(pa.int32())), pa.array(decoded)]
        return pa.RecordBatch.from_arrays([ids, *values], names=["_id", *names])

    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids", "decoded"]
    kinds = ["bigint", "string", "string"] if digests else ["bigint", "array<int>", "string"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(["_id", *names], [kind, *kinds], strict=True))
    return texts.mapInArrow(run, schema).select(F.col("_id").alias(id_col), *names)
