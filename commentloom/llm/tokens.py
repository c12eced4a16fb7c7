"""Token counts: a map-side lookup in two tiers.

A pre-token is a run of spaces with the word behind it.  No piece of the vocabulary has a space after
another character, so merges never cross a pre-token's end and a text's count is the sum over its
pre-tokens.  Tier one is a broadcast table of frequent pre-tokens and their lengths, packed and bounded by
``table_size``; it is fitted on about ``sample_rows`` texts at most and changes only the speed.  Tier two encodes
misses and keeps them in a cache of the Python worker, emptied when it holds ``CACHE_SIZE`` entries.
Pre-tokens are never shuffled; the whole count is one narrow stage.

Null and empty texts have 0 tokens.  Repeated rows and null ids are counted row by row; an empty table gives
an empty result; columns other than the id and the text are not read.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.common import few_rows, keyed, numbered, summed, texts_of, worker_state

CACHE_SIZE = 400_000
CHUNK_WORDS = 400_000  # pre-tokens looked up at a time, besides one text's own
SPACE = "▁"  # how the library writes a space
_RUN = re.compile(" *[^ ]+| +$")


def pre_tokens(text: str) -> list[str]:
    """The text's pre-tokens, each without its first space."""
    text = text.replace(SPACE, " ")
    if "  " not in text and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    return [x[1:] if x.strip(" ") else x for x in _RUN.findall(" " + text)]


def _encoder(path: str):
    state = worker_state("tokens")
    if path not in state:
        from sentencepiece import SentencePieceProcessor

        state[path] = SentencePieceProcessor(model_file=path), {}
    return state[path]


def _length(library, word: str) -> int:
    """Tokens of one pre-token; only spaces means the end of a text, where no word takes the first one."""
    if not word.strip(" "):
        return len(library.encode(word[1:])) if len(word) > 1 else len(word)
    return len(library.encode(word))


def frequent(texts: DataFrame, path: str, sample_rows: int, table_size: int) -> bytes:
    """The packed first tier: words joined by line ends, then one byte for each length."""

    def count(batches):
        library, _ = _encoder(path)
        for batch in batches:
            seen = Counter()
            for text in texts_of(batch):
                seen.update(w for w in pre_tokens(text) if len(w) <= 64 and "\n" not in w)
            words = [w for w, n in seen.most_common(table_size) if n > 1]
            yield pa.RecordBatch.from_pydict(
                {"word": words, "n": [_length(library, w) for w in words], "seen": [seen[w] for w in words]}, schema=schema
            )

    schema = pa.schema([("word", pa.string()), ("n", pa.int32()), ("seen", pa.int64())])
    total, sizes = Counter(), {}
    for word, n, seen in few_rows(texts.select("_text"), sample_rows).mapInArrow(count, "word string, n int, seen bigint").collect():
        if n < 256:
            total[word] += seen
            sizes[word] = n
    words = [w for w, _ in total.most_common(table_size)]
    return zlib.compress("\n".join(words).encode()) + b"|" + array("B", map(sizes.get, words)).tobytes()


def unpack(packed: bytes) -> dict[str, int]:
    inflate = zlib.decompressobj()
    words = inflate.decompress(packed).decode().split("\n")
    lengths = inflate.unused_data[1:]
    return dict(zip(words, lengths, strict=True)) if lengths else {}


def _first_tier(packed: bytes) -> dict[str, int]:
    """The unpacked table, kept by the worker as long as the same one is asked for."""
    state = worker_state("tokens")
    if state.get("packed") != packed:
        state["packed"], state["table"] = packed, unpack(packed)
    return state["table"]


def count_tokens(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = 4096,
    sample_rows: int = 3000,
    table_size: int = 150_000,
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for every row of ``docs``."""
    texts = keyed(docs, id_col, text_col)
    first = docs.sparkSession.sparkContext.broadcast(frequent(texts, model_path, sample_rows, table_size))
    kind = texts.schema["_id"].dataType.simpleString()

    def count(batches):
        library, cache = _encoder(model_path)
        table = _first_tier(first.value)
        for batch in batches:
            column, pending, words, at = batch.column("_text"), [], 0, 0
            for k in range(len(column)):
                text = column[k].as_py()
                pending.append(pre_tokens(text) if text else [])
                words += len(pending[-1])
                if words >= CHUNK_WORDS or k == len(column) - 1:
                    part = batch.slice(at, len(pending))
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_id"), part.column("n_bytes"), pa.array(lengths(library, table, cache, pending))],
                        names=["_id", "n_bytes", "n_tokens"],
                    )
                    at, words, pending = at + len(pending), 0, []

    def lengths(library, table, cache, pending):
        distinct, numbers, counts = numbered(pending)
        sizes = np.empty(len(distinct), np.int64)
        for i, word in enumerate(distinct):
            n = table.get(word)
            if n is None:
                n = cache.get(word)
            if n is None:
                n = _length(library, word)
                if len(word) <= 64:
                    if len(cache) >= CACHE_SIZE:
                        cache.clear()
                    cache[word] = n
            sizes[i] = n
        return summed(sizes[numbers], counts)

    counted = texts.select("_id", F.octet_length("_text").cast("bigint").alias("n_bytes"), "_text").mapInArrow(
        count, f"_id {kind}, n_bytes bigint, n_tokens bigint"
    )
    return counted.select(
        F.col("_id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit")
    )
