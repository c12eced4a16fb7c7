"""Near duplicates by SimHash and multi-index hashing.

Fingerprints have 64 bits and link at 2 or fewer differing bits.  A fingerprint is cut into two segments of
32 bits; for each segment it enumerates the Hamming ball of radius 1 and looks its members up in a table
keyed by the ball member beside the other segment as it is: 65 keys in all.  Two fingerprints within 2 bits
share a key (the value half way between them, whichever segments the bits lie in), and all that share a key
lie within 2 bits of each other.  So a table entry, which holds at most 65 distinct fingerprints, needs only a
chain of links, never all pairs, and no entry grows with a group of copies.  Every link's complete distance is
verified.  Equal fingerprints are one node from the start.

Null and empty texts, and texts of white space, have fingerprint 0 and link like any other.  Repeated rows share
a class; null ids never name a class that has another id.  An empty table gives an empty result; columns other
than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentloom.llm.common import keyed, stored
from commentloom.llm.graph import components

MAX_BITS = 2
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_BLOCK = 1 << 14  # shingle hashes whose bits are counted at a time


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_LOWER).split()


def fingerprint(text: str, words: int = 3, seed: int = 42) -> int:
    """Bit i is 1 if it is set in over half the XXH64 values of the text's word shingles."""
    tokens = words_of(text)
    if not tokens:
        return 0
    whole = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(whole, seed)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(tokens) - words + 1].tolist()
    digest, view = xxhash.xxh64_intdigest, memoryview(whole)
    total, count = np.zeros(64, np.int64), len(starts)
    ends = ends[words - 1 :].tolist()
    for at in range(0, count, _BLOCK):
        part = [digest(view[a:b], seed) for a, b in zip(starts[at : at + _BLOCK], ends[at : at + _BLOCK], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int32)
    return sum(1 << i for i in np.flatnonzero(2 * total > count).tolist())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(_id, _twin, fp): the fingerprint as a signed 64-bit integer, and a hash of the text to tell apart equal ids."""
    texts = keyed(docs, id_col, text_col)
    texts = texts.select("_id", F.xxhash64("_text").alias("_twin"), "_text")

    def run(batches):
        for batch in batches:
            column = batch.column("_text")
            values = np.array([fingerprint(column[k].as_py(), words) for k in range(len(column))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_twin"), pa.array(values.view(np.int64))], names=["_id", "_twin", "fp"]
            )

    return texts.mapInArrow(run, f"_id {texts.schema['_id'].dataType.simpleString()}, _twin bigint, fp bigint")


def ball_keys(fp: Column, segments: int = 2, radius: int = 1) -> Column:
    """The table keys of a fingerprint: the ball of each segment beside the untouched rest."""
    width = 64 // segments
    masks = {0}
    for s in range(segments):
        ball = {0}
        for _ in range(radius):
            ball |= {m ^ (1 << (s * width + i)) for m in ball for i in range(width)}
        masks |= ball
    signed = [m - (1 << 64) if m >> 63 else m for m in sorted(masks)]
    return F.array(*[fp.bitwiseXOR(F.lit(m)) for m in signed])


def links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """Distinct links (a > b) that join all fingerprints within ``bits`` (2 or 0), of distinct ``prints`` (fp)."""
    if bits not in (0, MAX_BITS):
        raise ValueError(f"the table's keys are made for {MAX_BITS} bits, or none")
    if bits == 0:  # equal fingerprints are one node already
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    probes = prints.select("fp", F.explode(ball_keys(F.col("fp"))).alias("key"))
    entry = Window.partitionBy("key").orderBy("fp")
    chained = probes.select("fp", F.lag("fp").over(entry).alias("before")).where("before is not null")
    near = chained.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("before"))) <= bits)
    return near.select(F.greatest("fp", "before").alias("a"), F.least("fp", "before").alias("b")).distinct()


def classes(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(fp, root): every distinct fingerprint with the smallest one that links reach."""
    nodes = prints.select("fp").distinct()
    roots, _ = components(links(nodes, bits))
    return nodes.join(roots, nodes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = MAX_BITS
) -> DataFrame:
    """(id, fingerprint, component_id): every row with its fingerprint and the smallest id of its class."""
    prints, _ = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = prints.groupBy("fp").agg(F.min("_id").alias("least")).join(classes(prints, bits), "fp")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(least, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(
        F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each class the row with the smallest id.

    A null id stays only where its class has no other; of rows with the class's id the smallest text hash
    decides, and of rows equal in both, one of their columns' hash.
    """
    prints, _ = stored(fingerprints(docs, id_col, text_col, words), "fingerprints")
    return kept_rows(docs, least_rows(prints), classes(prints, bits), id_col, text_col)


def least_rows(prints: DataFrame) -> DataFrame:
    """(fp, row): the row that stands for each fingerprint."""
    order = F.struct(F.col("_id").isNull().alias("none"), "_id", "_twin").alias("row")
    return prints.groupBy("fp").agg(F.min(order).alias("row"))


def kept_rows(docs: DataFrame, best: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The row of ``docs`` that stands for each class (fp, root), where ``best`` has the row of each fingerprint."""
    kept = best.join(classes, "fp").groupBy("root").agg(F.min("row").alias("row"))
    kept = kept.select(F.col("row._id").alias("_kept"), F.col("row._twin").alias("_kept_twin"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs[id_col].alias("_id"),
        F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))).alias("_twin"),
    )
    rows = rows.join(kept, F.col("_id").eqNullSafe(F.col("_kept")) & (F.col("_twin") == F.col("_kept_twin")), "left_semi")
    same = Window.partitionBy("_id", "_twin").orderBy(F.xxhash64("_row"))
    one = rows.withColumn("_nth", F.row_number().over(same)).where("_nth = 1")
    return one.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
