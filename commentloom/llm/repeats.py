"""Removal of repeated byte strings: winnowed anchors, grouped by hashes in three rounds.

The method asked for merges the shards' Burrows-Wheeler transforms by refining an interleave, one byte a round.  A
measured attempt (README) cannot meet the limits, so its rounds and blocks are kept, but not the transforms:

* Only sampled suffixes enter (winnowing).  A string of ``length`` bytes is represented by its anchor, the place of
  the smallest hashed 8-gram in its first ``WINDOW`` places, so equal strings have their anchors at equal
  offsets.  An anchor owns the run of string starts that choose it.
* Suffixes with a common beginning form a block, and a round adds many bytes: first the bytes common to all strings
  of an anchor (``length`` - WINDOW + 1 from the anchor on), then the whole span of the strings it owns to both sides,
  then each owned string by itself.  A round looks only at suffixes whose block still holds others.
* A block's name is the 64-bit hash of its prefix instead of a rank, so shards agree on names without
  exchanging ranks, and a block's later names only count beside its earlier ones (128 bits together).

Round two settles an anchor whose whole span occurs again: all its strings repeat.  Round three is
needed only in blocks that hold an anchor with a span of its own; there each distinct span sends its strings
once.  Strings are judged on the input, overlaps count, and matches never cross texts.

Null and empty texts have 0 bytes and keep nothing.  Rows that repeat an id and a text are texts of their own, so each
string of theirs repeats.  Null ids are kept apart by their texts.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentloom.llm.common import discard, keyed, stored

WINDOW = 128  # a power of two; the anchor lies in as many places
GRAM = 8
HOT = 1000
_SIGN = 1 << 63


def _signed(x: int) -> int:
    return x - (1 << 64) if x & _SIGN else x


def anchors(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all strings of ``length`` bytes, with the first and last start each owns."""
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none
    byte = np.frombuffer(data, np.uint8).astype(np.uint64)
    two = byte[:-1] | byte[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    gram = (four[:-4] | four[4:] << np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    least = gram >> np.uint64(32) << np.uint64(32) | np.arange(len(gram), dtype=np.uint64)
    width = 1
    while width < WINDOW:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    at = (least[: n - length + 1] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    change = np.flatnonzero(np.diff(at)) + 1
    low = np.concatenate([[0], change])
    return at[low], low, np.concatenate([change - 1, [n - length]])


def shard_suffixes(docs: DataFrame, length: int) -> DataFrame:
    """(core, whole, _id, _twin, span): each anchor's names of the first two rounds and the starts it owns.

    ``span`` holds the first owned start above 8 bits with the number of further ones.
    """
    kind = docs.schema["_id"].dataType.simpleString()
    core_size = length - WINDOW + 1
    digest = xxhash.xxh64_intdigest

    def run(batches):
        for batch in batches:
            texts, ids, twins = (batch.column(c) for c in ("_text", "_id", "_twin"))
            cores, wholes, spans, rows = [], [], [], []
            for k in range(batch.num_rows):
                data = texts[k].as_py().encode()
                at, low, high = anchors(data, length)
                if not len(at):
                    continue
                view = memoryview(data)
                marks = ((at - low) << 8 | at - high).tolist()
                low_, high_ = low.tolist(), high.tolist()
                cores += [digest(view[a : a + core_size]) for a in at.tolist()]
                wholes += [digest(view[a : b + length], m) for a, b, m in zip(low_, high_, marks, strict=True)]
                spans.append(low << 8 | high - low)
                rows.append(np.full(len(at), k))
                if len(cores) >= 200_000 or k == batch.num_rows - 1:
                    yield build(ids, twins, cores, wholes, spans, rows)
                    cores, wholes, spans, rows = [], [], [], []
            if cores:
                yield build(ids, twins, cores, wholes, spans, rows)

    def build(ids, twins, cores, wholes, spans, rows):
        take = pa.array(np.concatenate(rows))
        names = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (cores, wholes)]
        return pa.RecordBatch.from_arrays(
            [*names, ids.take(take), twins.take(take), pa.array(np.concatenate(spans))], names=["core", "whole", "_id", "_twin", "span"]
        )

    return docs.mapInArrow(run, f"core bigint, whole bigint, _id {kind}, _twin bigint, span bigint")


def _frequent(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The keys of more than ``least`` rows; counts are summed in each task before they are shuffled."""
    return rows.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > least).select(*keys)


def _among(rows: DataFrame, *names: str) -> Column:
    """Whether a row's names are those of one of ``rows``, of which there are fewer than ``HOT``."""
    listed = rows.select(*names).collect()
    if len(names) == 1:
        return F.col(names[0]).isin([r[0] for r in listed])
    return F.struct(*names).isin([F.struct(*[F.lit(x).alias(n) for x, n in zip(r, names, strict=True)]) for r in listed])


def shared_blocks(suffixes: DataFrame) -> DataFrame:
    """Rounds one and two: (core, _id, _twin, span, full, ask) of anchors whose block holds others.

    ``full``: the whole span occurs again.  ``ask``: the span must send its strings to round three.

    A block with more than a ``HOT``th of all anchors, of which there are fewer than ``HOT``, is never
    gathered in one task: its spans are counted, and the counts come back to the anchors, those of spans that are
    as frequent themselves by a list of fewer than ``HOT`` names, which a scan filters by.  ``suffixes`` is read several times.
    """
    share = suffixes.count() // HOT
    in_hot = _among(_frequent(suffixes, ["core"], share), "core")
    block, within = Window.partitionBy("core"), Window.partitionBy("core", "whole")
    first = within.orderBy("_id", "_twin", "span")
    cold = (
        suffixes.where(~in_hot)
        .withColumn("same", F.count("*").over(within))
        .withColumn("first", F.row_number().over(first) == 1)
        .withColumn("all", F.count("*").over(block))
        .withColumn("fewest", F.min("same").over(block))
        .where(F.col("all") > 1)
    )
    ask = (F.col("fewest") == 1) & F.col("first")
    cold = cold.select("core", "_id", "_twin", "span", (F.col("same") > 1).alias("full"), ask.alias("ask"))
    hot = suffixes.where(in_hot)
    counted = F.count("*").alias("same"), F.min(F.struct("_id", "_twin", "span")).alias("least")
    spans, _ = stored(hot.groupBy("core", "whole").agg(*counted), "hot-spans")
    # Anchors whose span occurs again: a span that is as frequent itself is in the list.
    again = spans.where(F.col("same") > 1)
    in_big = _among(again.where(F.col("same") > share), "core", "whole")
    rest = hot.where(~in_big).join(again.where(F.col("same") <= share), ["core", "whole"], "left_semi")
    full = hot.where(in_big).unionByName(rest)
    full = full.select("core", "_id", "_twin", "span", F.lit(True).alias("full"), F.lit(False).alias("ask"))
    # In a block that has a span of its own, one anchor of each span asks; it is known from the counts.
    single = spans.groupBy("core").agg(F.min("same").alias("fewest")).where(F.col("fewest") == 1)
    asking = spans.where(_among(single, "core")).select("core", "least.*", F.lit(False).alias("full"), F.lit(True).alias("ask"))
    return cold.unionByName(full).unionByName(asking)


def single_strings(texts: DataFrame, length: int) -> DataFrame:
    """Round three: (_id, _twin, start) of the strings that distinct spans of one block share."""
    kind = texts.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            columns = {c: batch.column(c) for c in ("_id", "_twin", "_text", "blocks")}
            cores, names, starts, rows = [], [], [], []
            for k in range(batch.num_rows):
                view = memoryview(columns["_text"][k].as_py().encode())
                for b in columns["blocks"][k].as_py():
                    if b["ask"]:
                        low, more = b["span"] >> 8, b["span"] & 255
                        names += [_signed(xxhash.xxh64_intdigest(view[p : p + length])) for p in range(low, low + more + 1)]
                        starts.append(np.arange(low, low + more + 1))
                        cores.append(np.full(more + 1, b["core"]))
                        rows.append(np.full(more + 1, k))
                if len(names) >= 200_000 or (names and k == batch.num_rows - 1):
                    take = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(cores)),
                            pa.array(names, pa.int64()),
                            columns["_id"].take(take),
                            columns["_twin"].take(take),
                            pa.array(np.concatenate(starts).astype(np.int32)),
                        ],
                        names=["core", "name", "_id", "_twin", "start"],
                    )
                    cores, names, starts, rows = [], [], [], []

    sent = texts.select("_id", "_twin", "_text", "blocks").mapInArrow(run, f"core bigint, name bigint, _id {kind}, _twin bigint, start int")
    shared = sent.withColumn("n", F.count("*").over(Window.partitionBy("core", "name"))).where("n > 1")
    return shared.groupBy("_id", "_twin").agg(F.collect_set("start").alias("starts"))


def _cut(data: bytes, length: int, full: list[tuple[int, int]], starts: list[int]) -> tuple[int, int, bytes]:
    """Removed bytes, removed runs, and what is left."""
    edge = np.zeros(len(data) + 1, np.int32)
    for low, high in full:
        edge[low] += 1
        edge[high + length] -= 1
    if starts:
        at = np.array(starts)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + length, -1)
    gone = np.cumsum(edge[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1))
    return int(gone.sum()), runs, np.frombuffer(data, np.uint8)[~gone].tobytes()


def _release(spark) -> None:
    """Lets the engine delete the shuffle files of finished steps, whose results are stored."""
    gc.collect()
    spark._jvm.System.gc()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, keep: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) for every row, with ``keep`` also the bytes kept."""
    if length < 2 * WINDOW + GRAM:
        raise ValueError(f"length must be at least {2 * WINDOW + GRAM}")
    spark = docs.sparkSession
    texts = keyed(docs, id_col, text_col)
    twin = F.when(F.col("_id").isNull(), F.xxhash64("_text")).otherwise(F.hash("_text").cast("bigint"))
    texts = texts.select("_id", twin.alias("_twin"), "_text")
    suffixes, suffixes_path = stored(shard_suffixes(texts, length), "suffixes")
    shared, shared_path = stored(shared_blocks(suffixes), "blocks")
    discard(spark, suffixes_path)
    _release(spark)
    blocks = shared.groupBy("_id", "_twin").agg(F.collect_list(F.struct("core", "span", "full", "ask")).alias("blocks"))
    met = texts.alias("t").join(
        blocks.alias("b"), F.col("t._id").eqNullSafe(F.col("b._id")) & (F.col("t._twin") == F.col("b._twin")), "left"
    )
    found = F.col("blocks").isNotNull()
    met = met.select(
        F.col("t._id").alias("_id"),
        F.col("t._twin").alias("_twin"),
        F.octet_length("_text").cast("bigint").alias("n_bytes"),
        F.when(~found, F.sha2("_text", 256)).alias("whole_sha256"),
        F.when(found | F.lit(keep), F.col("_text")).alias("_text"),
        "blocks",
    )
    met, _ = stored(met, "met")
    discard(spark, shared_path)
    _release(spark)
    hit = met.where("blocks is not null")
    starts, _ = stored(single_strings(hit.where(F.exists("blocks", lambda b: b["ask"])), length), "starts")
    _release(spark)
    hit = hit.alias("t").join(
        starts.alias("s"), F.col("t._id").eqNullSafe(F.col("s._id")) & (F.col("t._twin") == F.col("s._twin")), "left"
    )
    kind = texts.schema["_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            removed, runs, kept = [], [], []
            for k in range(batch.num_rows):
                data = columns["_text"][k].as_py().encode()
                spans = [b["span"] for b in columns["blocks"][k].as_py() if b["full"]]
                full = [(s >> 8, (s >> 8) + (s & 255)) for s in spans]
                gone, count, rest = _cut(data, length, full, columns["starts"][k].as_py() or [])
                removed.append(gone)
                runs.append(count)
                kept.append(rest)
            shas = [hashlib.sha256(x).hexdigest() for x in kept]
            values = [pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(shas)]
            values += [pa.array(kept, pa.binary())] * keep
            yield pa.RecordBatch.from_arrays([columns["_id"], columns["n_bytes"], *values], names=names)

    names = ["_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep
    schema = f"_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * keep
    cut = hit.select(F.col("t._id").alias("_id"), "n_bytes", "_text", "blocks", "starts").mapInArrow(run, schema)
    none = F.lit(0).cast("bigint")
    rest = met.where("blocks is null").select(
        "_id", "n_bytes", none.alias("n_removed"), none.alias("n_spans"), F.col("whole_sha256").alias("kept_sha256"),
        *[F.col("_text").cast("binary").alias("kept")] * keep,
    )
    return cut.unionByName(rest).withColumnRenamed("_id", id_col)
