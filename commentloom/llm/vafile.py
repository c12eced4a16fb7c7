"""Exact search for the largest inner products with vector-approximation files.

Components become the integers floor(256 * x).  The approximation keeps one byte a component, the number of its
cell on an even grid over the range of all components; a cell's ends bound a component from both sides, so the
codes bound every score.  Blocks of codes meet blocks of queries (the stated query set against all rows; both
sides are salted by id into blocks of bounded size), and a block hands on, for each query, only what its bounds
cannot rule out: upper bound at least the block's kth lower bound.  The same rule over all blocks leaves few
candidates.  Exact vectors are then read in the order of the bounds, in two steps: the k with the
largest upper bounds give a kth exact score, and of the rest only those whose upper bound reaches it are read.
After that no unread vector can belong to the result.  Nothing is approximate in the end.

Vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id.
Rows that repeat an id count once (of different vectors the smallest in array order).  Of equal vectors only the
k + 1 with the smallest ids are indexed: no other can be in any result.  Only vectors of a query's own
width are its candidates.  Ties go to the smaller id.  A score beyond 64 bits is null.  An empty table gives
an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentloom.llm.common import stored
from commentloom.llm.vectors import by_width, few_twins, one_per_id, parts_for

CELLS = 256
SCALE = 256


def _ints(v: str) -> Column:
    return F.transform(F.col(v), lambda x: F.floor(x * F.lit(float(SCALE))).cast("decimal(38,0)"))


def _inner(a: str, b: str) -> Column:
    products = F.zip_with(_ints(a), _ints(b), lambda x, y: (x * y).cast("decimal(38,0)"))
    return F.aggregate(products, F.lit(0).cast("decimal(38,0)"), lambda s, p: (s + p).cast("decimal(38,0)"))


def _codes(vectors: DataFrame, low: float, step: float) -> DataFrame:
    """(_id, width, code): the approximation file."""

    def run(batches):
        for batch in batches:
            ids, widths, codes = [], [], []
            column = batch.column("_id").to_numpy(zero_copy_only=False)
            for rows, m in by_width(batch):
                cells = np.clip(np.floor((np.floor(m * SCALE) - low) / step), 0, CELLS - 1).astype(np.uint8)
                ids.extend(column[rows].tolist())
                widths.extend([m.shape[1]] * len(rows))
                codes.extend(map(bytes, cells))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(widths, pa.int32()), pa.array(codes, pa.binary())],
                names=["_id", "width", "code"],
            )

    return vectors.mapInArrow(run, "_id bigint, width int, code binary")


def bounded_candidates(codes: DataFrame, queries: DataFrame, k: int, low: float, step: float, blocks: int, groups: int) -> DataFrame:
    """(query_id, vec_id, lower, upper): what no block can rule out by its bounds."""

    def scan(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if data.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "lower": [], "upper": []})
        width = int(data.width.iloc[0])
        cells = np.frombuffer(b"".join(data.code), np.uint8).reshape(len(data), width).astype(np.float64)
        ids = data._id.to_numpy()
        q = np.floor(np.stack(asked.v.to_numpy()) * SCALE)
        # A component lies in [low + step * cell, low + step * (cell + 1)]; slack covers rounding of floats.
        base = q @ cells.T * step + low * q.sum(axis=1)[:, None]
        up = np.maximum(q, 0).sum(axis=1) * step
        down = np.minimum(q, 0).sum(axis=1) * step
        slack = 1e-9 * (np.abs(q).sum(axis=1) * (abs(low) + step * CELLS) + 1)
        out = []
        for i, own in enumerate(asked._id.to_numpy()):
            row = base[i]
            other = ids != own
            if not other.any():
                continue
            lows = row[other]
            kth = np.partition(lows, -k)[-k] if len(lows) > k else -np.inf
            keep = np.flatnonzero(other & (row + up[i] + slack[i] >= kth + down[i] - slack[i]))
            out.append(
                pd.DataFrame(
                    {"query_id": own, "vec_id": ids[keep], "lower": row[keep] + down[i] - slack[i], "upper": row[keep] + up[i] + slack[i]}
                )
            )
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "lower": [], "upper": []})

    salt = lambda n: F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = codes.withColumn("block", salt(blocks)).withColumn("part", spread(groups))
    asked = queries.select("_id", F.size("v").alias("width"), "v", salt(groups).alias("part")).withColumn("block", spread(blocks))
    keys = ["width", "block", "part"]
    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys))
    return found.applyInPandas(scan, "query_id bigint, vec_id bigint, lower double, upper double")


def top_inner(
    df: DataFrame,
    k: int,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    block_rows: int = 8192,
    query_rows: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest scores; ``is_query`` is a condition on ``_id``."""
    vectors, _ = stored(one_per_id(df, id_col, vec_col), "vectors")
    low, high, rows, asked = vectors.agg(
        F.min(F.array_min("v")), F.max(F.array_max("v")), F.count("*"), F.count_if(is_query)
    ).first()
    low, high = (np.floor(SCALE * x) if rows else 0.0 for x in (low, high))
    step = float(max(1.0, np.ceil((high - low + 1) / CELLS)))
    queries = vectors.where(is_query)
    codes = _codes(few_twins(vectors, k + 1), float(low), step)
    candidates = bounded_candidates(
        codes, queries, k, float(low), step, parts_for(rows, block_rows), parts_for(asked, query_rows)
    )
    candidates, _ = stored(candidates, "candidates")
    by_lower = Window.partitionBy("query_id").orderBy(F.desc("lower"), "vec_id")
    kth = (
        candidates.select("query_id", "lower", F.row_number().over(by_lower).alias("n"))
        .where(F.col("n") <= k)
        .groupBy("query_id")
        .agg(F.when(F.count("*") == k, F.min("lower")).otherwise(float("-inf")).alias("least"))
    )
    open_ = candidates.join(kth, "query_id").where(F.col("upper") >= F.col("least"))
    by_upper = Window.partitionBy("query_id").orderBy(F.desc("upper"), "vec_id")
    ordered, _ = stored(open_.select("query_id", "vec_id", "upper", F.row_number().over(by_upper).alias("place")), "ordered")

    def exact(pairs: DataFrame) -> DataFrame:
        own = queries.select(F.col("_id").alias("query_id"), F.col("v").alias("q"))
        read = vectors.select(F.col("_id").alias("vec_id"), "v")
        scored = pairs.join(own, "query_id").join(read, "vec_id")
        return scored.select("query_id", "vec_id", _inner("q", "v").alias("exact"))

    first, _ = stored(exact(ordered.where(F.col("place") <= k).select("query_id", "vec_id")), "first")
    certain = first.groupBy("query_id").agg(F.min("exact").cast("double").alias("bar"))
    rest = ordered.where(F.col("place") > k).join(certain, "query_id").where(F.col("upper") >= F.col("bar") - F.abs("bar") * 1e-9)
    scores = first.unionByName(exact(rest.select("query_id", "vec_id")))
    best = Window.partitionBy("query_id").orderBy(F.desc("exact"), "vec_id")
    return (
        scores.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", F.expr("try_cast(exact AS bigint)").alias("score"))
    )
