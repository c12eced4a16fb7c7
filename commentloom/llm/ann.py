"""Approximate nearest neighbours on shifted Hilbert curves.

Vectors are projected onto ``dims`` random directions, shifted, cut into 2**``bits`` cells a direction and ordered by
their place on a Hilbert curve; this is done for ``curves`` different projections and shifts.  Every curve is
cut into ``ranges`` key ranges of about equal weight, and a query is compared with all vectors of every range that
its own place on the curve spans and of the one on either side, on every curve; what the curves find is merged and
reranked by the exact distance.  Only the cut points and the scale of the projections are fitted on a bounded sample (at most ``fit_rows``
vectors); every vector is indexed.  Equal places are told apart by a hash of the id, another one on each curve, so a
place that holds a third of all rows still spreads over ranges, all of which its queries visit, and ranges are salted by id into blocks of bounded size, as are the
queries that visit them.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an
id.  Rows that repeat an id count once (of different vectors the smallest in array order).  Of equal vectors
only the k + 1 with the smallest ids are indexed: no other can be in any result, since ties go to the smaller
id.  Vectors of each width have curves, scale and cut points of their own, and only vectors of a query's own width
are its candidates.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commentloom.llm.common import stored
from commentloom.llm.hilbert import hilbert_keys
from commentloom.llm.vectors import by_width, few_twins, one_per_id, parts_for

TAIL = 30  # bits of a key below the place
SLICE = 256  # queries of a block that are compared at a time


class Curves:
    """Projections, shifts and, after ``fit``, scale and cut points of all curves."""

    def __init__(self, width: int, curves: int, dims: int, bits: int, seed: int):
        rng = np.random.default_rng(seed)
        dims = min(dims, width)
        self.bits = bits
        self.axes = [np.linalg.qr(rng.normal(size=(width, dims)))[0] for _ in range(curves)]
        self.shifts = rng.uniform(-0.5, 0.5, (curves, dims))
        self.factors = rng.integers(0, 2**63, curves, np.uint64) * np.uint64(2) + np.uint64(1)
        self.middle = self.spread = self.cuts = None

    def places(self, x: np.ndarray) -> list[np.ndarray]:
        """For each curve every vector's place, in the high bits of its key."""
        out = []
        for c, axes in enumerate(self.axes):
            z = (x @ axes - self.middle[c]) / self.spread[c] / 4 + 0.5  # two deviations either way
            cells = np.floor(z * 2**self.bits + self.shifts[c])
            place = hilbert_keys(np.clip(cells, 0, 2**self.bits - 1).astype(np.int64), self.bits)
            out.append(place << TAIL)
        return out

    def keys(self, x: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        """For each curve every vector's key, equal places told apart by a hash of the id."""
        tails = [(ids.astype(np.uint64) * f >> np.uint64(64 - TAIL)).astype(np.int64) for f in self.factors]
        return [place | tail for place, tail in zip(self.places(x), tails, strict=True)]

    def fit(self, x: np.ndarray, ids: np.ndarray, ranges: int) -> Curves:
        projected = [x @ axes for axes in self.axes]
        low, self.middle, high = (np.quantile(projected, q, axis=1) for q in (0.16, 0.5, 0.84))  # outliers don't count
        self.spread = np.maximum((high - low) / 2, 1e-300)
        at = np.linspace(0, 1, ranges + 1)[1:-1]
        self.cuts = [np.quantile(k, at, method="lower") for k in self.keys(x, ids)]
        return self

    def ranges_of(self, x: np.ndarray, ids: np.ndarray) -> list[np.ndarray]:
        """Vectors by curves: the key range of each, and the first and last range that its place spans."""
        places = self.places(x)
        bounds = [self.keys(x, ids), places, [p | (1 << TAIL) - 1 for p in places]]
        return [np.stack([np.searchsorted(c, k, "right") for c, k in zip(self.cuts, b, strict=True)], axis=1) for b in bounds]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(axis=1))


def nearest(
    df: DataFrame,
    k: int,
    is_query: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    curves: int = 12,
    dims: int = 8,
    bits: int = 3,
    ranges: int = 20,
    fit_rows: int = 8192,
    block_rows: int = 4096,
    query_rows: int = 2048,
    seed: int = 17,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` nearest found by Euclidean distance."""
    spark = df.sparkSession
    usable = one_per_id(df, id_col, vec_col).where(F.exists("v", lambda x: x != 0))
    vectors, _ = stored(usable.withColumn("width", F.size("v")), "vectors")
    sizes = vectors.groupBy("width").agg(F.count("*"), F.count_if(is_query)).collect()
    empty = "query_id bigint, rank int, vec_id bigint, score double"
    indexes = {}
    for width, _, asked in sizes:
        if asked:
            sample = vectors.where(F.col("width") == width).select("_id", "v").limit(fit_rows).toPandas()
            indexes[width] = Curves(width, curves, dims, bits, seed).fit(np.stack(sample.v), sample._id.to_numpy(), ranges)
    if not indexes:
        return spark.createDataFrame([], empty)
    shared = spark.sparkContext.broadcast(indexes)
    searched = vectors.where(F.col("width").isin(list(indexes)))
    # A range holds its share of the rows, and three ranges are visited by a query that spans one.
    blocks = parts_for(max(n for _, n, _ in sizes), ranges * block_rows)
    groups = parts_for(3 * max(n for _, _, n in sizes), ranges * query_rows)

    def place(batches):
        for batch in batches:
            for rows, x in by_width(batch):
                part = batch.take(pa.array(rows))
                found = shared.value[x.shape[1]].ranges_of(x, part.column("_id").to_numpy())
                lists = [pa.array(f.tolist(), pa.list_(pa.int32())) for f in found]
                yield pa.RecordBatch.from_arrays([*part.columns, *lists], names=["_id", "v", "width", "at", "first", "last"])

    schema = "_id bigint, v array<double>, width int, at array<int>, first array<int>, last array<int>"
    salt = lambda n: F.pmod(F.xxhash64("_id"), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = (
        few_twins(searched, k + 1)
        .mapInArrow(place, schema)
        .select("_id", "v", "width", F.posexplode("at").alias("curve", "range"), salt(blocks).alias("block"))
        .withColumn("part", spread(groups))
    )
    visits = F.explode(F.sequence(F.col("span.first") - 1, F.col("span.last") + 1))
    queries = (
        searched.where(is_query)
        .mapInArrow(place, schema)
        .select("_id", "v", "width", F.posexplode(F.arrays_zip("first", "last")).alias("curve", "span"), salt(groups).alias("part"))
        .select("_id", "v", "width", "curve", visits.alias("range"), "part")
        .withColumn("block", spread(blocks))
    )

    def rerank(own: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        if own.empty or others.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        x, ids = np.stack(own.v.to_numpy()), own._id.to_numpy()
        q, asked = np.stack(others.v.to_numpy()), others._id.to_numpy()
        # The quick form loses the digits that all vectors share, so it is taken around the block's middle, and
        # all that its rounding cannot tell from the kth are measured exactly.
        middle = x.mean(axis=0)
        xc, qc = x - middle, q - middle
        xx = (xc**2).sum(axis=1)
        far, scale = np.sqrt(xx.max()), np.abs(x).max() + np.abs(q).max()
        eps = np.finfo(float).eps * (x.shape[1] + 8)
        out = []
        for at in range(0, len(q), SLICE):
            near = xx[None, :] - 2 * (qc[at : at + SLICE] @ xc.T)
            for i, row in enumerate(near, at):
                row[ids == asked[i]] = np.inf
                length = np.sqrt((qc[i] ** 2).sum())
                slack = 2 * eps * (far + length) * (far + length + scale)
                kth = np.partition(row, k - 1)[k - 1] if len(row) > k else np.inf
                pick = np.flatnonzero(row <= kth + slack)
                pick = pick[ids[pick] != asked[i]]
                score = _distances(x[pick], q[i])
                best = np.lexsort((ids[pick], score))[:k]
                out.append(pd.DataFrame({"query_id": asked[i], "vec_id": ids[pick][best], "score": score[best]}))
        return pd.concat(out)

    keys = ["width", "curve", "range", "block", "part"]
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys))
    found = found.applyInPandas(rerank, "query_id bigint, vec_id bigint, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
