"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.llm.common import discard, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> tuple[DataFrame, list[str]]:
    """(node, root) for every node with a link, root being the smallest node reachable.

    ``edges`` has two columns a > b of one orderable type.  Each round links every larger neighbour to a
    node's smallest one, then every smaller neighbour; rounds grow with the logarithm of the component.
    Minima are pre-aggregated before they are shuffled, and the joins carry one row per node on one side, so
    a hub with a large share of the rows can be split by the engine.  Rounds are written to the shared
    folder, which cuts the lineage and survives lost executors.  Also returns the paths that stay in use.
    """
    spark = edges.sparkSession
    edges, path = stored(edges.select(F.col(edges.columns[0]).alias("a"), F.col(edges.columns[1]).alias("b")).distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of a node now point at the node's minimum.
        large = (
            both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        # Of what a node points at, all but the smallest point at the smallest.
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(floor, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        fresh, fresh_path = stored(small.where(F.col("a") != F.col("b")).distinct(), "edges")
        discard(spark, path)
        edges, path = fresh, fresh_path
        now = _state(edges)
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()), [path]
