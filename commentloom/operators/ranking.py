"""Exact lowest-n selection that survives hot groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.functions.flags import sample_rank
from commentloom.session import materialize

_STEPS = 16  # steps of a rank's scale for each doubling


def _columns(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def first_per_key(df: DataFrame, key: list, order: list) -> DataFrame:
    """The first row per key.

    ``rank = 1`` lets Spark place a group limit before the shuffle, so each task sends one row
    per key at most: a key that holds a third of the table costs no more than any other.
    """
    window = W.partitionBy(*_columns(key)).orderBy(*_columns(order))
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def lowest_per_group(
    df: DataFrame, by: list[str], order: list, n: int, rank: str = "_rank"
) -> DataFrame:
    """The ``n`` lowest rows per group with their rank from 1, for tables that are small already."""
    window = W.partitionBy(*by).orderBy(*_columns(order))
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def _step(draw: Column) -> Column:
    """Where a hex rank lies on a scale whose steps double every ``_STEPS``; never falls as the rank rises."""
    return F.floor(F.log2(F.conv(F.substring(draw, 1, 15), 16, 10).cast("double") + 1) * _STEPS).cast("int")


def draw_per_group(
    df: DataFrame,
    by: list[str],
    n: int,
    seed,
    id_col: str = "id",
    before: list[str] = (),
    rank: str = "_rank",
) -> DataFrame:
    """The ``n`` rows per group that a seeded draw takes, with their rank from 1.

    Rows rank by ``before``, then md5(seed | id), id and a hash of the whole row.  A first pass counts rows per group
    and step of that order (a few hundred steps a group, summed before they are shuffled).  The step at which
    a group reaches ``n`` is its cut, and in a second pass every task drops the rows above it
    before anything moves: about n rows a group are shuffled, a sixteenth more at most than steps are fine, whatever the
    group's size or the session.  ``df`` must give the same ids in both passes.
    """
    near = under_cut(df, by, n, seed, id_col, before)
    mark = F.xxhash64(*[F.col(c) for c in df.columns])
    window = W.partitionBy(*by).orderBy(*before, "_draw", id_col, mark)
    return near.select(*df.columns, F.row_number().over(window).alias(rank)).filter(F.col(rank) <= n)


def under_cut(df: DataFrame, by: list[str], n: int, seed, id_col: str = "id", before: list[str] = ()) -> DataFrame:
    """The rows that a draw of ``n`` per group may take, with their rank ``_draw``."""
    keyed = df.withColumn("_draw", sample_rank(id_col, seed))
    keyed = keyed.withColumn("_place", F.struct(*before, _step(F.col("_draw")).alias("_step")))
    steps = keyed.groupBy(*by, "_place").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(W.partitionBy(*by).orderBy("_place"))
    full = F.when(F.col("_upto") >= n, F.col("_place"))
    cuts = steps.withColumn("_upto", upto).groupBy(*by).agg(F.min(full).alias("_cut"))
    # Written down, so that its size is known when the join is planned.
    cuts = materialize(cuts.select(*[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)], "_cut"), "cuts")
    same = F.lit(True)
    for i, b in enumerate(by):
        same = same & keyed[b].eqNullSafe(cuts[f"_by{i}"])
    near = keyed.join(cuts, same) if by else keyed.withColumn("_cut", cuts.select("_cut").scalar())
    return near.filter(F.col("_cut").isNull() | (F.col("_place") <= F.col("_cut")))


def bring_rows(df: DataFrame, drawn: DataFrame, keys: list[str], extra: list[str] = ()) -> DataFrame:
    """The rows of ``df`` that ``drawn`` names by ``keys``, with its ``extra`` columns.

    Draws carry keys only; this is the one step that moves whole rows, and only the chosen ones where
    Spark finds ``drawn`` small.  Keys that were drawn k times bring k rows, of more the ones with the
    smallest hash of all columns.
    """
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    chosen = drawn.groupBy(*named).agg(F.count("*").alias("_times"), *[F.min(e).alias(e) for e in extra])
    chosen = materialize(chosen, "chosen")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(F.col(f"_k{i}"))
    rows = df.withColumn("_mark", F.xxhash64(*df.columns)).join(chosen, same)
    nth = F.row_number().over(W.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_mark"))
    rows = rows.withColumn("_nth", nth).filter(F.col("_nth") <= F.col("_times"))
    return rows.select(*df.columns, *extra)
