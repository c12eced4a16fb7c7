"""Deduplication and set operations.  Every keep-first rule has an explicit order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from commentloom.functions.text import dedup_key
from commentloom.operators.ranking import first_per_key


def _order(df: DataFrame, order: list | None) -> list:
    """The given order, or time, id and the text, as far as the table has them."""
    return order or [c for c in ("created_utc", "id", "text", "body") if c in df.columns]


def dedup_by_id(df: DataFrame, order: list | None = None, id_col: str = "id") -> DataFrame:
    return first_per_key(df, [id_col], _order(df, order))


def dedup_by_text(df: DataFrame, order: list | None = None, col: str = "text") -> DataFrame:
    return first_per_key(df, [col], _order(df, order))


def normalised_key(col: str, ascii_strict: bool = False) -> Column:
    """Digest of the normalised text: 64 characters shuffle where a second text would.

    Text without any a-z or digit has an empty key.  It falls back to the exact text unless
    ``ascii_strict`` asks for all such texts to count as one.
    """
    key = dedup_key(col)
    if not ascii_strict:
        key = F.when(key != "", key).otherwise(F.concat(F.lit("\u0001"), F.col(col)))
    return F.sha2(key, 256)


def dedup_normalised(
    df: DataFrame, order: list | None = None, col: str = "text", ascii_strict: bool = False
) -> DataFrame:
    return first_per_key(df, [normalised_key(col, ascii_strict)], _order(df, order))


def two_lock_dedup(
    df: DataFrame, order: list | None = None, col: str = "text", ascii_strict: bool = False
) -> DataFrame:
    """First by id, then by normalised text among the survivors."""
    return dedup_normalised(dedup_by_id(df, order), order, col, ascii_strict)


def dedup_report(df: DataFrame, key) -> DataFrame:
    """Rows before, dropped and left for keep-first on one key, from counts per key alone."""
    key = F.col(key) if isinstance(key, str) else key
    per_key = df.groupBy(key.alias("_key")).agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0))
    return per_key.agg(
        total.alias("n_before"),
        (total - F.count("*")).alias("n_dropped"),
        F.count("*").alias("n_after"),
    )


def two_lock_report(
    df: DataFrame, order: list | None = None, col: str = "text", ascii_strict: bool = False
) -> DataFrame:
    """Rows before, dropped by id, dropped by text and left, without moving any text twice."""
    survivors = dedup_by_id(df, order).select(normalised_key(col, ascii_strict).alias("_key"))
    before = df.agg(F.count("*")).scalar()
    return (
        dedup_report(survivors, "_key")
        .withColumn("_all", before)
        .select(
            F.col("_all").alias("n_before"),
            (F.col("_all") - F.col("n_before")).alias("dropped_by_id"),
            F.col("n_dropped").alias("dropped_by_text"),
            "n_after",
        )
    )


def cross_slice_dedup(df: DataFrame) -> DataFrame:
    """One seen-id set across all units: the first unit in fetch order keeps the id."""
    return dedup_by_id(df, ["subreddit_pos", "year_month", "created_utc", "body"])


def union_tiers(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def merge_lexicon(*sources: DataFrame, min_len: int = 4, new_only: bool = False) -> DataFrame:
    """Ordered union of (category, term, pos) tables, earlier sources first.

    The first occurrence of a term wins, short terms go, categories come out upper-cased.  With
    ``new_only`` the first source is the cache and only terms it lacks are returned.
    """
    ranked = union_tiers(
        *[
            df.select(
                F.upper("category").alias("category"),
                "term",
                F.struct(F.lit(i).alias("source"), F.col("pos").cast("long").alias("pos")).alias(
                    "place"
                ),
            )
            for i, df in enumerate(sources)
        ]
    ).filter(F.length("term") >= min_len)
    merged = ranked.groupBy("category", "term").agg(F.min("place").alias("place"))
    if new_only:
        merged = merged.filter(F.col("place.source") > 0)
    # A category's term list is a lexicon, not data: hundreds of rows.
    window = W.partitionBy("category").orderBy("place.source", "place.pos", "term")
    return merged.select(
        "category", "term", (F.row_number().over(window) - 1).cast("long").alias("pos")
    )
