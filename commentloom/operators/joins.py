"""Equi joins of the labelling flow.  No hints: ledgers and label tables grow."""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach_labels(df: DataFrame, labels: DataFrame, how: str = "left", on="id") -> DataFrame:
    """Join labels on a unique row key; ``left`` keeps unlabelled rows, ``inner`` drops them."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    return df.join(labels, on, how)


def exclude_seen(df: DataFrame, ledger: DataFrame, on="id") -> DataFrame:
    return df.join(ledger, on, "left_anti")


def exclude_sampled(pool: DataFrame, sampled: DataFrame, on="id") -> DataFrame:
    return pool.join(sampled.select(on), on, "left_anti")
