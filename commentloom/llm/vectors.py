"""Shared steps of the two vector searches."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commentloom.llm.common import finite


def one_per_id(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(_id, v): usable vectors, one for each id; of different vectors under one id the smallest counts."""
    rows = df.select(df[id_col].cast("bigint").alias("_id"), df[vec_col].cast("array<double>").alias("v"))
    return rows.where(F.col("_id").isNotNull() & finite(F.col("v"))).groupBy("_id").agg(F.min("v").alias("v"))


def few_twins(vectors: DataFrame, most: int) -> DataFrame:
    """Of equal vectors the ``most`` with the smallest ids.  Every task drops the others before they are shuffled."""
    twins = Window.partitionBy("v").orderBy("_id")
    return vectors.withColumn("_twin", F.row_number().over(twins)).where(F.col("_twin") <= most).drop("_twin")


def parts_for(rows: int, size: int) -> int:
    return max(1, math.ceil(rows / size))


def matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of one width."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def by_width(batch: pa.RecordBatch, name: str = "v"):
    """(row numbers, matrix) for each vector width in the batch."""
    column = batch.column(name)
    widths = column.value_lengths().to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        yield rows, matrix(column.take(pa.array(rows)))
