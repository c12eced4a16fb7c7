"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.session import scratch_path


_KEPT: dict[str, dict] = {}


def worker_state(owner: str) -> dict:
    """What a Python worker keeps between tasks for one operator.

    A worker outlives jobs and stages, so only the operator that ran last keeps anything; what the one before kept is
    given back at once.
    """
    if owner not in _KEPT:
        _KEPT.clear()
        _KEPT[owner] = {}
        gc.collect()
        pa.default_memory_pool().release_unused()
    return _KEPT[owner]


def give_back() -> None:
    """What the allocators of a worker hold unused goes back to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


@contextmanager
def setting(spark, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run inside; what was set before comes back."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text (null counts as empty), under names that no input column can clash with."""
    return df.select(df[id_col].alias("_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("_text"))


def texts_of(batch: pa.RecordBatch, column: str = "_text") -> list[str]:
    return batch.column(column).to_pylist()


def stored(df: DataFrame, label: str, **options) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and read back, with the path to discard later; ``options`` are the writer's."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def finite(vector: Column) -> Column:
    """Whether a vector is there, not empty and free of null, NaN and infinite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def numbered(texts: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct words of ``texts``, every word's number among them in order, and the texts' lengths."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    coded = pa.array(list(chain.from_iterable(texts)), pa.large_string()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), lengths


def summed(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``; a run may be empty."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return total[ends] - total[ends - lengths]


def few_rows(df: DataFrame, rows: int, tasks: int = 32) -> DataFrame:
    """About ``rows`` rows at most, the first ones of evenly spaced input partitions, which are read no further.

    For fitting things that change only the speed; nothing is shuffled and no task sees more than its share.
    """
    parts = max(1, df.rdd.getNumPartitions())
    stride = -(-parts // tasks)
    each = max(1, rows // -(-parts // stride))

    def head(batches):
        left = each if TaskContext.get().partitionId() % stride == 0 else 0
        if left:
            for batch in batches:
                yield batch.slice(0, left)
                left -= batch.num_rows
                if left <= 0:
                    break

    return df.mapInArrow(head, df.schema)
