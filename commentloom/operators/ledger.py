"""Id ledger, chunk manifest and resuming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_BLOCK = 1000  # chunks per block of the running total


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id string").parquet(path)


def ledger_append(published: DataFrame, path: str) -> None:
    """Record ids of rows that are already durable: pass the table as read back from disk.

    Ids the ledger holds are left out, so a repeated call after a lost job changes nothing.
    """
    ids = published.select(F.col("id").cast("string").alias("id")).distinct()
    if _exists(published.sparkSession, path):
        ids = ids.join(read_ledger(published.sparkSession, path), "id", "left_anti")
    ids.write.mode("append").parquet(path)


def reconcile_ledger(data: DataFrame, ledger: DataFrame) -> DataFrame:
    """Ids that are published but not in the ledger, after a crash between the two writes."""
    return data.select("id").distinct().join(ledger, "id", "left_anti")


def pending_chunks(chunked: DataFrame, manifest: DataFrame) -> DataFrame:
    return chunked.join(manifest.select("chunk_name"), "chunk_name", "left_anti")


def manifest(chunked: DataFrame) -> DataFrame:
    """Rows per chunk and the running total.

    The total is a block offset plus a sum within the block, so no window sees more than the
    blocks or one block's chunks.
    """
    per_chunk = (
        chunked.groupBy("chunk", "chunk_name")
        .agg(F.count("*").alias("n_rows"))
        .withColumn("_block", F.floor(F.col("chunk") / _BLOCK))
    )
    before = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        per_chunk.groupBy("_block")
        .agg(F.sum("n_rows").alias("_n"))
        .select("_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = W.partitionBy("_block").orderBy("chunk")
    return (
        per_chunk.withColumn("_sum", F.sum("n_rows").over(inside))
        .join(blocks, "_block")
        .select(
            "chunk", "chunk_name", "n_rows", (F.col("_offset") + F.col("_sum")).alias("total_rows")
        )
    )


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target)
