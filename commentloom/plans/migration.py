"""Resumable migration of labelled rows into numbered chunks of training records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.operators import filters, formatting, indexing, ledger
from commentloom.operators.ledger import _exists as exists
from commentloom.schemas import FLAGS

MANIFEST = "chunk long, chunk_name string, n_rows long, total_rows long"


def migrate(
    spark: SparkSession,
    rows: DataFrame,
    out: str,
    state: str,
    system_prompt: str,
    text: str = "body",
    size: int = 2500,
    max_chunks: int | None = None,
) -> DataFrame:
    """Write the chunks that ``state`` does not list yet, then list them; returns the manifest so far.

    Rows are numbered by id, so a chunk holds the same rows in every run; a chunk that an interrupted run left
    half written is replaced as a whole.  ``max_chunks`` ends a run early.  Numbers go to names of rows (``indexing``);
    only the rows of chunks that are written move, and a chunk goes to one task, which writes it as one file.
    """
    filled = filters.backfill_flags(indexing.fallback_ids(filters.require_columns(rows, [text])))
    flags = {c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) for c in FLAGS}
    records = formatting.to_training_record(filled.withColumns(flags), text)
    chunked = indexing.named_chunks(records, ["id"], size)
    done = spark.read.schema(MANIFEST).parquet(state) if exists(spark, state) else spark.createDataFrame([], MANIFEST)
    pending = ledger.pending_chunks(chunked, done)
    if max_chunks is not None:
        last = F.coalesce(done.agg(F.max("chunk")).scalar(), F.lit(-1)) + max_chunks
        pending = pending.filter(F.col("chunk") <= last)
    # Chunks follow the ids, so rows outside the pending ids' range are dropped before anything moves.
    low, high = pending.agg(F.min("id"), F.max("id")).first()
    near = records.filter(F.col("id").between(F.lit(low), F.lit(high)))
    rows = indexing.one_per_name(near).join(pending.drop("id"), ["_h1", "_h2"]).drop("_h1", "_h2", "chunk")
    messages = formatting.to_chatml(rows, system_prompt).repartition("chunk_name")
    writer = messages.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("chunk_name").parquet(out)
    fresh = ledger.manifest(chunked).join(pending.select("chunk_name").distinct(), "chunk_name", "left_semi")
    fresh.select("chunk", "chunk_name", "n_rows", "total_rows").write.mode("append").parquet(state)
    return spark.read.schema(MANIFEST).parquet(state)
