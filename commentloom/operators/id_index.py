"""A growing set of ids on disk, in hash buckets, so that a lookup reads only the buckets it asks for.

The set is a folder of runs, one for each ``add``; a run is a narrow table partitioned by the id's bucket.  A run counts
once its job has committed, so what a lost job left behind is never read.  Runs may overlap, since a set does not
mind: merging writes the merged run first and removes its parts afterwards, and may stop anywhere between.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.session import shuffle_width
from commentloom.sources.files import exists, file_system, remove

BUCKETS = 256
MAX_RUNS = 16  # more than these and the smaller half is merged


def bucket_of(col, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a job has written ``path`` to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def runs(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(bytes, path) of the set's committed runs, smallest first."""
    fs, target = file_system(spark, path)
    if not fs.exists(target):
        return []
    found = [s.getPath() for s in fs.listStatus(target) if s.getPath().getName().startswith("run=")]
    return sorted((fs.getContentSummary(p).getLength(), p.toString()) for p in found if committed(spark, p.toString()))


def read_ids(spark: SparkSession, path: str, buckets: list[int] | None = None, but: str | None = None) -> DataFrame:
    """(id, bucket) of the set, of ``buckets`` only if given and without the run ``but``; other buckets' folders are not opened."""
    paths = [p for _, p in runs(spark, path) if not p.endswith(f"/run={but}")]
    if not paths:
        return spark.createDataFrame([], "id string, bucket int")
    ids = spark.read.schema("id string, bucket int").option("basePath", path).parquet(*paths).select("id", "bucket")
    return ids if buckets is None else ids.filter(F.col("bucket").isin(buckets))


def add_ids(ids: DataFrame, path: str, buckets: int = BUCKETS, run: str | None = None) -> None:
    """Add the column ``id`` of ``ids`` as a run of its own, one file for each bucket; a run of the same name is replaced."""
    spark, run = ids.sparkSession, run or uuid.uuid4().hex
    rows = ids.select(F.col("id").cast("string").alias("id")).distinct().withColumn("bucket", bucket_of("id", buckets))
    _write(rows, path, run)
    old = [p for _, p in runs(spark, path) if not p.endswith(f"/run={run}")]
    if len(old) >= MAX_RUNS:
        part = old[: MAX_RUNS // 2]
        merged = spark.read.schema("id string, bucket int").option("basePath", path).parquet(*part)
        _write(merged.select("id", "bucket").distinct(), path, uuid.uuid4().hex)
        for p in part:
            remove(spark, p)


def _write(rows: DataFrame, path: str, run: str) -> None:
    width = min(shuffle_width(rows.sparkSession), BUCKETS)
    rows.repartition(width, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/run={run}")


def unseen(
    rows: DataFrame, path: str, buckets: int = BUCKETS, id_col: str = "id", but: str | None = None
) -> DataFrame:
    """``rows`` whose id the set, without its run ``but``, lacks; a null id is an id like any other.

    The rows' distinct buckets, a bounded list, choose what is read, so ``rows`` should be written down already.
    """
    marked = rows.withColumn("_bucket", bucket_of(id_col, buckets))
    asked = sorted(r[0] for r in marked.select("_bucket").distinct().collect())
    known = read_ids(rows.sparkSession, path, asked, but)
    same = (marked["_bucket"] == known["bucket"]) & marked[id_col].eqNullSafe(known["id"])
    return marked.join(known, same, "left_anti").drop("_bucket")
