"""Writers: CSV, bounded chunks, appended slices, and folding staging files in."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from commentloom.operators.dedup import dedup_by_id
from commentloom.operators.joins import exclude_seen
from commentloom.schemas import COMMENTS
from commentloom.sources.files import exists, read_text, remove, remove_named, write_text
from commentloom.sources.scan import STAGING_GLOB, conform, list_files

CHUNK_ROWS = 2500
_APPENDED = "train_append"  # fixed value: the leading part of appended files' names
_BASENAME = "mapreduce.output.basename"  # leading part of every file name of a write


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_chunks(
    df: DataFrame, path: str, size: int = CHUNK_ROWS, prefix: str = "part", mode: str = "append"
) -> None:
    """Parquet files of at most ``size`` rows; tasks write their own files, nothing shuffles."""
    df.write.mode(mode).option("maxRecordsPerFile", size).option(_BASENAME, prefix).parquet(path)


def append_slices(df: DataFrame, path: str, partition_by: list[str] = (), run: str = "") -> None:
    """Append ``train_append*`` files with unique names, which carry ``run``; existing data is neither read nor
    rewritten."""
    writer = df.write.mode("append").option(_BASENAME, f"{_APPENDED}{run}").partitionBy(*partition_by)
    writer.parquet(path)


@dataclass(frozen=True)
class Consolidation:
    files: int
    appended: int


def consolidate(
    spark: SparkSession, staging: str, main: str, against_main: bool = False
) -> Consolidation:
    """Fold staging files into the main data and remove them once the append has committed.

    The file list is fixed first, so files that arrive meanwhile are left for the next run.  A log beside the
    main data tells a later run how far a broken-off one came: the plan (run and files), then the count of a
    committed append, then nothing.  Without the count, files of that run in the main data are taken back and it starts anew;
    with it, only the removal of its staging files is finished.  So staging rows are appended once, wherever a
    run stops, without reading the main data.  ``against_main`` also drops ids the main data holds; it
    reads their id column only.
    """
    log = f"{main.rstrip('/')}/_consolidation"
    unfinished = read_text(spark, f"{log}/plan")
    if unfinished is not None:
        run, *planned = unfinished.split("\n")
        if exists(spark, f"{log}/appended"):
            _remove(spark, planned)
        else:
            remove_named(spark, main, f"{_APPENDED}{run}")
    remove(spark, log)
    files = list_files(spark, staging, STAGING_GLOB)
    if not files:
        return Consolidation(0, 0)
    run = f"_{uuid.uuid4().hex}"
    fresh = dedup_by_id(conform(spark.read.schema(COMMENTS).parquet(*files)))
    if against_main:
        fresh = exclude_seen(fresh, spark.read.schema("id string").parquet(main))
    seen = Observation("consolidate")
    write_text(spark, f"{log}/plan", "\n".join([run, *files]))
    append_slices(fresh.observe(seen, F.count("*").alias("n")), main, run=run)
    write_text(spark, f"{log}/appended", str(seen.get["n"]))
    _remove(spark, files)
    remove(spark, log)
    return Consolidation(len(files), seen.get["n"])


def _remove(spark: SparkSession, files: list[str]) -> None:
    """Remove listed files; those that are gone already do not matter."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in files:
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))
        path.getFileSystem(conf).delete(path, False)
