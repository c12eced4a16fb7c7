"""Incremental ingest and running reports with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from commentloom.functions.flags import toxic, year_month
from commentloom.operators.audit import CLEAN, TOXIC_POOL, against_targets, with_status
from commentloom.operators.dedup import dedup_by_id
from commentloom.operators.filters import backfill_flags, drop_tombstones
from commentloom.operators.id_index import add_ids, committed, runs, unseen
from commentloom.operators.ranking import first_per_key
from commentloom.schemas import COMMENTS, FLAGS
from commentloom.session import materialize
from commentloom.sources.files import file_system, remove
from commentloom.sources.scan import STAGING_GLOB, conform
from commentloom.sources.sinks import append_slices

MONTH = "year_month"


def read_landing(
    spark: SparkSession,
    landing: str,
    glob: str = STAGING_GLOB,
    schema: T.StructType = COMMENTS,
    max_files: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(landing)


def stream_ingest(
    spark: SparkSession,
    landing: str,
    main: str,
    checkpoint: str,
    glob: str = STAGING_GLOB,
    max_files: int | None = None,
    index: str | None = None,
) -> StreamingQuery:
    """Fold arriving files into the main table, one row per id over all time.

    Months arrive in any order, so an event-time watermark would drop old comments as late, and
    state without one would grow for ever.  The memory is a bucketed id set instead (``id_index``,
    beside the main data unless ``index`` names another folder): a micro-batch reads the buckets of its own ids
    and never the main table.  It first settles ids and times alone; then whole rows are shuffled once, and not written
    down besides the main table; of few new ids only their rows move.  What a batch is about to append is noted first; a batch
    that was broken off is settled from that note and the main table's months in it, so a replay
    appends each id once.  A main table without a set gets one from its ids.
    """
    arrived = drop_tombstones(conform(read_landing(spark, landing, glob, max_files=max_files)))
    index = index or f"{main.rstrip('/')}/_ids"
    return (
        arrived.writeStream.foreachBatch(lambda batch, _: _append_new(batch, main, index))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _append_new(batch: DataFrame, main: str, index: str) -> None:
    spark, note = batch.sparkSession, f"{index}/note"
    settle(spark, main, index)
    month = F.coalesce(year_month("created_utc"), F.lit("unknown"))
    # The first row per id is known by its time; texts, which only tell rows of one id and time apart, stay where they are.
    timeless = F.bool_or(F.col("created_utc").isNull())
    firsts = batch.groupBy("id").agg(F.when(~timeless, F.min("created_utc")).alias("created_utc"))
    firsts = materialize(firsts.withColumn(MONTH, month), "arrived")
    unseen(firsts, index).select("id", MONTH, "created_utc").write.parquet(note)
    new = spark.read.schema(f"{_NOTE}, created_utc long").parquet(note)
    wanted, keyed = new.select(_key().alias("_key")), batch.withColumn("_key", _key())
    if wanted.count() <= _FEW:  # nothing else moves
        keyed = keyed.join(F.broadcast(wanted), "_key", "left_semi")
    rows = dedup_by_id(keyed, id_col="_key").join(wanted, "_key", "left_semi")
    append_slices(rows.drop("_key").withColumn(MONTH, month), main, [MONTH])
    add_ids(new, index)
    remove(spark, note)


def _key() -> Column:
    """Time and id as one key that is never null and differs where either does."""
    time, name = F.col("created_utc").cast("string"), F.concat(F.lit("="), F.col("id"))
    return F.concat(F.coalesce(time, F.lit("")), F.lit(" "), F.coalesce(name, F.lit("")))


_FEW = 100_000  # keys that are broadcast
_NOTE = f"id string, {MONTH} string"


def settle(spark: SparkSession, main: str, index: str) -> None:
    """Bring the id set up to the main table: from a broken-off batch's note, or from all ids where there is no set."""
    note = f"{index}/note"
    if not runs(spark, index):
        add_ids(_ids_of(spark, main), index)
    elif committed(spark, note):
        noted = spark.read.schema(_NOTE).parquet(note)
        stored = _ids_of(spark, main)
        same = (stored[MONTH] == noted[MONTH]) & stored["id"].eqNullSafe(noted["id"])
        add_ids(stored.join(noted, same, "left_semi"), index)  # reads the noted months only
    remove(spark, note)


def _ids_of(spark: SparkSession, main: str) -> DataFrame:
    if _has_data(spark, main):
        return spark.read.schema(_NOTE).parquet(main)
    return spark.createDataFrame([], _NOTE)


def _has_data(spark: SparkSession, main: str) -> bool:
    """Whether the main folder holds more than the id set and other hidden entries."""
    fs, target = file_system(spark, main)
    return fs.exists(target) and any(s.getPath().getName()[0] not in "._" for s in fs.listStatus(target))


def windowed_counts(
    rows: DataFrame,
    ts: str = "ts",
    by: str = "subreddit",
    width: str = "1 day",
    delay: str = "1 day",
) -> DataFrame:
    """Rows per tumbling window and group.  Streams emit a window once the watermark passes it."""
    return (
        rows.withWatermark(ts, delay)
        .groupBy(F.window(ts, width), by)
        .agg(F.count("*").alias("n"))
        .select(F.unix_seconds("window.start").alias("window_start"), by, "n")
    )


def stream_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        counts.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def stream_label_audit(
    labelled: DataFrame, totals: str, checkpoint: str, id_col: str = "id"
) -> StreamingQuery:
    """Keep running label totals, an id counted once.

    A batch counts the rows whose id no earlier batch had (of several in a batch the first by content), adds them to the totals up to
    the batch before and writes the sum as one row of its own.  The ids go into a bucketed set, as a run named
    by the batch, which the batch itself does not look at; so a replayed batch writes the same row again.  Only the newest
    two rows are kept, however long the stream runs.
    """
    index = f"{totals.rstrip('/')}/_ids"

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, f"batch{batch_id}"
        once = first_per_key(batch.withColumn("_mark", F.xxhash64(*batch.columns)), [id_col], ["_mark"]).drop("_mark")
        once = materialize(once, "labelled")
        fresh = materialize(unseen(once, index, id_col=id_col, but=name), "fresh")
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in FLAGS]
        bad = F.count_if(toxic())
        mine = backfill_flags(fresh, FLAGS).agg(*sums, (F.count("*") - bad).alias(CLEAN), bad.alias(TOXIC_POOL))
        earlier = [b for b in _batches(spark, totals) if b < batch_id]
        if earlier:
            mine = mine.unionByName(spark.read.schema(_TOTALS).parquet(f"{totals.rstrip('/')}/upto={earlier[-1]}"))
        everything = mine.agg(*[F.sum(c).alias(c) for c in _METRICS]).coalesce(1)
        everything.write.mode("overwrite").parquet(f"{totals.rstrip('/')}/upto={batch_id}")
        add_ids(fresh.select(F.col(id_col).alias("id")), index, run=name)
        for old in earlier[:-1]:
            remove(spark, f"{totals.rstrip('/')}/upto={old}")

    return (
        labelled.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_METRICS = [*FLAGS, CLEAN, TOXIC_POOL]
_TOTALS = ", ".join(f"{c} long" for c in _METRICS)


def _batches(spark: SparkSession, totals: str) -> list[int]:
    """Batches with committed totals, oldest first."""
    fs, target = file_system(spark, totals)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    numbers = sorted(int(n[5:]) for n in names if n.startswith("upto="))
    return [n for n in numbers if committed(spark, f"{totals.rstrip('/')}/upto={n}")]


def running_audit(spark: SparkSession, totals: str, targets: DataFrame) -> DataFrame:
    """Audit table over all batches so far, from the newest totals alone."""
    done = _batches(spark, totals)
    if done:
        newest = spark.read.schema(_TOTALS).parquet(f"{totals.rstrip('/')}/upto={done[-1]}")
    else:
        newest = spark.range(1).select(*[F.lit(0).cast("long").alias(c) for c in _METRICS])
    counts = newest.unpivot([], _METRICS, "metric", "current")
    return with_status(against_targets(counts, targets))
