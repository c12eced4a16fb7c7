"""Row numbers, chunks and batches over whole tables, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from commentloom.functions.flags import sample_rank
from commentloom.operators.ranking import first_per_key
from commentloom.session import materialize

# The leading parts of chunk names and of made-up ids.
CHUNK_PREFIX, ID_PREFIX = "migration_base", "migrated_"

_POSITION_MASK = (1 << 33) - 1  # the low bits of monotonically_increasing_id()


def row_index(df: DataFrame, order: list | None = None, out: str = "row_index") -> DataFrame:
    """Consecutive numbers from 0 in ``order``, or in stored order if none is given.

    Rows are named by 128 bits of their content, which also closes the sort key.  Only the key and the name are sorted and
    written down; positions there plus the counts of the partitions before them give each name its first number,
    and these join the rows, which are shuffled once and never sorted by the key.  Rows that are
    equal throughout are one name with consecutive numbers: a task sends one of them, and it is repeated in the
    end.  ``df`` is read twice and must give the same rows again.  Without an order the rows themselves are
    written down once, as they are.
    """
    if not order:
        return _numbered(df, out)
    numbers = (
        _numbered(sorted_names(_named(df), order), "_number")
        .groupBy("_h1", "_h2")
        .agg(F.min("_number").alias("_first"), F.count("*").alias("_copies"))
    )
    copies = F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1)
    return one_per_name(df).join(numbers, ["_h1", "_h2"]).select(*df.columns, F.explode(copies).alias(out))


def one_per_name(df: DataFrame) -> DataFrame:
    """One of the rows of each name, with the name's (_h1, _h2)."""
    return first_per_key(_named(df), ["_h1", "_h2"], ["_h1"])


def _named(df: DataFrame) -> DataFrame:
    return df.select("*", F.xxhash64(*df.columns).alias("_h1"), F.xxhash64(F.lit(1), *df.columns).alias("_h2"))


def sorted_names(named: DataFrame, order: list, keep: list[str] = ()) -> DataFrame:
    """The rows' names in order; only they and the key are sorted.  Equal names still split over tasks by a running id."""
    tied = named.withColumn("_tie", F.monotonically_increasing_id())
    return tied.orderBy(*order, "_h1", "_h2", "_tie").select("_h1", "_h2", *keep)


def _numbered(df: DataFrame, out: str) -> DataFrame:
    """Consecutive numbers from 0 in stored order: ``df`` is computed and written once with each row's place, and each
    partition's rows add the count of all partitions before it.  The broadcast side has one row per partition.
    """
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]  # parquet has no such columns
    placed = materialize(df.drop(*void).withColumn("_at", F.monotonically_increasing_id()), "placed")
    parts = (
        placed.withColumns({c: F.lit(None) for c in void})
        .select(*df.columns, "_at")
        .withColumn("_part", F.shiftright("_at", 33))
        .withColumn("_pos", F.col("_at").bitwiseAND(F.lit(_POSITION_MASK)))
        .drop("_at")
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_offset") + F.col("_pos"))
        .drop("_part", "_pos", "_offset")
    )


def random_row_index(
    df: DataFrame, id_col: str = "id", seed="", out: str = "row_index", digits: int = 4
) -> DataFrame:
    """Consecutive numbers from 0 in md5(seed | id) order, as one lazy plan.

    ``id_col`` must be unique.  md5 spreads ids evenly over 16^digits buckets whatever their
    distribution, so bucket counts give the offsets and each bucket is ranked on its own.  Bucket counts are
    broadcast: at most 16^4 rows.
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be 1 to 4")
    ranked = df.withColumn("_md5", sample_rank(id_col, seed)).withColumn(
        "_bucket", F.substring("_md5", 1, digits)
    )
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (  # at most 16^digits rows
        ranked.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    in_bucket = W.partitionBy("_bucket").orderBy("_md5", id_col)
    return (
        ranked.withColumn("_rn", F.row_number().over(in_bucket))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(out, F.col("_offset") + F.col("_rn") - 1)
        .drop("_md5", "_bucket", "_rn", "_offset")
    )


def assign_chunks(
    df: DataFrame, key: list, size: int = 2500, prefix: str = CHUNK_PREFIX
) -> DataFrame:
    """Chunk number and part name per row, in key order."""
    return _chunk(row_index(df, key, "_index"), size, prefix)


def named_chunks(
    df: DataFrame, key: list[str], size: int = 2500, prefix: str = CHUNK_PREFIX
) -> DataFrame:
    """What ``assign_chunks`` gives, with every row's name and key columns instead of the row."""
    return _chunk(_numbered(sorted_names(_named(df), key, key), "_index"), size, prefix)


def _chunk(numbered: DataFrame, size: int, prefix: str) -> DataFrame:
    return (
        numbered.withColumn("chunk", F.floor(F.col("_index") / size))
        .withColumn("chunk_name", F.format_string(f"{prefix}_part_%03d", "chunk"))
        .drop("_index")
    )


def build_batches(df: DataFrame, size: int = 20, id_col: str = "id", seed="") -> DataFrame:
    """Batch number and position within the batch, in random order of ids."""
    return (
        random_row_index(df, id_col, seed, "_index")
        .withColumn("batch", F.floor(F.col("_index") / size))
        .withColumn("pos", F.pmod(F.col("_index"), F.lit(size)))
        .drop("_index")
    )


def fallback_ids(df: DataFrame, order: list | None = None) -> DataFrame:
    """Missing ids become ``migrated_<row number>``."""
    if "id" not in df.columns:
        df = df.withColumn("id", F.lit(None).cast("string"))
    made = F.concat(F.lit(ID_PREFIX), F.col("_index").cast("string"))
    return row_index(df, order, "_index").withColumn("id", F.coalesce("id", made)).drop("_index")
