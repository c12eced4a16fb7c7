"""Distribution reports, target shortfalls and the next action."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.functions.flags import pct, toxic
from commentloom.operators.dedup import dedup_by_text, two_lock_dedup
from commentloom.operators.filters import backfill_flags
from commentloom.schemas import CATEGORY_FLAGS, CORE_FLAGS, FLAGS

CLEAN = "clean_data"
TOXIC_POOL = "toxic_pool"


def is_toxic(df: DataFrame, out: str = "is_toxic") -> DataFrame:
    return backfill_flags(df, CORE_FLAGS).withColumn(out, toxic())


def class_split(df: DataFrame) -> DataFrame:
    """Total, toxic and clean rows.  Unlabelled rows count as clean and are shown apart."""
    n, bad = F.count("*"), F.count_if(toxic())
    unlabelled = F.count_if(F.coalesce(*[F.col(c) for c in CORE_FLAGS]).isNull())
    return (
        backfill_flags(df, CORE_FLAGS)
        .agg(n.alias("total"), bad.alias("toxic"), unlabelled.alias("unlabelled"))
        .select(
            "total",
            "toxic",
            (F.col("total") - F.col("toxic")).alias("clean"),
            "unlabelled",
            pct(F.col("toxic"), F.col("total")).alias("toxic_pct"),
            pct(F.col("total") - F.col("toxic"), F.col("total")).alias("clean_pct"),
        )
    )


def _flag_totals(df: DataFrame, flags: list[str]) -> DataFrame:
    """One row of sums, then unpivoted: the table itself is never multiplied by the flags."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in flags]
    return (
        backfill_flags(df, flags)
        .agg(F.count("*").alias("total"), *sums)
        .unpivot("total", flags, "category", "n")
    )


def category_breakdown(df: DataFrame, flags: list[str] = FLAGS) -> DataFrame:
    return _flag_totals(df, flags).select(
        "category", "n", "total", pct(F.col("n"), F.col("total")).alias("pct")
    )


def targets_from_goal(
    spark: SparkSession, goal: int = 50000, categories: list[str] = CATEGORY_FLAGS
) -> DataFrame:
    """Half of the goal clean, the rest toxic and split evenly over four categories."""
    clean = goal // 2
    toxic_goal = goal - clean
    rows = [(c, toxic_goal // 4, i) for i, c in enumerate(categories)]
    rows += [(CLEAN, clean, len(rows))]
    return spark.createDataFrame(rows, "metric string, goal long, ord int")


def deduped(df: DataFrame, dedup: str | None) -> DataFrame:
    """The rows a report counts: all, unique texts, or unique ids and normalised texts."""
    if dedup is None:
        return df
    if dedup == "text":
        return dedup_by_text(df)
    if dedup == "two_lock":
        return two_lock_dedup(df)
    raise ValueError("dedup must be None, 'text' or 'two_lock'")


def current_counts(df: DataFrame, dedup: str | None = None) -> DataFrame:
    """Current count per metric: every flag, the clean rows and the toxic rows."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in FLAGS]
    bad = F.count_if(toxic())
    return (
        backfill_flags(deduped(df, dedup), FLAGS)
        .agg(*sums, (F.count("*") - bad).alias(CLEAN), bad.alias(TOXIC_POOL))
        .unpivot([], [*FLAGS, CLEAN, TOXIC_POOL], "metric", "current")
    )


def against_targets(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Every target with its current count; a metric never seen counts as zero."""
    current = F.coalesce("current", F.lit(0)).cast("long")
    return targets.join(counts, "metric", "left").select(
        "ord", "metric", current.alias("current"), "goal"
    )


def shortfalls(df: DataFrame, targets: DataFrame, dedup: str | None = None) -> DataFrame:
    missing = F.greatest(F.lit(0).cast("long"), F.col("goal") - F.col("current"))
    return against_targets(current_counts(df, dedup), targets).withColumn("shortfall", missing)


def priority_category(short: DataFrame) -> DataFrame:
    """The largest category shortfall, ties to the first target; no row if all are met."""
    return (
        short.filter((F.col("shortfall") > 0) & ~F.col("metric").isin(CLEAN, TOXIC_POOL))
        .orderBy(F.desc("shortfall"), "ord")
        .limit(1)
    )


def with_status(counts: DataFrame) -> DataFrame:
    need = (F.col("goal") - F.col("current")).cast("string")
    status = F.when(F.col("current") >= F.col("goal"), "MET").otherwise(
        F.concat(F.lit("SHORT ("), need, F.lit(" needed)"))
    )
    return counts.withColumn("status", status)


def audit_status(df: DataFrame, targets: DataFrame, dedup: str | None = "two_lock") -> DataFrame:
    return with_status(against_targets(current_counts(df, dedup), targets))


def next_action(audit: DataFrame) -> DataFrame:
    """0 when all goals are met, 2 when a category is short, 3 when only clean rows are."""
    short = F.col("current") < F.col("goal")
    is_clean = F.col("metric") == CLEAN
    action = (
        F.when(F.count_if(short & ~is_clean) > 0, 2).when(F.count_if(short) > 0, 3).otherwise(0)
    )
    return audit.agg(action.cast("int").alias("action"))


def distinct_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, distinct ids, distinct texts and duplicate rows.

    Texts are compared by digest, so the distinct count moves 64 characters per text.
    """
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(
        F.count("*").alias("total"),
        count("id").alias("unique_ids"),
        count(F.sha2("text", 256)).alias("unique_texts"),
    ).withColumn("duplicates", F.col("total") - F.col("unique_texts"))


def slice_sketches(df: DataFrame, id_col: str = "id", text_col: str = "text", log_size: int = 12) -> DataFrame:
    """One row: how many rows a slice of a table has, and sketches of its distinct ids and texts, each of 2^log_size bytes at most."""
    known = [F.col(id_col).isNotNull(), F.col(text_col).isNotNull()]
    ids, texts = (
        F.hll_sketch_agg(F.when(k, F.xxhash64(c)), F.lit(log_size)) for k, c in zip(known, (id_col, text_col), strict=True)
    )
    return df.agg(F.count("*").alias("n_rows"), ids.alias("ids"), texts.alias("texts"))


def save_sketches(df: DataFrame, path: str, slice_name: str, **columns) -> None:
    """Write a slice's sketches below ``path``; a slice written again replaces itself."""
    slice_sketches(df, **columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/slice={slice_name}")


def sketched_profile(sketches: DataFrame) -> DataFrame:
    """``distinct_profile`` of all slices together, from their sketches alone: no row of the table is read.

    Rows are exact; the standard error of the distinct counts is about 1.04 / sqrt(2^log_size), 1.6 % as they come.
    """
    distinct = lambda c: F.hll_sketch_estimate(F.hll_union_agg(c))
    whole = sketches.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"),
        distinct("ids").alias("unique_ids"),
        distinct("texts").alias("unique_texts"),
    )
    return whole.withColumn("duplicates", F.greatest(F.lit(0), F.col("total") - F.col("unique_texts")))


def length_profile(df: DataFrame, col: str = "text") -> DataFrame:
    size = F.length(col)
    return df.agg(
        F.round(F.avg(size), 4).alias("avg_len"),
        F.min(size).cast("long").alias("min_len"),
        F.max(size).cast("long").alias("max_len"),
    )


def top_subreddits(df: DataFrame, k: int = 5) -> DataFrame:
    counts = df.filter("subreddit IS NOT NULL").groupBy("subreddit").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "subreddit").limit(k)


def monthly_distribution(df: DataFrame) -> DataFrame:
    return (
        df.filter("year_month IS NOT NULL")
        .groupBy("year_month")
        .agg(F.count("*").alias("n"))
        .orderBy("year_month")
    )


def toxicity_by_subreddit(df: DataFrame) -> DataFrame:
    return (
        backfill_flags(df, CORE_FLAGS)
        .groupBy("subreddit")
        .agg(F.count("*").alias("n"), F.count_if(toxic()).alias("toxic"))
        .withColumn("toxic_pct", pct(F.col("toxic"), F.col("n")))
        .orderBy(F.desc("toxic_pct"), "subreddit")
    )


def extraction_yield(df: DataFrame) -> DataFrame:
    """Rows per tier and year, per tier (year null) and in all (both null)."""
    return (
        df.rollup("tier", "year")
        .agg(F.count("*").alias("n"), F.grouping_id().cast("int").alias("level"))
    )


def fetch_outcome(raw: DataFrame, kept: DataFrame, plan: DataFrame) -> DataFrame:
    """Fetched, kept and filtered rows per planned unit; empty units stay listed."""
    unit = ["subreddit", "year_month"]
    counts = (
        raw.select(*unit, F.lit(1).alias("_raw"), F.lit(0).alias("_kept"))
        .unionByName(kept.select(*unit, F.lit(0).alias("_raw"), F.lit(1).alias("_kept")))
        .groupBy(*unit)
        .agg(F.sum("_raw").alias("fetched"), F.sum("_kept").alias("kept"))
    )
    return (
        plan.select(*unit)
        .join(counts, unit, "left")
        .na.fill(0, ["fetched", "kept"])
        .withColumn("filtered", F.col("fetched") - F.col("kept"))
        .withColumn("status", F.when(F.col("kept") > 0, "uploaded").otherwise("no data"))
    )


def token_usage(responses: DataFrame, n_labelled: DataFrame | None = None) -> DataFrame:
    """Token totals, cache hit rate and tokens per labelled comment.

    Absent counters fall back as in the response format: total = prompt + completion,
    hits = cached tokens of the details, misses = prompt - hits.
    """
    zero = F.lit(0).cast("long")

    def known(name: str) -> Column:
        return F.col(name) if name in responses.columns else F.lit(None).cast("long")

    prompt = F.coalesce(known("prompt_tokens"), zero)
    completion = F.coalesce(known("completion_tokens"), zero)
    hits = F.coalesce(known("prompt_cache_hit_tokens"), known("cached_tokens"), zero)
    rows = responses.select(
        prompt.alias("p"),
        completion.alias("c"),
        F.coalesce(known("total_tokens"), prompt + completion).alias("t"),
        hits.alias("h"),
        F.coalesce(known("prompt_cache_miss_tokens"), prompt - hits).alias("m"),
    )
    total = {c: F.coalesce(F.sum(c), zero) for c in "pcthm"}
    out = rows.agg(
        total["p"].alias("prompt_tokens"),
        total["c"].alias("completion_tokens"),
        total["t"].alias("total_tokens"),
        total["h"].alias("cache_hits"),
        total["m"].alias("cache_misses"),
    ).withColumn(
        "hit_rate", F.coalesce(pct(F.col("cache_hits"), F.col("prompt_tokens")), F.lit(0.0))
    )
    if n_labelled is None:
        return out
    count = n_labelled.agg(F.count("*")).scalar()
    per_row = F.round(F.try_divide(F.col("total_tokens").cast("double"), count), 4)
    return out.withColumn("tokens_per_comment", F.coalesce(per_row, F.lit(0.0)))
