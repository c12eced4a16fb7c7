"""From an archive to published labelled chunks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.functions.text import sanitize
from commentloom.operators import dedup, filters, formatting, indexing, joins, labeling
from commentloom.operators.ledger import _exists as exists
from commentloom.operators.ledger import ledger_append, read_ledger
from commentloom.operators.sampling import balance_tiers, sample_per_stratum
from commentloom.session import materialize, scratch_path
from commentloom.sources.sinks import write_chunks


def candidate_pool(
    comments: DataFrame,
    dim: DataFrame,
    ledger: DataFrame | None = None,
    lo: int | None = 10,
    hi: int | None = 1000,
) -> DataFrame:
    """Filtered, tagged, cleaned and deduplicated comments that no earlier run has seen.

    The ledger comes last: a comment published earlier still hides later copies of its text.
    """
    kept = filters.length_between(filters.drop_tombstones(comments), lo, hi)
    tagged = filters.with_year_month(filters.tag_tier(kept, dim))
    clean = filters.min_clean_length(sanitize(tagged, "worker"))
    unique = dedup.dedup_normalised(clean, col="body_clean")
    return unique if ledger is None else joins.exclude_seen(unique, ledger)


@dataclass(frozen=True)
class LabelRun:
    labels: DataFrame
    rounds: int
    given_up: DataFrame  # (batch, ids) of the batches that no round could label


def label_batches(
    sample: DataFrame,
    labeler: Callable,
    size: int = 20,
    max_retries: int = labeling.MAX_RETRIES,
    by_id: bool = False,
) -> LabelRun:
    """Label a sample in rounds: each round's responses are saved before they are judged.

    A round's rejects are the next round's requests.  Saved rounds cut the plan, so a lost
    executor costs one round at most.  The driver only learns whether rejects are left.  With
    ``by_id`` results follow the ids in the response where these are the batch's own.
    """
    spark = sample.sparkSession
    path = scratch_path(spark, "responses")
    requests = labeling.build_requests(indexing.build_batches(sample, size))
    schema = labeling.RESPONSES
    rounds = 0
    while rounds <= max_retries:
        rounds += 1
        labeling.label_checkpoint(labeling.run_labeler(requests, labeler), path, rounds)
        saved = spark.read.schema(schema).parquet(f"{path}/round={rounds}")
        requests = labeling.retry_queue(labeling.parse_responses(saved), max_retries)
        if requests.isEmpty():
            break
    everything = labeling.parse_responses(spark.read.schema(schema).parquet(path))
    good = labeling.accepted(everything)
    labels = labeling.reattach_by_id(good) if by_id else labeling.reattach_positional(good)
    lost = everything.groupBy("batch").agg(F.max_by("ids", "attempt").alias("ids"))
    given_up = lost.join(good.select("batch"), "batch", "left_anti")
    return LabelRun(labeling.coerce_flags(labels).drop("batch"), rounds, given_up)


def training_records(sample: DataFrame, labels: DataFrame, system_prompt: str) -> DataFrame:
    """Labelled comments as published records with chat messages."""
    joined = filters.require_columns(joins.attach_labels(sample, labels, "left"), ["pv"])
    record = formatting.to_training_record(filters.rename_flags(joined))
    return formatting.to_chatml(record, system_prompt)


def publish_worker_run(
    comments: DataFrame,
    dim: DataFrame,
    labeler: Callable,
    out: str,
    system_prompt: str,
    ledger: DataFrame | None = None,
    target: int = 12500,
    seed=42,
    prefix: str = "worker",
    ledger_path: str | None = None,
    by_id: bool = False,
) -> LabelRun:
    """The whole run.  The sample is written once because labels and records both read it.

    With ``ledger_path`` ids published before are left out, and after the chunks are written
    the published ids, read back from them, are appended; a second run publishes nothing twice.
    """
    spark = comments.sparkSession
    path = scratch_path(spark, "sample")
    if ledger_path is not None and exists(spark, ledger_path):
        known = read_ledger(spark, ledger_path)
        ledger = known if ledger is None else ledger.select("id").unionByName(known)
    pool = materialize(candidate_pool(comments, dim, ledger), "pool")  # draws read its keys, then rows
    balance_tiers(pool, target, seed=seed).write.parquet(path)
    sample = spark.read.parquet(path)
    run = label_batches(sample, labeler, by_id=by_id)
    write_chunks(training_records(sample, run.labels, system_prompt), out, prefix=prefix)
    if ledger_path is not None:
        ledger_append(spark.read.schema("id string").parquet(out), ledger_path)
    return run


def extraction_report(pool: DataFrame, n: int = 100, seed=42) -> DataFrame:
    """Rows and mean clean length per subreddit and month of a stratified sample."""
    sample = sample_per_stratum(pool, n=n, seed=seed)
    return sample.groupBy("subreddit", "year_month").agg(
        F.count("*").alias("n"), F.round(F.avg(F.length("body_clean")), 4).alias("avg_len")
    )

