"""From target shortfalls to keyword candidates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.functions.text import sanitize
from commentloom.operators import audit, dedup, filters, joins, lexicon
from commentloom.operators.ledger import ledger_append, read_ledger
from commentloom.operators.sampling import harvest_quotas, quota_extract
from commentloom.plans.worker import LabelRun, label_batches, training_records
from commentloom.session import materialize
from commentloom.sources.files import exists
from commentloom.sources.sinks import write_chunks


@dataclass(frozen=True)
class Plan:
    category: str
    shortfall: int
    lexicon: DataFrame  # (category, term, pos)
    terms: list[str]


def harvest_plan(
    labelled: DataFrame,
    targets: DataFrame,
    cached: DataFrame,
    static_stopwords: DataFrame | None = None,
    generated: DataFrame | None = None,
    k: int = 10,
    max_terms: int | None = None,
) -> Plan | None:
    """The category to harvest for and its lexicon; none when every category goal is met.

    One row and the lexicon's terms (the first ``max_terms`` if given) come back to the driver.
    """
    top = audit.priority_category(audit.shortfalls(labelled, targets)).collect()
    if not top:
        return None
    category, missing = top[0]["metric"], top[0]["shortfall"]
    name = F.lit(category).alias("category")
    seeds = lexicon.tfidf_seeds(labelled, category, k, static_stopwords).select(
        name, F.col("word").alias("term"), (-F.col("score") * 1000000).cast("long").alias("pos")
    )
    known = cached.filter(F.upper("category") == category.upper())
    sources = [known, seeds] + ([] if generated is None else [generated])
    merged = dedup.merge_lexicon(*sources)
    ordered = merged.orderBy("pos")
    terms = [r["term"] for r in (ordered if max_terms is None else ordered.limit(max_terms)).collect()]
    return Plan(category, missing, merged, terms)


def harvest_candidates(
    archive: DataFrame,
    dim: DataFrame,
    terms: list[str],
    live: DataFrame | None = None,
    threshold: int = 500,
    seed=42,
    ledger: DataFrame | None = None,
) -> DataFrame:
    """Cleaned keyword candidates under the tier quotas; each id once, tier 3 first, none that ``ledger`` holds.

    ``live`` holds parsed pages of a live search and forms tier 3, whatever its terms.  The archive is
    filtered by the terms before ids meet, so only hits are shuffled.
    """
    found = filters.match_any_keyword(filters.drop_tombstones(archive), terms)
    tagged = filters.tag_tier(found, dim)
    if live is not None:
        fresh = filters.drop_tombstones(live).withColumn("tier", F.lit("Tier 3"))
        tagged = dedup.union_tiers(tagged, fresh)
        order = [F.desc(F.col("tier") == "Tier 3"), "tier", "created_utc", F.md5("body")]
        tagged = dedup.dedup_by_id(tagged, order)
    if ledger is not None:  # only hits meet the ledger
        hits = tagged.filter((F.col("tier") == "Tier 3") | filters.keyword_match("body", terms))
        tagged = joins.exclude_seen(hits, ledger)
    picked = quota_extract(tagged, terms, harvest_quotas(threshold), seed)
    return sanitize(filters.with_year_month(picked), "harvester")


def publish_harvest_run(
    labelled: DataFrame,
    targets: DataFrame,
    cached: DataFrame,
    archive: DataFrame,
    dim: DataFrame,
    labeler: Callable,
    out: str,
    system_prompt: str,
    lexicon_out: str | None = None,
    live: DataFrame | None = None,
    static_stopwords: DataFrame | None = None,
    threshold: int = 500,
    seed=42,
    prefix: str = "harvest",
    ledger_path: str | None = None,
) -> LabelRun | None:
    """One harvest round from shortfall to published chunks; None when every goal is met.

    The merged lexicon is saved to ``lexicon_out``, a new folder, for the next round to start from.  Only
    candidates that got labels are published.  With ``ledger_path`` no id of an earlier run is drawn again, and the published
    ids are appended once the chunks are written.
    """
    spark = labelled.sparkSession
    plan = harvest_plan(labelled, targets, cached, static_stopwords)
    if plan is None:
        return None
    if lexicon_out is not None:
        plan.lexicon.write.parquet(lexicon_out)
    ledger = read_ledger(spark, ledger_path) if ledger_path is not None and exists(spark, ledger_path) else None
    found = materialize(harvest_candidates(archive, dim, plan.terms, live, threshold, seed, ledger), "candidates")
    run = label_batches(found, labeler)
    write_chunks(training_records(found, run.labels, system_prompt), out, prefix=prefix)
    if ledger_path is not None:
        ledger_append(spark.read.schema("id string").parquet(out), ledger_path)
    return run
