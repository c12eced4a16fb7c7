"""Whole flows, from raw comments to reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentloom.catalog import views as v
from commentloom.catalog.label_queries import _JSON, PROMPT, word_labels
from commentloom.catalog.registry import ORACLES, query
from commentloom.catalog.report_queries import (
    _SHORT,
    _STATUS,
    _TARGETS,
    SEEDS,
    TFIDF_ROWS,
    counts_sql,
    targets,
    targets_sql,
)
from commentloom.catalog.row_queries import C, L, RAW, UNITS, _rank, balance_sql, dim, units
from commentloom.catalog.text_queries import harvester_sql, worker_sql
from commentloom.operators import audit
from commentloom.plans import harvest, intake, migration, review, worker
from commentloom.schemas import FLAGS
from commentloom.session import scratch_path
from commentloom.sources.scan import read_comment_csv
from commentloom.sources.sinks import write_csv

_CLEAN = f"""cleaned AS (SELECT * FROM (SELECT *, {worker_sql("body")} AS body_clean FROM pool
  WHERE length(body) BETWEEN 10 AND 1000) WHERE length(body_clean) > 5),
  keyed AS (SELECT *, regexp_replace(lower(body_clean), '[^a-z0-9]', '', 'g') AS k FROM cleaned),
  candidates AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY
    CASE WHEN k <> '' THEN k ELSE concat(chr(1), body_clean) END ORDER BY created_utc, id, body)
    AS n FROM keyed) WHERE n = 1)"""


def candidates(spark, sf):
    return worker.candidate_pool(v.comments(spark, sf), dim(spark, sf))


@query(
    "flow_candidate_pool",
    f"WITH {v.POOL}, {_CLEAN} SELECT id, subreddit, year_month, tier, body_clean FROM candidates",
)
def _(spark, sf):
    return candidates(spark, sf).select("id", "subreddit", "year_month", "tier", "body_clean")


@query(
    "flow_extraction_report",
    f"WITH {v.POOL}, {_CLEAN}, r AS (SELECT *, {_rank(42, 'subreddit', 'year_month')} AS rn"
    " FROM candidates) SELECT subreddit, year_month, count(*) AS n,"
    " round(avg(length(body_clean)), 4) AS avg_len FROM r WHERE rn <= 100 GROUP BY 1, 2",
)
def _(spark, sf):
    return worker.extraction_report(candidates(spark, sf))


_QUOTA = "CASE WHEN tier = 'Tier 1' THEN 105 ELSE 45 END"


@query(
    "flow_worker_run",
    f"WITH {v.POOL}, {_CLEAN}, drawn AS (WITH {balance_sql('candidates', _QUOTA, 150).strip()}),"
    " flags AS (SELECT c.id, c.body, c.subreddit, c.created_utc, c.year_month,"
    + ", ".join(
        f"CAST(contains(lower(body_clean), '{w}') AS INT) AS {c}" for c, w in v.WORDS.items()
    )
    + " FROM candidates c JOIN drawn d ON d.id = c.id), records AS (SELECT id,"
    " regexp_replace(body, '^[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+|[\\s\\x0b\\x1c-\\x1f\\x{85}\\p{Z}]+$',"
    " '', 'g') AS text, subreddit, created_utc, year_month, CAST(0 AS INT) AS profanity_vulgarity,"
    " CAST(0 AS INT) AS targeted_abuse_harassment, greatest("
    + ", ".join(v.WORDS)
    + ") AS discriminatory_hate_speech, "
    + ", ".join(v.WORDS)
    + f", '' AS analysis FROM flags) SELECT *, {_JSON} AS answer FROM records",
)
def _(spark, sf):
    out = scratch_path(spark, "published")
    worker.publish_worker_run(
        v.comments(spark, sf), dim(spark, sf), word_labels, out, PROMPT, target=150
    )
    rows = spark.read.parquet(out)
    return rows.withColumn("answer", F.col("messages")[2]["content"]).drop("messages")


@query("flow_worker_run_again", "SELECT 0 AS published_twice, true AS some_published")
def _(spark, sf):
    """Two runs over the same archive with one ledger: the second finds other comments or none."""
    out, ledger = scratch_path(spark, "published"), scratch_path(spark, "ledger")
    for prefix in ("first", "second"):
        worker.publish_worker_run(
            v.comments(spark, sf), dim(spark, sf), word_labels, out, PROMPT, target=150, prefix=prefix, ledger_path=ledger
        )
    ids = spark.read.schema("id string").parquet(out)
    return ids.agg(
        (F.count("*") - F.count_distinct("id")).cast("int").alias("published_twice"), (F.count("*") > 0).alias("some_published")
    )


_PRIORITY = (
    f"{targets_sql(100000)}, {counts_sql('labelled')}, short AS ({_SHORT}), priority AS ("
    "SELECT metric FROM short WHERE shortfall > 0 AND metric <> 'clean_data'"
    " ORDER BY shortfall DESC, ord LIMIT 1), corpus AS (SELECT id AS doc_id, text, CASE metric "
    + " ".join(f"WHEN '{c}' THEN {c}" for c in v.WORDS)
    + " END AS toxic FROM labelled, priority)"
)
_TERMS = (
    "terms AS (SELECT word AS term FROM seeds WHERE length(word) > 3 UNION SELECT word FROM"
    " (VALUES "
    + ", ".join(f"('{c}', '{w}')" for c, w in v.WORDS.items())
    + ") AS cached(category, word), priority WHERE category = metric)"
)


@query(
    "flow_harvest_candidates",
    f"WITH {v.LABELLED}, {v.POOL_ROWS}, {_PRIORITY}, {TFIDF_ROWS}, {SEEDS}, {_TERMS}, ranked AS ("
    "SELECT *, row_number() OVER (PARTITION BY tier ORDER BY year, md5(concat('42|', id)), id) AS"
    " rn FROM (SELECT *, CAST(left(year_month, 4) AS INT) AS year FROM pool WHERE EXISTS"
    " (SELECT 1 FROM terms WHERE contains(lower(body), term))))"
    f" SELECT id, tier, year, {harvester_sql('body')} AS body_clean FROM ranked"
    " WHERE rn <= CASE WHEN tier = 'Tier 1' THEN 60 ELSE 320 END",
)
def _(spark, sf):
    labelled = v.labelled(spark, sf)
    cached = spark.createDataFrame(
        [(c, w, 0) for c, w in v.WORDS.items()], "category string, term string, pos long"
    )
    plan = harvest.harvest_plan(labelled, audit.targets_from_goal(spark, 100000), cached)
    terms = [] if plan is None else plan.terms  # every goal is met: there is nothing to look for
    found = harvest.harvest_candidates(v.comments(spark, sf), dim(spark, sf), terms)
    return found.select("id", "tier", "year", "body_clean")


@query(
    "flow_harvest_run",
    "SELECT id, "
    + ", ".join(f"CAST(contains(lower(body_clean), '{w}') AS INT) AS {c}" for c, w in v.WORDS.items())
    + f", CAST((SELECT count(*) FROM (WITH {v.LABELLED}, {_PRIORITY}, {TFIDF_ROWS}, {SEEDS}, {_TERMS} SELECT * FROM terms)) AS BIGINT)"
    f" AS saved_terms FROM ({ORACLES['flow_harvest_candidates']})",
)
def _(spark, sf):
    cached = spark.createDataFrame(
        [(c, w, 0) for c, w in v.WORDS.items()], "category string, term string, pos long"
    )
    out, lexicon = scratch_path(spark, "harvested"), scratch_path(spark, "lexicon")
    run = harvest.publish_harvest_run(
        v.labelled(spark, sf), audit.targets_from_goal(spark, 100000), cached, v.comments(spark, sf), dim(spark, sf),
        word_labels, out, PROMPT, lexicon,
    )
    if run is None:  # every goal is met: nothing is published, no lexicon is saved
        return spark.createDataFrame([], f"id string, {', '.join(f'{c} int' for c in v.WORDS)}, saved_terms long")
    saved = spark.read.parquet(lexicon).agg(F.count("*")).scalar()
    return spark.read.parquet(out).select("id", *v.WORDS, saved.alias("saved_terms"))


@query(
    "flow_migration",
    f"{L}, numbered AS (SELECT *, (row_number() OVER (ORDER BY id) - 1) // 40 AS chunk FROM labelled WHERE text <> ''), chunks AS ("
    "SELECT chunk, count(*) AS n_rows FROM numbered GROUP BY chunk) SELECT id, printf('migration_base_part_%03d', chunk) AS"
    " chunk_name, n_rows, concat('{', "
    + ", ', ', ".join(f"'\"{c}\": ', {c}" for c in FLAGS)
    + ", '}') AS answer FROM numbered JOIN chunks USING (chunk)",
)
def _(spark, sf):
    """Labelled rows as CSV, migrated in three runs of which two end early."""
    path, out, state = (scratch_path(spark, name) for name in ("csv", "migrated", "manifest"))
    write_csv(v.labelled(spark, sf).select("text", "id", *FLAGS), path)
    rows = read_comment_csv(spark, path, "text")
    for limit in (2, 1, None):
        done = migration.migrate(spark, rows, out, state, PROMPT, size=40, max_chunks=limit)
    records = spark.read.parquet(out).withColumn("answer", F.col("messages")[2]["content"])
    return records.join(done, "chunk_name").select("id", "chunk_name", "n_rows", "answer")


@query(
    "flow_intake",
    f"{C}, {UNITS}, {RAW}, n AS (SELECT subreddit, year_month, count(*) AS fetched,"
    f" count(*) FILTER ({v.KEPT}) AS kept FROM raw GROUP BY ALL)"
    " SELECT u.subreddit, u.year_month, coalesce(fetched, 0) AS fetched, coalesce(kept, 0) AS kept,"
    " coalesce(fetched - kept, 0) AS filtered,"
    " CASE WHEN kept > 0 THEN 'uploaded' ELSE 'no data' END AS status"
    " FROM units u LEFT JOIN n USING (subreddit, year_month)",
)
def _(spark, sf):
    rows = v.comments(spark, sf)
    item = F.to_json(F.struct(F.array(F.struct(*rows.columns)).alias("data")))
    pages = rows.select(F.lower("subreddit").alias("subreddit"), item.alias("page"))
    return intake.intake(pages, units(spark), scratch_path(spark, "main"))


@query(
    "flow_review",
    f"{L}, uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY CASE WHEN"
    " regexp_replace(lower(text), '[^a-z0-9]', '', 'g') <> '' THEN regexp_replace(lower(text),"
    " '[^a-z0-9]', '', 'g') ELSE concat(chr(1), text) END ORDER BY created_utc, id) AS n"
    f" FROM labelled) WHERE n = 1), {_TARGETS}, {counts_sql('uniq')}, short AS ({_SHORT}) {_STATUS}",
)
def _(spark, sf):
    rows = v.labelled(spark, sf)
    return review.review(rows.unionByName(rows), targets(spark))[0]
