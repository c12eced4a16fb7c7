"""Audit reports and word statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentloom.catalog import views as v
from commentloom.catalog.registry import query
from commentloom.catalog.row_queries import (
    C,
    EXTRACTED,
    L,
    RAW,
    UNITS,
    extracted,
    units,
)
from commentloom.catalog.text_queries import tokens_sql
from commentloom.session import scratch_path
from commentloom.operators import audit, dedup, filters, lexicon
from commentloom.schemas import CATEGORY_FLAGS, CORE_FLAGS, FLAGS

TOXIC = f"(coalesce(greatest({', '.join(CORE_FLAGS)}), 0) = 1)"
GOAL = 160


def targets(spark):
    return audit.targets_from_goal(spark, GOAL)


def targets_sql(goal):
    rows = [f"('{c}', {(goal - goal // 2) // 4}, {i})" for i, c in enumerate(CATEGORY_FLAGS)]
    rows.append(f"('clean_data', {goal // 2}, {len(CATEGORY_FLAGS)})")
    return f"targets(metric, goal, ord) AS (VALUES {', '.join(rows)})"


_TARGETS = targets_sql(GOAL)


def counts_sql(rows):
    parts = [f"SELECT '{c}' AS metric, sum({c}) AS current FROM {rows}" for c in FLAGS]
    parts.append(f"SELECT 'clean_data', count(*) FILTER (NOT {TOXIC}) FROM {rows}")
    parts.append(f"SELECT 'toxic_pool', count(*) FILTER ({TOXIC}) FROM {rows}")
    return f"counts AS ({' UNION ALL '.join(parts)})"


_KEY = "regexp_replace(lower(text), '[^a-z0-9]', '', 'g')"
_TWO_LOCK = f"""uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY
  CASE WHEN {_KEY} <> '' THEN {_KEY} ELSE concat(chr(1), text) END
  ORDER BY created_utc, id) AS n FROM labelled) WHERE n = 1)"""
_BY_TEXT = """uniq AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY text
  ORDER BY created_utc, id) AS n FROM labelled) WHERE n = 1)"""

_SHORT = (
    "SELECT CAST(t.ord AS INT) AS ord, t.metric, CAST(coalesce(c.current, 0) AS BIGINT) AS current,"
    " CAST(t.goal AS BIGINT) AS goal,"
    " CAST(greatest(0, t.goal - coalesce(c.current, 0)) AS BIGINT) AS shortfall"
    " FROM targets t LEFT JOIN counts c ON c.metric = t.metric"
)
_STATUS = (
    "SELECT ord, metric, current, goal, CASE WHEN current >= goal THEN 'MET'"
    " ELSE concat('SHORT (', goal - current, ' needed)') END AS status FROM short"
)


@query("a1_is_toxic", f"{L} SELECT id, {TOXIC} AS is_toxic FROM labelled")
def _(spark, sf):
    return audit.is_toxic(v.labelled(spark, sf)).select("id", "is_toxic")


@query(
    "a2_class_split",
    f"{L}, n AS (SELECT count(*) AS total, count(*) FILTER ({TOXIC}) AS toxic FROM labelled)"
    " SELECT total, toxic, total - toxic AS clean, CAST(0 AS BIGINT) AS unlabelled,"
    " round(toxic * 100.0::DOUBLE / total, 4) AS toxic_pct,"
    " round((total - toxic) * 100.0::DOUBLE / total, 4) AS clean_pct FROM n",
)
def _(spark, sf):
    return audit.class_split(v.labelled(spark, sf))


@query(
    "a3_category_breakdown",
    f"{L} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS category, CAST(sum({c}) AS BIGINT) AS n, count(*) AS total,"
        f" round(sum({c}) * 100.0::DOUBLE / count(*), 4) AS pct FROM labelled"
        for c in FLAGS
    ),
)
def _(spark, sf):
    return audit.category_breakdown(v.labelled(spark, sf))


@query("a4_shortfalls", f"{L}, {_TARGETS}, {counts_sql('labelled')} {_SHORT}")
def _(spark, sf):
    return audit.shortfalls(v.labelled(spark, sf), targets(spark))


@query(
    "a4_shortfalls_unique_text", f"{L}, {_BY_TEXT}, {_TARGETS}, {counts_sql('uniq')} {_SHORT}"
)
def _(spark, sf):
    return audit.shortfalls(v.labelled(spark, sf), targets(spark), "text")


@query(
    "a5_priority_category",
    f"{L}, {_TARGETS}, {counts_sql('labelled')}, short AS ({_SHORT}) SELECT * FROM short"
    " WHERE shortfall > 0 AND metric <> 'clean_data' ORDER BY shortfall DESC, ord LIMIT 1",
)
def _(spark, sf):
    return audit.priority_category(audit.shortfalls(v.labelled(spark, sf), targets(spark)))


@query(
    "a6_audit_status",
    f"{L}, {_TWO_LOCK}, {_TARGETS}, {counts_sql('uniq')}, short AS ({_SHORT}) {_STATUS}",
)
def _(spark, sf):
    return audit.audit_status(v.labelled(spark, sf), targets(spark))


@query(
    "a7_next_action",
    f"{L}, {_TWO_LOCK}, {_TARGETS}, {counts_sql('uniq')}, short AS ({_SHORT}) SELECT CAST(CASE"
    " WHEN count(*) FILTER (shortfall > 0 AND metric <> 'clean_data') > 0 THEN 2"
    " WHEN count(*) FILTER (shortfall > 0) > 0 THEN 3 ELSE 0 END AS INT) AS action FROM short",
)
def _(spark, sf):
    return audit.next_action(audit.audit_status(v.labelled(spark, sf), targets(spark)))


@query(
    "a8_distinct_profile",
    f"{L} SELECT count(*) AS total, count(DISTINCT id) AS unique_ids,"
    " count(DISTINCT text) AS unique_texts, count(*) - count(DISTINCT text) AS duplicates"
    " FROM labelled",
)
def _(spark, sf):
    return audit.distinct_profile(v.labelled(spark, sf))


@query("a8_distinct_profile_sketched", f"{L} SELECT count(*) AS total, TRUE AS ids_close, TRUE AS texts_close FROM labelled")
def _(spark, sf):
    """Slices saved one by one, profiled from their sketches: rows exactly, distinct counts within five percent."""
    rows, path = v.labelled(spark, sf), scratch_path(spark, "sketches")
    for k in range(3):
        audit.save_sketches(rows.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == k), path, f"part{k}")
    near = lambda c: F.abs(F.col(c) - F.col(f"_{c}")) <= 0.05 * F.col(f"_{c}")
    exact = audit.distinct_profile(rows).select(*[F.col(c).alias(f"_{c}") for c in ("unique_ids", "unique_texts")])
    both = audit.sketched_profile(spark.read.parquet(path)).join(F.broadcast(exact))  # one row each
    return both.select("total", near("unique_ids").alias("ids_close"), near("unique_texts").alias("texts_close"))


@query(
    "a9_length_profile",
    f"{L} SELECT round(avg(length(text)), 4) AS avg_len, CAST(min(length(text)) AS BIGINT)"
    " AS min_len, CAST(max(length(text)) AS BIGINT) AS max_len FROM labelled",
)
def _(spark, sf):
    return audit.length_profile(v.labelled(spark, sf))


@query(
    "a10_top_subreddits",
    f"{L} SELECT subreddit, count(*) AS n FROM labelled GROUP BY 1 ORDER BY n DESC, subreddit"
    " LIMIT 5",
)
def _(spark, sf):
    return audit.top_subreddits(v.labelled(spark, sf))


@query(
    "a11_monthly_distribution",
    f"{L} SELECT year_month, count(*) AS n FROM labelled GROUP BY 1",
)
def _(spark, sf):
    return audit.monthly_distribution(v.labelled(spark, sf))


@query(
    "a12_toxicity_by_subreddit",
    f"{L} SELECT subreddit, count(*) AS n, count(*) FILTER ({TOXIC}) AS toxic,"
    f" round(count(*) FILTER ({TOXIC}) * 100.0::DOUBLE / count(*), 4) AS toxic_pct"
    " FROM labelled GROUP BY 1",
)
def _(spark, sf):
    return audit.toxicity_by_subreddit(v.labelled(spark, sf))


@query(
    "a13_extraction_yield",
    f"WITH {v.POOL}, {EXTRACTED} SELECT tier, year, count(*) AS n,"
    " CAST(grouping(tier, year) AS INT) AS level FROM extracted GROUP BY ROLLUP (tier, year)",
)
def _(spark, sf):
    return audit.extraction_yield(extracted(spark, sf))


@query(
    "a14_fetch_outcome",
    f"{C}, {UNITS}, {RAW}, n AS (SELECT subreddit, year_month, count(*) AS fetched,"
    f" count(*) FILTER ({v.KEPT}) AS kept FROM raw GROUP BY ALL)"
    " SELECT u.subreddit, u.year_month, coalesce(fetched, 0) AS fetched, coalesce(kept, 0) AS kept,"
    " coalesce(fetched - kept, 0) AS filtered,"
    " CASE WHEN kept > 0 THEN 'uploaded' ELSE 'no data' END AS status"
    " FROM units u LEFT JOIN n USING (subreddit, year_month)",
)
def _(spark, sf):
    plan = units(spark)
    raw = filters.assign_to_units(v.comments(spark, sf), plan)
    kept = dedup.cross_slice_dedup(filters.drop_tombstones(raw))
    return audit.fetch_outcome(raw, kept, plan)


# --- word statistics -------------------------------------------------------------------------

_TOK = tokens_sql("[a-z0-9]+")
_ALPHA = tokens_sql("[a-z]{3,}")


def word_df(rows):
    return (
        f"word_df AS (SELECT word, count(*) AS df FROM (SELECT unnest(list_distinct({_TOK})) AS"
        f" word FROM {rows}) GROUP BY 1)"
    )


STOP = (
    "stop AS (SELECT word FROM word_df WHERE df > CAST(floor((SELECT count(text) FROM corpus)"
    " * 0.15) AS BIGINT))"
)


@query(
    "a15_document_frequency",
    f"WITH {word_df('documents')} SELECT word, df FROM word_df",
)
def _(spark, sf):
    return lexicon.document_frequency(v.table(spark, sf, "documents"))


@query(
    "a16_dynamic_stopwords",
    f"WITH {v.CORPUS}, {word_df('corpus')}, {STOP}"
    " SELECT word FROM stop UNION SELECT DISTINCT lang FROM documents",
)
def _(spark, sf):
    static = v.table(spark, sf, "documents").select(F.col("lang").alias("word")).distinct()
    return lexicon.dynamic_stopwords(v.corpus(spark, sf), static)


TFIDF_ROWS = (
    f"{word_df('corpus')}, {STOP},"
    f" tf AS (SELECT word, count(*) AS tf FROM (SELECT unnest({_TOK}) AS word FROM corpus WHERE"
    " toxic = 1) WHERE length(word) > 2 AND word NOT IN (SELECT word FROM stop) GROUP BY 1),"
    f" bg AS (SELECT word, count(*) AS bg_df FROM (SELECT unnest(list_distinct({_TOK})) AS word"
    " FROM corpus WHERE toxic = 0) WHERE length(word) > 2 AND word NOT IN (SELECT word FROM stop)"
    " GROUP BY 1), scored AS (SELECT tf.word, tf.tf, coalesce(bg_df, 0) AS bg_df, round(tf.tf * ln("
    "greatest((SELECT count(*) FROM bg), 1)::DOUBLE / (coalesce(bg_df, 0) + 1)), 6) AS score"
    " FROM tf LEFT JOIN bg ON bg.word = tf.word)"
)
TFIDF = f"{v.CORPUS}, {TFIDF_ROWS}"


@query("a17_term_frequency", f"WITH {TFIDF} SELECT word, tf FROM tf")
def _(spark, sf):
    rows = v.corpus(spark, sf)
    return lexicon.term_frequency(rows, "toxic", lexicon.dynamic_stopwords(rows))


@query("a18_tfidf_scores", f"WITH {TFIDF} SELECT word, tf, bg_df, score FROM scored")
def _(spark, sf):
    return lexicon.tfidf_scores(v.corpus(spark, sf), "toxic")


SEEDS = "seeds AS (SELECT word, score FROM scored ORDER BY score DESC, word LIMIT 10)"


@query("a18_tfidf_seeds", f"WITH {TFIDF}, {SEEDS} SELECT word, score FROM seeds")
def _(spark, sf):
    return lexicon.tfidf_seeds(v.corpus(spark, sf), "toxic").select("word", "score")


def minority_sql(k):
    per_flag = " UNION ALL ".join(
        f"SELECT '{c}' AS category, unnest({_ALPHA}) AS word FROM labelled WHERE {c} = 1"
        for c in CATEGORY_FLAGS
    )
    return (
        f"minority AS (SELECT category, word, n, rank FROM (SELECT category, word, count(*) AS n,"
        " row_number() OVER (PARTITION BY category ORDER BY count(*) DESC, word) AS rank"
        f" FROM ({per_flag}) WHERE word NOT IN ('the', 'and', 'that') GROUP BY 1, 2)"
        f" WHERE rank <= {k})"
    )


STOPS = ["the", "and", "that"]


@query("a19_minority_keywords", f"{L}, {minority_sql(12)} SELECT * FROM minority")
def _(spark, sf):
    return lexicon.minority_keywords(v.labelled(spark, sf), 12, STOPS)


@query(
    "u7_merge_lexicon",
    f"{L}, {minority_sql(12)}, {TFIDF}, {SEEDS}, src AS ("
    " SELECT upper(category) AS category, word AS term, 0 AS s, rank AS p FROM minority UNION ALL"
    " SELECT 'CASTE', word, 1, row_number() OVER (ORDER BY score DESC, word) FROM seeds UNION ALL"
    " SELECT 'CASTE', word, 2, row_number() OVER (ORDER BY df DESC, word) FROM"
    " (FROM word_df ORDER BY df DESC, word LIMIT 30)),"
    " firsts AS (SELECT category, term, min((s, p)) AS place FROM src WHERE length(term) > 3"
    " GROUP BY 1, 2) SELECT category, term, row_number() OVER (PARTITION BY category"
    " ORDER BY place, term) - 1 AS pos FROM firsts",
)
def _(spark, sf):
    cached = lexicon.minority_keywords(v.labelled(spark, sf), 12, STOPS).select(
        "category", F.col("word").alias("term"), F.col("rank").alias("pos")
    )
    rows = v.corpus(spark, sf)
    caste = F.lit("caste").alias("category")
    seeds = lexicon.tfidf_seeds(rows, "toxic").select(
        caste, F.col("word").alias("term"), (-F.col("score") * 1000000).cast("long").alias("pos")
    )
    frequent = lexicon.document_frequency(rows).orderBy(F.desc("df"), "word").limit(30)
    generated = frequent.select(caste, F.col("word").alias("term"), (-F.col("df")).alias("pos"))
    return dedup.merge_lexicon(cached, seeds, generated)


def found_lexicon(spark, sf):
    top = lexicon.minority_keywords(v.labelled(spark, sf), 12, STOPS)
    return top.select("category", F.col("word").alias("term"))


_HITS = (
    f"{L}, {minority_sql(12)}, hits AS (SELECT c.id, m.category, m.word AS term FROM comments c"
    " JOIN minority m ON contains(lower(c.body), m.word))"
)


@query("j4_lexicon_hits", f"{_HITS} SELECT * FROM hits")
def _(spark, sf):
    return lexicon.lexicon_hits(v.comments(spark, sf), found_lexicon(spark, sf))


@query(
    "j4_hit_counts", f"{_HITS} SELECT category, term, count(*) AS n FROM hits GROUP BY 1, 2"
)
def _(spark, sf):
    hits = lexicon.lexicon_hits(v.comments(spark, sf), found_lexicon(spark, sf))
    return lexicon.hit_counts(hits)
