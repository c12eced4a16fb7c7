"""Filters, joins, deduplication, sampling and indexing."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentloom.catalog import views as v
from commentloom.catalog.registry import query
from commentloom.operators.lexicon import ids_with_terms
from commentloom.operators import dedup, filters, indexing, joins, sampling
from commentloom.sources.config import parse_subreddit_config

C, L = f"WITH {v.COMMENTS} ", f"WITH {v.LABELLED} "
MONTH = v.month_sql("created_utc")


def dim(spark, sf):
    return parse_subreddit_config(v.config_docs(spark, sf), core=v.CORE)


def pool(spark, sf):
    kept = filters.drop_tombstones(v.comments(spark, sf))
    tagged = filters.tag_tier(filters.with_year_month(kept), dim(spark, sf))
    return tagged.select("id", "body", "subreddit", "created_utc", "year_month", "tier")


# --- filters ---------------------------------------------------------------------------------


@query("f1_drop_tombstones", f"{C} SELECT id, body FROM comments WHERE {v.KEPT}")
def _(spark, sf):
    return filters.drop_tombstones(v.comments(spark, sf)).select("id", "body")


@query(
    "f2_length_between",
    f"{C} SELECT id, body FROM comments WHERE {v.KEPT} AND length(body) BETWEEN 10 AND 1000",
)
def _(spark, sf):
    kept = filters.drop_tombstones(v.comments(spark, sf))
    return filters.length_between(kept, 10, 1000).select("id", "body")


@query(
    "f3_in_subreddits",
    f"{C}, {v.DIM} SELECT id, lower(subreddit) AS subreddit FROM comments"
    " WHERE lower(subreddit) IN (SELECT subreddit FROM dim WHERE enabled)",
)
def _(spark, sf):
    names = dim(spark, sf).filter("enabled").select("subreddit")
    return filters.in_subreddits(v.comments(spark, sf), names).select("id", "subreddit")


@query(
    "f3_in_subreddit_list",
    f"{C} SELECT id, lower(subreddit) AS subreddit FROM comments"
    " WHERE lower(subreddit) IN ('src1', 'src4', 'src17')",
)
def _(spark, sf):
    found = filters.in_subreddits(v.comments(spark, sf), ["SRC1", "src4", "Src17"])
    return found.select("id", "subreddit")


@query("f4_min_score", f"{C} SELECT id, score FROM comments WHERE score >= 2")
def _(spark, sf):
    return filters.min_score(v.comments(spark, sf), 2).select("id", "score")


@query(
    "f5_epoch_between",
    f"{C} SELECT id, created_utc FROM comments WHERE created_utc BETWEEN 820454400 AND 915148799",
)
def _(spark, sf):
    found = filters.epoch_between(v.comments(spark, sf), 820454400, 915148799)
    return found.select("id", "created_utc")


TERMS = ["trash", "Worthless", "idiot", "scum", "hehely"]
_LIKE = " OR ".join(f"lower(body) LIKE '%{t.lower()}%'" for t in TERMS)


@query("f6_match_any_keyword", f"{C} SELECT id, body FROM comments WHERE {_LIKE}")
def _(spark, sf):
    return filters.match_any_keyword(v.comments(spark, sf), TERMS).select("id", "body")


_WORDS = "regexp_split_to_array(lower(body), '[^\\p{L}\\p{N}_]+')"


@query(
    "f6_match_whole_word",
    f"{C} SELECT id, body FROM comments WHERE list_has_any({_WORDS}, ['trash', 'idiot', 'the'])",
)
def _(spark, sf):
    found = filters.match_any_keyword(
        v.comments(spark, sf), ["trash", "idiot", "the"], whole_word=True
    )
    return found.select("id", "body")


@query(
    "f8_require_columns",
    f"{C}, u AS (SELECT id, nullif(body, '') AS body, CASE WHEN score >= 0 THEN score END AS score"
    " FROM comments) SELECT id, score FROM u WHERE body IS NOT NULL AND score IS NOT NULL",
)
def _(spark, sf):
    df = v.comments(spark, sf).select(
        "id", F.nullif("body", F.lit("")).alias("body"), F.when(F.col("score") >= 0, F.col("score"))
        .alias("score")
    )
    return filters.require_columns(df, ["body", "score"]).select("id", "score")


@query("f9_with_year_month", f"{C} SELECT id, {MONTH} AS year_month FROM comments")
def _(spark, sf):
    return filters.with_year_month(v.comments(spark, sf)).select("id", "year_month")


@query("f10_tag_tier", f"WITH {v.POOL} SELECT id, subreddit, tier FROM pool")
def _(spark, sf):
    return pool(spark, sf).select("id", "subreddit", "tier")


@query(
    "f11_backfill_flags",
    f"{L} SELECT id, profanity_vulgarity, CAST(0 AS INT) AS caste, CAST(0 AS INT) AS"
    " misogyny_gender FROM labelled",
)
def _(spark, sf):
    df = v.labelled(spark, sf).drop("caste", "misogyny_gender")
    return filters.backfill_flags(df).select(
        "id", "profanity_vulgarity", "caste", "misogyny_gender"
    )


@query(
    "f12_rename_flags",
    f"{L} SELECT text AS body, concat('note ', id) AS step_by_step_analysis, profanity_vulgarity,"
    " caste, id FROM labelled",
)
def _(spark, sf):
    short = v.labelled(spark, sf).select(
        "id",
        F.col("caste").alias("cst"),
        F.col("profanity_vulgarity").alias("pv"),
        F.concat(F.lit("note "), "id").alias("analysis"),
        F.col("text").alias("body"),
    )
    lead = ["body", "step_by_step_analysis", "profanity_vulgarity", "caste"]
    return filters.rename_flags(short, "step_by_step_analysis", lead)


NAMES = " src3, SRC1,src3,, src20 ,nosuch"
_UNIT_LIST = "(VALUES (0, 'src3'), (1, 'src1'), (2, 'src20'), (3, 'nosuch')) AS n(pos, name)"
UNITS = f"""units AS (
  SELECT n.pos AS subreddit_pos, n.name AS subreddit, strftime(m, '%Y-%m') AS year_month
  FROM {_UNIT_LIST},
       unnest(generate_series(DATE '1995-06-01', DATE '1999-02-01', INTERVAL 1 MONTH)) AS t(m))"""
RAW = f"""raw AS (
  SELECT c.id, c.body, c.created_utc, u.subreddit, u.year_month, u.subreddit_pos
  FROM comments c JOIN units u
    ON u.subreddit = lower(c.subreddit) AND u.year_month = {v.month_sql("c.created_utc")})"""


def units(spark):
    return filters.fetch_units(spark, NAMES, "1995-06", "1999-02")


@query("f13_assign_to_units", f"{C}, {UNITS}, {RAW} SELECT id, subreddit, year_month FROM raw")
def _(spark, sf):
    tagged = filters.assign_to_units(v.comments(spark, sf), units(spark))
    return tagged.select("id", "subreddit", "year_month")


# --- joins -----------------------------------------------------------------------------------


_LABEL_ROWS = "(SELECT CAST(doc_id AS VARCHAR) AS id, quality, toxic FROM labels) l"


def _label_rows(spark, sf):
    labels = v.table(spark, sf, "labels")
    return labels.select(F.col("doc_id").cast("string").alias("id"), "quality", "toxic")


@query(
    "j1_attach_labels_left",
    f"{C} SELECT c.id, l.toxic FROM comments c LEFT JOIN {_LABEL_ROWS} ON l.id = c.id",
)
def _(spark, sf):
    joined = joins.attach_labels(v.comments(spark, sf), _label_rows(spark, sf), "left")
    return joined.select("id", "toxic")


@query(
    "j1_attach_labels_inner",
    f"{C} SELECT c.id, l.toxic FROM comments c JOIN {_LABEL_ROWS} ON l.id = c.id",
)
def _(spark, sf):
    joined = joins.attach_labels(v.comments(spark, sf), _label_rows(spark, sf), "inner")
    return joined.select("id", "toxic")


@query(
    "j2_exclude_seen",
    f"{C} SELECT id, body FROM comments WHERE id NOT IN"
    " (SELECT CAST(doc_id AS VARCHAR) FROM labels)",
)
def _(spark, sf):
    ledger = _label_rows(spark, sf).select("id")
    return joins.exclude_seen(v.comments(spark, sf), ledger).select("id", "body")


def _rank(seed, *by, id_col="id"):
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    return f"row_number() OVER ({part}ORDER BY md5(concat('{seed}|', {id_col})), {id_col})"


@query(
    "j3_exclude_sampled",
    f"{L}, r AS (SELECT *, {_rank(42, 'subreddit')} AS rn FROM labelled)"
    " SELECT id, subreddit FROM r WHERE rn > 5",
)
def _(spark, sf):
    df = v.labelled(spark, sf)
    sampled = sampling.sample_per_stratum(df, ["subreddit"], 5)
    return joins.exclude_sampled(df, sampled).select("id", "subreddit")


# --- deduplication ---------------------------------------------------------------------------


def _first(key, source, order="created_utc, id"):
    return (
        f"first_rows AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}"
        f" ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1)"
    )


# Every comment twice: as it is and fetched again later with another body.
_TWICE = """twice AS (SELECT id, body, created_utc, subreddit FROM comments UNION ALL
  SELECT id, concat(body, ' again'), created_utc + 3456000, subreddit FROM comments)"""


def with_refetch(rows):
    again = rows.withColumns(
        {"body": F.concat("body", F.lit(" again")), "created_utc": F.col("created_utc") + 3456000}
    )
    return rows.unionByName(again)


def twice(spark, sf):
    rows = v.comments(spark, sf).select("id", "body", "created_utc", "subreddit")
    return with_refetch(rows)


@query(
    "u1_dedup_by_id",
    f"{C}, {_TWICE}, {_first('id', 'twice')} SELECT id, body, created_utc FROM first_rows",
)
def _(spark, sf):
    return dedup.dedup_by_id(twice(spark, sf)).select("id", "body", "created_utc")


@query(
    "u2_dedup_by_text",
    f"WITH {v.LINES}, {_first('text', 'comment_lines')} SELECT id, text FROM first_rows",
)
def _(spark, sf):
    return dedup.dedup_by_text(v.comment_lines(spark, sf)).select("id", "text")


_KEY = "regexp_replace(lower(text), '[^a-z0-9]', '', 'g')"
_FALLBACK = f"CASE WHEN {_KEY} <> '' THEN {_KEY} ELSE concat(chr(1), text) END"


@query(
    "u3_dedup_normalised",
    f"WITH {v.LINES}, {_first(_FALLBACK, 'comment_lines')} SELECT id, text FROM first_rows",
)
def _(spark, sf):
    return dedup.dedup_normalised(v.comment_lines(spark, sf)).select("id", "text")


@query(
    "u3_dedup_normalised_strict",
    f"WITH {v.LINES}, {_first(_KEY, 'comment_lines')} SELECT id, text FROM first_rows",
)
def _(spark, sf):
    lines = v.comment_lines(spark, sf)
    return dedup.dedup_normalised(lines, ascii_strict=True).select("id", "text")


# Every line twice under one id, the second time later and in capitals.
_LINES2 = """lines2 AS (SELECT id, text, created_utc FROM comment_lines UNION ALL
  SELECT id, upper(text), created_utc + 1 FROM comment_lines)"""
_LOCKS = (
    f"WITH {v.LINES}, {_LINES2}, by_id AS (SELECT * FROM (SELECT *, row_number() OVER"
    " (PARTITION BY id ORDER BY created_utc, text) AS n FROM lines2) WHERE n = 1),"
    f" {_first(_FALLBACK, 'by_id')}"
)


def lines2(spark, sf):
    once = v.comment_lines(spark, sf).select("id", "text", "created_utc")
    again = once.select("id", F.upper("text").alias("text"), (F.col("created_utc") + 1)
                        .alias("created_utc"))
    return once.unionByName(again)


@query("u4_two_lock_dedup", f"{_LOCKS} SELECT id, text FROM first_rows")
def _(spark, sf):
    return dedup.two_lock_dedup(lines2(spark, sf)).select("id", "text")


@query(
    "u4_two_lock_report",
    f"{_LOCKS} SELECT a AS n_before, a - b AS dropped_by_id, b - c AS dropped_by_text,"
    " c AS n_after FROM (SELECT (SELECT count(*) FROM lines2) AS a,"
    " (SELECT count(*) FROM by_id) AS b, (SELECT count(*) FROM first_rows) AS c)",
)
def _(spark, sf):
    return dedup.two_lock_report(lines2(spark, sf))


@query(
    "u4_text_dedup_report",
    f"WITH {v.LINES} SELECT count(*) AS n_before, count(*) - count(DISTINCT text) AS n_dropped,"
    " count(DISTINCT text) AS n_after FROM comment_lines",
)
def _(spark, sf):
    return dedup.dedup_report(v.comment_lines(spark, sf), "text")


@query(
    "u5_cross_slice_dedup",
    f"{C}, {_TWICE}, {UNITS}, {RAW.replace('FROM comments c', 'FROM twice c')},"
    f" {_first('id', 'raw', 'subreddit_pos, year_month, created_utc, body')}"
    " SELECT id, created_utc, subreddit, year_month FROM first_rows",
)
def _(spark, sf):
    raw = filters.assign_to_units(twice(spark, sf), units(spark))
    return dedup.cross_slice_dedup(raw).select("id", "created_utc", "subreddit", "year_month")


@query(
    "u6_union_tiers",
    f"WITH {v.POOL} SELECT id, tier, body FROM pool WHERE tier = 'Tier 1'"
    " UNION ALL SELECT id, tier, NULL FROM pool WHERE tier = 'Tier 2'",
)
def _(spark, sf):
    rows = pool(spark, sf)
    one = rows.filter("tier = 'Tier 1'").select("id", "tier", "body")
    two = rows.filter("tier = 'Tier 2'").select("tier", "id")
    return dedup.union_tiers(one, two)


# --- sampling --------------------------------------------------------------------------------


@query(
    "w1_sample_per_stratum",
    f"{L}, r AS (SELECT *, {_rank(42, 'subreddit')} AS rn FROM labelled)"
    " SELECT id, subreddit FROM r WHERE rn <= 5",
)
def _(spark, sf):
    return sampling.sample_per_stratum(v.labelled(spark, sf), ["subreddit"], 5).select(
        "id", "subreddit"
    )


@query(
    "w1_sample_per_month",
    f"{C}, m AS (SELECT id, lower(subreddit) AS subreddit, {MONTH} AS year_month FROM comments),"
    f" r AS (SELECT *, {_rank(7, 'subreddit', 'year_month')} AS rn FROM m)"
    " SELECT id, subreddit, year_month FROM r WHERE rn <= 2",
)
def _(spark, sf):
    rows = filters.with_year_month(v.comments(spark, sf)).withColumn(
        "subreddit", F.lower("subreddit")
    )
    return sampling.sample_per_stratum(rows, n=2, seed=7).select("id", "subreddit", "year_month")


@query(
    "w2_cap_total",
    f"{C} SELECT id, body FROM comments ORDER BY md5(concat('42|', id)), id LIMIT 120",
)
def _(spark, sf):
    return sampling.cap_total(v.comments(spark, sf), 120).select("id", "body")


def balance_sql(rows, quota, target=None, by=("subreddit", "year_month")):
    """The three draws written out: share per bucket, top-up per tier, top-up overall."""
    final = "d IS NOT NULL"
    if target:
        final += f" OR g <= {target} - (SELECT count(*) FROM y WHERE d IS NOT NULL)"
    return f"""
    r AS (SELECT *, {_rank(42, "tier", *by)} AS rn FROM {rows}),
    s AS (SELECT tier, {quota} AS quota,
                 greatest(1, {quota} // count(DISTINCT ({', '.join(by)}))) AS share
          FROM {rows} GROUP BY tier),
    f AS (SELECT r.*, rn <= share AS is_first, quota FROM r JOIN s USING (tier)),
    t AS (SELECT tier, greatest(0, max(quota) - count(*) FILTER (is_first)) AS need
          FROM f GROUP BY tier),
    x AS (SELECT f.*, need, {_rank(42, "tier", "is_first")} AS sp FROM f JOIN t USING (tier)),
    y AS (SELECT *, CASE WHEN is_first THEN 'share' WHEN sp <= need THEN 'top-up' END AS d FROM x),
    z AS (SELECT *, {_rank(42, "d IS NULL")} AS g FROM y)
    SELECT id, tier, subreddit, coalesce(d, 'overall') AS drawn FROM z WHERE {final}"""


@query(
    "w3_balance_quota",
    f"{L}, one AS (SELECT *, 'all' AS tier FROM labelled), picked AS ("
    f"{'WITH ' + balance_sql('one', '380').strip()}) SELECT id, subreddit FROM picked",
)
def _(spark, sf):
    return sampling.balance_quota(v.labelled(spark, sf), 380).select("id", "subreddit")


@query(
    "w3_balance_quota_strict",
    f"{L}, one AS (SELECT *, 'all' AS tier FROM labelled), picked AS ("
    f"{'WITH ' + balance_sql('one', '150').strip()})"
    " SELECT id, subreddit FROM picked ORDER BY md5(concat('42|', id)), id LIMIT 150",
)
def _(spark, sf):
    return sampling.balance_quota(v.labelled(spark, sf), 150, strict=True).select(
        "id", "subreddit"
    )


@query(
    "w4_balance_tiers",
    f"WITH {v.POOL}, "
    + balance_sql("pool", "CASE WHEN tier = 'Tier 1' THEN 140 ELSE 60 END", 200),
)
def _(spark, sf):
    return sampling.balance_tiers(pool(spark, sf), 200).select("id", "tier", "subreddit", "drawn")


_YEARS = "yearly AS (SELECT *, left(year_month, 4) AS year FROM pool)"


@query(
    "w4_balance_tiers_overall",
    f"WITH {v.POOL}, {_YEARS}, "
    + balance_sql("yearly", "CASE WHEN tier = 'Tier 1' THEN 320 ELSE 80 END", 400, ("year",)),
)
def _(spark, sf):
    """Tier 1 cannot fill its quota, so the rest comes from the whole pool."""
    rows = pool(spark, sf).withColumn("year", F.substring("year_month", 1, 4))
    drawn = sampling.balance_tiers(rows, 400, by=["year"], core_pct=80)
    return drawn.select("id", "tier", "subreddit", "drawn")


@query(
    "w2_cap_total_large",
    f"WITH {v.LINES} SELECT id, text FROM comment_lines ORDER BY md5(concat('42|', id)), id LIMIT 5000",
)
def _(spark, sf):
    return sampling.cap_total(v.comment_lines(spark, sf)).select("id", "text")


@query(
    "w5_equal_per_subreddit",
    f"{L}, r AS (SELECT *, {_rank(42, 'subreddit')} AS rn FROM labelled) SELECT id, subreddit"
    " FROM r WHERE rn <= greatest(1, 150 // (SELECT count(DISTINCT subreddit) FROM labelled))",
)
def _(spark, sf):
    return sampling.equal_per_subreddit(v.labelled(spark, sf), 150).select("id", "subreddit")


EXTRACT_TERMS = ["the", "worthless", "eau"]
_EXTRACT_LIKE = " OR ".join(f"lower(body) LIKE '%{t}%'" for t in EXTRACT_TERMS)
EXTRACTED = f"""extracted AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY tier ORDER BY year, md5(concat('42|', id)), id) AS rn
  FROM (SELECT *, CAST(left(year_month, 4) AS INT) AS year FROM pool WHERE {_EXTRACT_LIKE}))
  WHERE rn <= CASE WHEN tier = 'Tier 1' THEN 60 ELSE 320 END)"""


def extracted(spark, sf):
    return sampling.quota_extract(pool(spark, sf), EXTRACT_TERMS, sampling.harvest_quotas())


@query("w6_quota_extract", f"WITH {v.POOL}, {EXTRACTED} SELECT id, tier, year FROM extracted")
def _(spark, sf):
    return extracted(spark, sf).select("id", "tier", "year")


@query(
    "w6_quota_extract_searched",
    f"WITH {v.POOL}, marked AS (SELECT * REPLACE (CASE WHEN CAST(id AS BIGINT) % 5 = 0 THEN 'Tier 3' ELSE tier END AS tier) FROM pool),"
    " ranked AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY year, md5(concat('42|', id)), id) AS rn"
    " FROM (SELECT *, CAST(left(year_month, 4) AS INT) AS year FROM marked WHERE tier = 'Tier 3' OR"
    f" {_EXTRACT_LIKE})) SELECT id, tier, year FROM ranked WHERE rn <= CASE tier WHEN 'Tier 1' THEN 60 WHEN 'Tier 2' THEN 320 ELSE 20 END",
)
def _(spark, sf):
    searched = F.when(F.col("id").cast("long") % 5 == 0, "Tier 3").otherwise(F.col("tier"))
    marked = pool(spark, sf).withColumn("tier", searched)
    found = sampling.quota_extract(marked, EXTRACT_TERMS, sampling.harvest_quotas())
    return found.select("id", "tier", "year")


_MANY = (
    "words AS (SELECT DISTINCT w AS word FROM (SELECT unnest(regexp_extract_all(lower(body), '[a-z]{9,}')) AS w FROM comments))"
)


@query(
    "f6_match_many_keywords",
    f"{C}, {_MANY} SELECT id FROM comments c WHERE EXISTS (SELECT 1 FROM words w WHERE contains(lower(c.body), w.word))",
)
def _(spark, sf):
    """A lexicon table that grows with the texts."""
    rows = v.comments(spark, sf)
    found = F.explode(F.regexp_extract_all(F.lower("body"), F.lit("[a-z]{9,}"), F.lit(0)))
    return ids_with_terms(rows, rows.select(found.alias("term")))


@query("w7_shuffle", f"{C} SELECT id, md5(concat('42|', id)) AS shuffle_key FROM comments")
def _(spark, sf):
    return sampling.shuffle(v.comments(spark, sf)).select("id", "shuffle_key")


@query(
    "w8_row_index",
    f"WITH {v.LINES} SELECT id, row_number() OVER (ORDER BY created_utc, k) - 1 AS row_index"
    " FROM comment_lines",
)
def _(spark, sf):
    lines = v.comment_lines(spark, sf)
    return indexing.row_index(lines, ["created_utc", "k"]).select("id", "row_index")


@query(
    "w8_random_row_index",
    f"WITH {v.LINES} SELECT id, {_rank('')} - 1 AS row_index FROM comment_lines",
)
def _(spark, sf):
    return indexing.random_row_index(v.comment_lines(spark, sf)).select("id", "row_index")
