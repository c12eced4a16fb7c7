"""Comment-shaped views over the test tables, in Spark and as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.functions.flags import year_month

# Planted words stand in for a category lexicon.
WORDS = {
    "caste": "trash",
    "communal_religious": "worthless",
    "regional_xenophobic": "idiot",
    "misogyny_gender": "scum",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def comments(spark: SparkSession, sf: str) -> DataFrame:
    return _comments(spark, sf).drop("doc_id", *[f"_{c}" for c in WORDS])


def _comments(spark: SparkSession, sf: str, labels: DataFrame | None = None) -> DataFrame:
    """What depends on the text alone is computed below the joins, so a query that needs no text shuffles none."""
    every = F.col("doc_id") % 2 == 0
    lower = F.lower("text")
    body = (
        F.when(F.col("doc_id") % 41 == 0, "[deleted]")
        .when(F.col("doc_id") % 43 == 0, "[removed]")
        .when(F.col("doc_id") % 47 == 0, "")
        .otherwise(F.col("text"))
    )
    d = table(spark, sf, "documents").select(
        "doc_id",
        body.alias("body"),
        F.when(every, F.upper("source")).otherwise(F.col("source")).alias("subreddit"),
        *[lower.contains(w).alias(f"_{c}") for c, w in WORDS.items()],
    )
    if labels is not None:
        d = d.join(labels, "doc_id")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate")
    day = F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', o_orderdate)")
    return d.join(o, "doc_id").select(
        F.col("doc_id").cast("string").alias("id"),
        "body",
        (day + F.col("doc_id")).cast("long").alias("created_utc"),
        "subreddit",
        (F.col("doc_id") % 11 - 2).alias("score"),
        F.lit(0).cast("long").alias("controversiality"),
        F.lit(None).cast("string").alias("collapsed_reason_code"),
        "doc_id",
        *[f"_{c}" for c in WORDS],
        *([] if labels is None else ["toxic"]),
    )


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    toxic = F.col("toxic") == 1

    def flag(cond):
        return F.when(toxic & cond, 1).otherwise(0)

    hits = {c: F.col(f"_{c}") for c in WORDS}
    any_hit = hits["caste"] | hits["communal_religious"] | hits["regional_xenophobic"]
    any_hit = any_hit | hits["misogyny_gender"]
    return _comments(spark, sf, labels).select(
        "id",
        F.trim("body").alias("text"),
        F.lower("subreddit").alias("subreddit"),
        "created_utc",
        year_month("created_utc").alias("year_month"),
        F.col("toxic").alias("profanity_vulgarity"),
        flag(F.col("doc_id") % 3 != 0).alias("targeted_abuse_harassment"),
        flag(any_hit).alias("discriminatory_hate_speech"),
        *[flag(h).alias(c) for c, h in hits.items()],
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their toxic flag."""
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id")


def comment_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("k", "text")
    ).select(
        F.concat_ws("_", F.col("doc_id").cast("string"), F.col("k").cast("string")).alias("id"),
        "text",
        F.col("doc_id").alias("created_utc"),
        "k",
    )


COMMENTS = """comments AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id,
         CASE WHEN d.doc_id % 41 = 0 THEN '[deleted]' WHEN d.doc_id % 43 = 0 THEN '[removed]'
              WHEN d.doc_id % 47 = 0 THEN '' ELSE d.text END AS body,
         CAST(epoch(o.o_orderdate) AS BIGINT) + d.doc_id AS created_utc,
         CASE WHEN d.doc_id % 2 = 0 THEN upper(d.source) ELSE d.source END AS subreddit,
         d.doc_id % 11 - 2 AS score,
         CAST(0 AS BIGINT) AS controversiality,
         CAST(NULL AS VARCHAR) AS collapsed_reason_code
  FROM documents d JOIN orders o ON o.o_orderkey = d.doc_id)"""


def month_sql(epoch: str) -> str:
    return f"strftime(make_timestamp(CAST({epoch} AS BIGINT) * 1000000), '%Y-%m')"


def _flag(cond: str) -> str:
    return f"CAST(CASE WHEN l.toxic = 1 AND ({cond}) THEN 1 ELSE 0 END AS INT)"


_HIT = {c: f"lower(d.text) LIKE '%{w}%'" for c, w in WORDS.items()}

LABELLED = (
    COMMENTS
    + f""", labelled AS (
  SELECT c.id, trim(c.body) AS text, lower(c.subreddit) AS subreddit, c.created_utc,
         {month_sql("c.created_utc")} AS year_month,
         l.toxic AS profanity_vulgarity,
         {_flag("d.doc_id % 3 <> 0")} AS targeted_abuse_harassment,
         {_flag(" OR ".join(_HIT.values()))} AS discriminatory_hate_speech,
         {", ".join(f"{_flag(h)} AS {c}" for c, h in _HIT.items())}
  FROM comments c JOIN documents d ON CAST(d.doc_id AS VARCHAR) = c.id
  JOIN labels l ON l.doc_id = d.doc_id)"""
)

LINES = """comment_lines AS (
  SELECT concat(doc_id, '_', k) AS id, text, doc_id AS created_utc, CAST(k AS INT) AS k FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS k FROM documents))"""

CORPUS = """corpus AS (
  SELECT d.doc_id, d.text, l.toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


def decorated(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a link, a mention, invisible characters, a URL and an address added."""
    lit = F.lit
    doc_id = F.col("doc_id").cast("string")
    text = F.concat(
        lit("["), "source", lit("](http://h.example/"), doc_id, lit(") by /u/"), "lang", lit("_"),
        doc_id, lit(" you/"), "source", lit("\u200bx\u200d e\u0301 "), "text",
        lit("\u00a0\u00a0 www."), "source", lit(".example/a?b \t\u2003a.b+c@"), "source",
        lit(".example.org "),
    )
    return table(spark, sf, "documents").select("doc_id", text.alias("text"))


DECORATED = """decorated AS (
  SELECT doc_id, concat('[', source, '](http://h.example/', doc_id, ') by /u/', lang, '_', doc_id,
    ' you/', source, chr(8203), 'x', chr(8205), ' e', chr(769), ' ', text, chr(160), chr(160),
    ' www.', source, '.example/a?b ', chr(9), chr(8195), 'a.b+c@', source, '.example.org ') AS text
  FROM documents)"""


def config_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One partial subreddit configuration per source: cat1 is core, cat2 off, cat3 unlisted."""
    cat = F.concat(F.lit("cat"), F.substring("source", -1, 1))
    toggle = F.when(cat == "cat2", 0).otherwise(1)
    config = F.when(cat == "cat3", F.create_map()).otherwise(F.create_map(cat, toggle))
    names = F.array("source", F.upper("source"))
    doc = F.struct(
        config.cast("map<string,int>").alias("config"),
        F.create_map(cat, names).alias("categories"),
    )
    sources = table(spark, sf, "documents").select("source").distinct()
    return sources.select(F.to_json(doc).alias("value"))


CORE = "cat1"

DIM = """dim AS (
  SELECT DISTINCT lower(source) AS subreddit, concat('cat', right(source, 1)) AS category,
         right(source, 1) <> '2' AS enabled,
         CASE WHEN right(source, 1) = '1' THEN 1 ELSE 2 END AS tier
  FROM documents)"""

KEPT = "body NOT IN ('[deleted]', '[removed]', '')"

POOL_ROWS = f"""{DIM}, pool AS (
  SELECT c.id, c.body, lower(c.subreddit) AS subreddit, c.created_utc,
         {month_sql("c.created_utc")} AS year_month, concat('Tier ', d.tier) AS tier
  FROM comments c JOIN dim d ON d.subreddit = lower(c.subreddit)
  WHERE d.enabled AND {KEPT})"""

POOL = f"{COMMENTS}, {POOL_ROWS}"
