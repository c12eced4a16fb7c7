"""Configuration documents as dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.operators.audit import CLEAN

# Fixed values.
CORE_CATEGORY = "toxicity_focused"
FALLBACK_STOPWORDS = ["hai", "ki", "aur", "mein"]

_SUBREDDITS = "config map<string,int>, categories map<string,array<string>>"


def parse_subreddit_config(
    docs: DataFrame, json_col: str = "value", core: str = CORE_CATEGORY
) -> DataFrame:
    """Toggle map and category lists to (subreddit, category, enabled, tier).

    Takes one document or many partial ones.  A category without a toggle is enabled.  The core
    category is tier 1, every other one tier 2.  Names come out lower-cased and distinct.
    """
    doc = docs.select(F.from_json(json_col, _SUBREDDITS).alias("d"))
    lists = doc.select(F.explode("d.categories").alias("category", "names"))
    names = lists.select("category", F.explode("names").alias("name"))
    names = names.select("category", F.lower("name").alias("subreddit")).distinct()
    toggles = (
        doc.select(F.explode("d.config").alias("category", "toggle"))
        .groupBy("category")
        .agg(F.max("toggle").alias("toggle"))
    )
    return names.join(toggles, "category", "left").select(
        "subreddit",
        "category",
        (F.coalesce("toggle", F.lit(1)) == 1).alias("enabled"),
        F.when(F.col("category") == core, 1).otherwise(2).alias("tier"),
    )


def load_subreddit_dim(spark: SparkSession, path: str, core: str = CORE_CATEGORY) -> DataFrame:
    return parse_subreddit_config(spark.read.text(path, wholetext=True), "value", core)


def clean_stopwords(lines: DataFrame, col: str = "value") -> DataFrame:
    """One word per line: trimmed, lower-cased, blanks and repeats dropped."""
    word = F.lower(F.regexp_replace(F.col(col), r"(?U)^\s+|\s+\z", ""))
    return lines.select(word.alias("word")).filter("word <> ''").distinct()


def load_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """The list at ``path``, or the fallback words if there is no such file."""
    from pyspark.errors import AnalysisException

    try:
        lines = spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        lines = spark.createDataFrame([(w,) for w in FALLBACK_STOPWORDS], "value string")
    return clean_stopwords(lines)


def load_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object of category to term list as (category, term, pos)."""
    doc = spark.read.text(path, wholetext=True)
    lists = doc.select(
        F.explode(F.from_json("value", "map<string,array<string>>")).alias("category", "terms")
    )
    return lists.select("category", F.posexplode("terms").alias("pos", "term")).select(
        "category", "term", F.col("pos").cast("long").alias("pos")
    )


def lexicon_json(lexicon: DataFrame) -> DataFrame:
    """Back to one JSON object, terms in order.  A lexicon is small by nature."""
    lists = lexicon.groupBy("category").agg(
        F.array_sort(F.collect_list(F.struct("pos", "term")))["term"].alias("terms")
    )
    entries = F.array_sort(F.collect_list(F.struct("category", "terms")))
    return lists.agg(F.to_json(F.map_from_entries(entries)).alias("value"))


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """The target blueprint as (metric, goal, ord): categories in file order, then clean rows."""
    doc = spark.read.text(path, wholetext=True).select(
        F.from_json("value", "clean_data long, categories map<string,long>").alias("d")
    )
    goals = doc.select(
        F.posexplode(F.map_entries("d.categories")).alias("ord", "e")
    ).select(F.col("e.key").alias("metric"), F.col("e.value").alias("goal"), "ord")
    clean = doc.select(
        F.lit(CLEAN).alias("metric"),
        F.coalesce("d.clean_data", F.lit(0)).cast("long").alias("goal"),
        F.size("d.categories").alias("ord"),
    )
    return goals.unionByName(clean)
