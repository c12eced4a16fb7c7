"""Row filters, projections and tags."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.functions.flags import year_month
from commentloom.functions.terms import holds_any
from commentloom.functions.text import tokenize
from commentloom.schemas import FLAGS, SHORT_TO_LONG, TOMBSTONES
from commentloom.session import materialize


def drop_tombstones(df: DataFrame, col: str = "body") -> DataFrame:
    return df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*TOMBSTONES))


def length_between(
    df: DataFrame, lo: int | None = None, hi: int | None = None, col: str = "body"
) -> DataFrame:
    """Inclusive bounds in characters (code points)."""
    if lo is not None:
        df = df.filter(F.length(col) >= lo)
    if hi is not None:
        df = df.filter(F.length(col) <= hi)
    return df


def in_subreddits(
    df: DataFrame, names: DataFrame | list[str], col: str = "subreddit", stored_lower: bool = False
) -> DataFrame:
    """Case-insensitive membership; the name comes out lower-cased.

    With ``stored_lower`` the column already holds lower-case names, so a list turns into a
    bare ``IN`` that parquet can use for row-group pruning.  A table of names is semi-joined
    without a hint: Spark broadcasts it only while it is measurably small.
    """
    if not stored_lower:
        df = df.withColumn(col, F.lower(col))
    if isinstance(names, DataFrame):
        wanted = names.select(F.lower(col).alias(col))
        return df.join(wanted, col, "left_semi")
    return df.filter(F.col(col).isin([n.lower() for n in names]))


def min_score(df: DataFrame, n: int = 2) -> DataFrame:
    return df.filter(F.col("score") >= n)


def epoch_between(df: DataFrame, lo: int, hi: int, col: str = "created_utc") -> DataFrame:
    return df.filter(F.col(col).between(lo, hi))


def keyword_match(col: str, terms: list[str], whole_word: bool = False) -> Column:
    """True where the lower-cased text holds any term literally; all terms are tried in one pass."""
    terms = [t.lower() for t in terms if t]
    if not terms:
        return F.lit(False)
    if whole_word:
        return F.arrays_overlap(tokenize(col), F.array(*[F.lit(t) for t in terms]))

    return holds_any(F.lower(col), terms)


def match_any_keyword(
    df: DataFrame,
    terms: list[str],
    max_terms: int | None = None,
    col: str = "body",
    whole_word: bool = False,
) -> DataFrame:
    """Rows that hold any term, or any of the first ``max_terms``; no terms, no rows."""
    return df.filter(keyword_match(col, terms[:max_terms], whole_word))


def min_clean_length(df: DataFrame, n: int = 5, col: str = "body_clean") -> DataFrame:
    return df.filter(F.length(col) > n)


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def with_year_month(
    df: DataFrame, epoch: str = "created_utc", out: str = "year_month"
) -> DataFrame:
    return df.withColumn(out, year_month(epoch))


def tag_tier(df: DataFrame, dim: DataFrame, out: str = "tier") -> DataFrame:
    """Keep rows of enabled subreddits, tagged ``Tier 1`` or ``Tier 2``; tier 1 wins.

    One row per subreddit is written down, so its size is known when the join is planned: while it is small the comments
    are neither shuffled by subreddit, of which a few hold most rows, nor sorted.
    """
    tiers = (
        dim.filter("enabled")
        .groupBy(F.lower("subreddit").alias("subreddit"))
        .agg(F.min("tier").alias("_tier"))
    )
    tiers = materialize(tiers, "tiers")
    return (
        df.withColumn("subreddit", F.lower("subreddit"))
        .join(tiers, "subreddit")
        .withColumn(out, F.concat(F.lit("Tier "), F.col("_tier").cast("string")))
        .drop("_tier")
    )


def backfill_flags(df: DataFrame, cols: list[str] = FLAGS) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    return df.withColumns({c: F.lit(0) for c in missing}) if missing else df


def rename_flags(
    df: DataFrame, analysis_name: str = "analysis", first: list[str] | None = None
) -> DataFrame:
    """Short keys to published names; ``first`` lists preferred leading columns."""
    names = {**SHORT_TO_LONG, "analysis": analysis_name}
    df = df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})
    if first:
        lead = [c for c in first if c in df.columns]
        df = df.select(*lead, *[c for c in df.columns if c not in lead])
    return df


def split_names(raw: str) -> list[str]:
    """Comma list to lower-case names, blanks dropped, first occurrence kept."""
    names = [part.strip().lower() for part in raw.split(",")]
    names = list(dict.fromkeys(n for n in names if n))
    if not names:
        raise ValueError("no subreddit names given")
    return names


def _month(text: str) -> date:
    match = re.fullmatch(r"(\d{4})-(\d{1,2})", text)
    if not match or not 1 <= int(match[2]) <= 12:
        raise ValueError(f"not a YYYY-MM month: {text!r}")
    return date(int(match[1]), int(match[2]), 1)


def fetch_units(spark, subreddits: str, start: str, end: str) -> DataFrame:
    """One row per (subreddit, month) with its half-open epoch window, in fetch order."""
    names, lo, hi = split_names(subreddits), _month(start), _month(end)
    if lo > hi:
        raise ValueError(f"start {start} is after end {end}")
    one = spark.range(1)
    units = one.select(
        F.posexplode(F.array(*[F.lit(n) for n in names])).alias("subreddit_pos", "subreddit")
    ).select(
        "*",
        F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 MONTH"))).alias("_first"),
    )
    return units.select(
        "subreddit_pos",
        "subreddit",
        F.date_format("_first", "yyyy-MM").alias("year_month"),
        (F.unix_date("_first").cast("long") * 86400).alias("after"),
        (F.unix_date(F.add_months("_first", 1)).cast("long") * 86400).alias("before"),
    )


def assign_to_units(df: DataFrame, units: DataFrame) -> DataFrame:
    """Tag each comment with its (subreddit, month) unit; others drop out.

    Units are whole calendar months, so the window test is an equality on the month and the
    join is a plain equi join.  The epoch range of the plan is not needed for the join.
    """
    tagged = df.withColumn("subreddit", F.lower("subreddit")).withColumn(
        "year_month", year_month("created_utc")
    )
    return tagged.join(units, ["subreddit", "year_month"])
