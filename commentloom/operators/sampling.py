"""Deterministic sampling.  Every draw takes the rows with the lowest md5(seed | id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commentloom.functions.flags import sample_rank, year_month
from commentloom.operators.filters import keyword_match
from commentloom.operators.ranking import bring_rows, draw_per_group, lowest_per_group
from commentloom.session import materialize

STRATA = ["subreddit", "year_month"]


def _draw(seed, id_col: str = "id") -> list:
    return [sample_rank(id_col, seed), F.col(id_col)]


def sample_per_stratum(
    df: DataFrame, by: list[str] = STRATA, n: int = 100, seed=42, id_col: str = "id"
) -> DataFrame:
    return draw_per_group(df, by, n, seed, id_col).drop("_rank")


def cap_total(df: DataFrame, n: int = 5000, seed=42, id_col: str = "id") -> DataFrame:
    return draw_per_group(df, [], n, seed, id_col).drop("_rank")


def balance_quota(
    df: DataFrame,
    quota: int,
    by: list[str] = STRATA,
    seed=42,
    strict: bool = False,
    id_col: str = "id",
) -> DataFrame:
    """An equal share per bucket, then a top-up from the rest up to the quota.

    A share is at least one row, so more buckets than quota overshoot it; ``strict`` caps the
    result.
    """
    tiers = [("all", quota)]
    out = _balance(df.withColumn("_tier", F.lit("all")), "_tier", tiers, by, seed, id_col)
    out = out.drop("_tier", "_drawn")
    return cap_total(out, quota, seed, id_col) if strict else out


def tier_quotas(target: int, core_pct: int = 70) -> list[tuple[str, int]]:
    """Tier 1 gets ``core_pct`` percent rounded down, tier 2 the rest, each at least one."""
    core = max(1, target * core_pct // 100)
    return [("Tier 1", core), ("Tier 2", max(1, target - core))]


def balance_tiers(
    df: DataFrame,
    target: int = 12500,
    by: list[str] = STRATA,
    seed=42,
    core_pct: int = 70,
    tier: str = "tier",
    id_col: str = "id",
) -> DataFrame:
    """``balance_quota`` per tier, then a top-up from the whole pool to the target.

    The result names the draw each row came from in ``drawn``.
    """
    out = _balance(df, tier, tier_quotas(target, core_pct), by, seed, id_col, target)
    return out.withColumnRenamed("_drawn", "drawn")


def _balance(df, tier, quotas, by, seed, id_col, target=None) -> DataFrame:
    """Bucket shares, per-tier top-up and overall top-up.

    No draw can need more than ``bound`` rows of a bucket or a tier, so the pool's keys are drawn and trimmed
    to that once per bucket and once per tier, and written down; shares, needs and top-ups then read these
    tables, not the pool, and whole rows are brought in at the end for the drawn keys only.  Counts
    that ``bound`` cuts short still give the right draws, because no share or need exceeds it.
    """
    bound = max([q for _, q in quotas] + [target or 0])
    order = _draw(seed, id_col)
    keys = list(dict.fromkeys([tier, *by, id_col]))
    drawn = draw_per_group(df.select(*keys), list(dict.fromkeys([tier, *by])), bound, seed, id_col, rank="_rn")
    ranked = materialize(drawn, "ranked")

    quota = F.lit(None).cast("long")
    for name, size in quotas:
        quota = F.when(F.col(tier) == name, F.lit(size).cast("long")).otherwise(quota)
    share = F.greatest(F.lit(1).cast("long"), F.floor(quota / F.col("_buckets")))
    per_tier = (  # one row per tier
        ranked.filter("_rn = 1")
        .groupBy(tier)
        .agg(F.count("*").alias("_buckets"))
        .filter(quota.isNotNull())
        .select(tier, share.alias("_share"), quota.alias("_quota"))
    )
    filled = (
        ranked.join(F.broadcast(per_tier), tier)
        .groupBy(tier, "_share", "_quota")
        .agg(
            F.count_if(F.col("_rn") <= F.col("_share")).alias("_first"),
            F.count("*").alias("_all"),
        )
        .withColumn("_need", F.greatest(F.lit(0), F.col("_quota") - F.col("_first")))
        .withColumn("_topped", F.least(F.col("_need"), F.col("_all") - F.col("_first")))
    )
    filled = materialize(filled, "filled")
    so_far = F.lit(filled.agg(F.sum(F.col("_first") + F.col("_topped"))).first()[0] or 0)

    ranked = ranked.join(F.broadcast(filled.select(tier, "_share", "_need")), tier)
    first = ranked.filter(F.col("_rn") <= F.col("_share")).withColumn("_drawn", F.lit("share"))
    spare = ranked.filter(F.col("_rn") > F.col("_share"))
    rest = materialize(draw_per_group(spare, [tier], bound, seed, id_col, rank="_spare"), "rest")
    topped = rest.filter(F.col("_spare") <= F.col("_need")).withColumn("_drawn", F.lit("top-up"))
    out = first.unionByName(topped.drop("_spare"))
    if target is not None:
        # At most ``bound`` keys of each tier are left here.
        left = rest.filter(F.col("_spare") > F.col("_need")).drop("_spare").withColumn("_whole", F.lit(0))
        extra = lowest_per_group(left, ["_whole"], order, target, "_pos").filter(F.col("_pos") <= target - so_far)
        out = out.unionByName(extra.drop("_pos", "_whole").withColumn("_drawn", F.lit("overall")))
    return bring_rows(df, out.select(*keys, "_drawn"), keys, ["_drawn"])


def equal_per_subreddit(df: DataFrame, total: int, seed=42, id_col: str = "id") -> DataFrame:
    """``max(1, total // subreddits)`` rows each, without top-up."""
    n_subs = df.agg(F.count_distinct("subreddit")).first()[0]
    share = max(1, total // max(1, n_subs))
    return draw_per_group(df, ["subreddit"], share, seed, id_col).drop("_rank")


def harvest_quotas(threshold: int = 500) -> dict[str, int]:
    """15, 80 and 5 percent of 80 percent of the candidate threshold."""
    soft = threshold * 80 // 100
    return {
        "Tier 1": max(1, soft * 15 // 100),
        "Tier 2": max(1, soft * 80 // 100),
        "Tier 3": max(1, soft * 5 // 100),
    }


def quota_extract(
    df: DataFrame,
    terms: list[str],
    quotas: dict[str, int],
    seed=42,
    max_terms: int | None = None,
    tier: str = "tier",
    id_col: str = "id",
    searched: str = "Tier 3",
) -> DataFrame:
    """Keyword candidates per tier, earliest year first, up to each tier's quota.

    Rows of the tier ``searched`` are results of a search already and need no term of the list.  The two kinds of rows are
    filtered apart, so each condition reaches the table it reads; the draw sees keys only, and the texts of the
    drawn ids alone move: a list of ids, unlike a semi join, is looked up below the joins that make ``df``.
    """
    term = F.coalesce(keyword_match("body", terms[:max_terms]), F.lit(False))
    year = F.substring(year_month("created_utc"), 1, 4).cast("int")
    dated = df.withColumn("year", year)
    keys = [tier, "year", id_col]
    hits = dated.filter(term).select(*keys).unionByName(dated.filter((F.col(tier) == searched) & ~term).select(*keys))
    ranked = draw_per_group(materialize(hits, "hits"), [tier], max(quotas.values()), seed, id_col, before=["year"])
    quota = F.lit(0)
    for name, size in quotas.items():
        quota = F.when(F.col(tier) == name, F.lit(size)).otherwise(quota)
    drawn = materialize(ranked.filter(F.col("_rank") <= quota).select(*keys), "drawn")
    ids = [r[0] for r in drawn.select(id_col).distinct().collect()]  # as many as the quotas have rows, at most
    taken = F.col(id_col).isin([i for i in ids if i is not None]) | (F.col(id_col).isNull() & F.lit(None in ids))
    named = df.filter(taken).filter((F.col(tier) == searched) | term)
    return bring_rows(named.withColumn("year", year), drawn, keys)


def shuffle(df: DataFrame, seed=42, id_col: str = "id", sort: bool = True) -> DataFrame:
    """A full random order as a key column; ``sort`` range-sorts the table by it."""
    df = df.withColumn("shuffle_key", sample_rank(id_col, seed))
    return df.orderBy("shuffle_key", id_col) if sort else df
