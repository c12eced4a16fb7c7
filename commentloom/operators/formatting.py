"""Training records, label JSON and chat messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.functions.flags import year_month
from commentloom.functions.text import strip_space
from commentloom.operators.dedup import dedup_by_text, union_tiers
from commentloom.operators.sampling import shuffle
from commentloom.schemas import FLAGS


def _or_null(df: DataFrame, name: str, kind: str) -> Column:
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def to_training_record(df: DataFrame, text: str = "body") -> DataFrame:
    """The flat record.  Its text is the raw body with its ends trimmed, not the clean one."""
    if "year_month" in df.columns:
        month = F.col("year_month")
    elif "created_utc" in df.columns:
        month = year_month("created_utc")
    else:
        month = F.lit(None).cast("string")
    return df.select(
        F.col("id").cast("string").alias("id"),
        strip_space(text).alias("text"),
        F.coalesce(_or_null(df, "subreddit", "string"), F.lit("unknown")).alias("subreddit"),
        _or_null(df, "created_utc", "long").alias("created_utc"),
        month.alias("year_month"),
        *[F.col(c).cast("int").alias(c) for c in FLAGS],
        strip_space(_or_null(df, "analysis", "string")).alias("analysis"),
    )


def json_string(c: Column) -> Column:
    """A quoted JSON string; only ``to_json``'s escaping is used, non-ASCII stays as it is."""
    whole = F.to_json(F.struct(c.alias("v")))
    return F.substring(whole, F.lit(6), F.length(whole) - 6)


def label_json(df: DataFrame, out: str = "label_json") -> DataFrame:
    """Flags in fixed order, then the analysis if there is one, with ``", "`` and ``": "``."""
    flags = [F.concat(F.lit(f'"{c}": '), F.col(c).cast("string")) for c in FLAGS]
    analysis = F.when(
        F.col("analysis").isNotNull(),
        F.concat(F.lit('"analysis": '), json_string(F.col("analysis"))),
    )
    body = F.concat_ws(", ", *flags, analysis)
    return df.withColumn(out, F.concat(F.lit("{"), body, F.lit("}")))


def _messages(system: Column, user: Column, assistant: Column) -> Column:
    roles = (("system", system), ("user", user), ("assistant", assistant))
    return F.array(
        *[F.struct(F.lit(r).alias("role"), c.alias("content")) for r, c in roles]
    )


def to_chatml(df: DataFrame, system_prompt: str) -> DataFrame:
    """Add ``messages``: system prompt, comment text, label JSON."""
    df = label_json(df, "_json")
    messages = _messages(F.lit(system_prompt), F.col("text"), F.col("_json"))
    return df.withColumn("messages", messages).drop("_json")


def turns_to_chatml(turns: DataFrame, system_prompt: str, size: int = 32) -> DataFrame:
    """Every turn of a conversation as chat messages behind the system prompt, ``size`` turns a record.

    A record holds the turns of one block of turn numbers, (conv_id, block), in order; so a conversation of
    any length stays whole and no record grows with it.
    """
    said = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    blocks = turns.groupBy("conv_id", F.floor(F.col("turn") / size).alias("block")).agg(
        F.array_sort(F.collect_list(said)).alias("_said")
    )
    first = F.array(F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")))
    rest = F.transform("_said", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    return blocks.select("conv_id", "block", F.concat(first, rest).alias("messages"))


def pairs_to_chatml(turns: DataFrame, system_prompt: str) -> DataFrame:
    """Each user turn with the assistant turn right after it, as a three-message record.

    (conv_id, turn) is unique, so even one giant conversation spreads over all tasks.
    """
    user = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("_user"))
    reply = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("_reply")
    )
    messages = _messages(F.lit(system_prompt), F.col("_user"), F.col("_reply"))
    return user.join(reply, ["conv_id", "turn"]).select(
        "conv_id", "turn", messages.alias("messages")
    )


def resolve_id_columns(df: DataFrame) -> DataFrame:
    """Undo a join's ``id_x`` / ``id_y`` pair: keep the first as ``id``."""
    if "id_x" in df.columns:
        if "id" in df.columns:
            df = df.withColumn("id", F.coalesce("id", "id_x")).drop("id_x")
        else:
            df = df.withColumnRenamed("id_x", "id")
    return df.drop("id_y")


def merge_masters(
    baseline: DataFrame, hunter: DataFrame, seed=42, col: str = "body", sort: bool = True
) -> DataFrame:
    """Both tables, one row per text with the baseline first, in random order."""
    both = union_tiers(
        baseline.withColumn("_source", F.lit(0)), hunter.withColumn("_source", F.lit(1))
    )
    both = resolve_id_columns(both)
    order = ["_source", *[c for c in ("created_utc", "id") if c in both.columns]]
    return shuffle(dedup_by_text(both, order, col).drop("_source"), seed, sort=sort)
