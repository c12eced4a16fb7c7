"""Labelling as tables: requests, responses, validation, retries and flags.

The model call itself is a callable handed to ``run_labeler``; everything around it is
DataFrame work.  A batch holds at most ``size`` comments, so its arrays are bounded.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.functions.terms import found
from commentloom.functions.text import bind, strip_space
from commentloom.operators.lexicon import term_entries
from commentloom.schemas import CATEGORY_FLAGS, FLAGS, LABEL_ITEM, SHORT_FLAGS

# Fixed value: the line that opens a request.
INSTRUCTION = "Label these comments:"
MAX_RETRIES = 4

RESPONSES = "batch long, attempt int, ids array<string>, request string, response string, error string"

_ITEMS = T.ArrayType(LABEL_ITEM)
# What fences an answer, and the word behind an opening fence.
_FENCE, _FENCE_WORD = "```", "json"


def build_requests(
    batches: DataFrame, instruction: str = INSTRUCTION, text: str = "body_clean"
) -> DataFrame:
    """One request per batch: the ordered ids and the prompt text.

    ``{n}`` in the instruction stands for the number of comments.
    """
    row = F.struct("pos", F.col("id").alias("id"), F.col(text).alias("text"))
    rows = F.array_sort(F.collect_list(row))  # at most one batch
    line = F.transform(
        "rows", lambda r: F.concat(F.lit("ID: "), r["id"], F.lit(" | Comment: "), r["text"])
    )
    head = F.replace(F.lit(instruction), F.lit("{n}"), F.size("ids").cast("string"))
    return (
        batches.groupBy("batch")
        .agg(rows.alias("rows"))
        .withColumn("ids", F.col("rows.id"))
        .select(
            "batch",
            F.lit(1).alias("attempt"),
            "ids",
            F.concat(head, F.lit("\n"), F.array_join(line, "\n")).alias("request"),
        )
    )


def run_labeler(
    requests: DataFrame,
    fn: Callable[[pd.DataFrame], list[str]],
    threads: int = 1,
    per_call: int | None = None,
) -> DataFrame:
    """Apply ``fn`` to requests; it returns one response text per row of the frame it is given.

    A task hands ``fn`` its Arrow batches in pieces of ``per_call`` rows, at most ``threads`` pieces at a time, and
    gives the responses back in the order of the requests; so all calls at one time are the partitions that
    run times ``threads``.  A call that raises, or returns another number of responses, costs its own rows only: they
    have no response and say why in ``error``, and the retry queue asks for them again.
    """
    added = [T.StructField("response", T.StringType()), T.StructField("error", T.StringType())]
    schema = T.StructType([*requests.schema.fields, *added])

    def call(piece: pd.DataFrame) -> pd.DataFrame:
        try:
            answers = list(fn(piece))
            if len(answers) != len(piece):
                raise ValueError(f"{len(answers)} responses for {len(piece)} requests")
        except Exception as error:
            return piece.assign(response=None, error=f"{type(error).__name__}: {error}")
        return piece.assign(response=answers, error=None)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(threads) as pool:
            for pdf in batches:
                size = per_call or max(1, len(pdf))
                running: deque = deque()
                for at in range(0, len(pdf), size):
                    if len(running) == threads:
                        yield running.popleft().result()
                    running.append(pool.submit(call, pdf.iloc[at : at + size]))
                while running:
                    yield running.popleft().result()

    return requests.mapInPandas(label, schema)


def results_column(response: Column) -> Column:
    """The label items of a response, or null.

    The response may sit in a code fence.  Valid JSON gives its list, else a non-empty
    ``results``, else its first list-valued key; anything else gives the first bare list of
    objects in the text, up to the first closing bracket at which it is valid JSON.  ``try_parse_json`` decides validity because ``from_json`` accepts an
    object where an array is due.
    """
    is_list, empty_list = r"(?s)^\s*\[", r"(?s)^\s*\[\s*\]\s*\z"

    def unfence(text: Column) -> Column:
        body = text.substr(F.lit(len(_FENCE) + 1), F.length(text))
        body = F.when(body.startswith(_FENCE_WORD), body.substr(F.lit(len(_FENCE_WORD) + 1), F.length(body))).otherwise(body)
        inner = F.when(body.endswith(_FENCE), body.substr(F.lit(1), F.length(body) - len(_FENCE))).otherwise(body)
        return F.when(text.startswith(_FENCE), strip_space(inner)).otherwise(text)

    def salvage(text: Column) -> Column:
        pieces = F.split(text.substr(F.regexp_instr(text, F.lit(r"\[\s*\{")), F.length(text)), "\\]")
        ends = F.when(F.size(pieces) > 1, F.sequence(F.lit(1), F.size(pieces) - 1))
        heads = F.transform(ends, lambda n: F.concat(F.array_join(F.slice(pieces, F.lit(1), n), "]"), F.lit("]")))
        return F.try_element_at(F.filter(heads, lambda h: F.try_parse_json(h).isNotNull()), F.lit(1))

    def from_object(members: Column) -> Column:
        results = members["results"]
        lists = F.filter(
            F.map_values(members), lambda v: v.rlike(is_list) & F.try_parse_json(v).isNotNull()
        )
        own = F.when(results.rlike(is_list) & ~results.rlike(empty_list), results)
        return F.coalesce(own, F.try_element_at(lists, F.lit(1)))

    def pick(text: Column) -> Column:
        valid = F.try_parse_json(text).isNotNull()
        members = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
        return (
            F.when(~valid, F.when(text.rlike(r"\[\s*\{"), salvage(text)))
            .when(text.startswith("["), text)
            .when(text.startswith("{"), bind(members, from_object))
        )

    picked = bind(bind(strip_space(response), unfence), pick)
    return F.when(picked.rlike(is_list), F.from_json(picked, _ITEMS))


def parse_responses(responses: DataFrame) -> DataFrame:
    return responses.withColumn("results", results_column(F.col("response")))


def validate_batch(parsed: DataFrame, out: str = "accepted") -> DataFrame:
    """A batch counts only if it has one result per input."""
    return parsed.withColumn(
        out, F.coalesce(F.size("results") == F.size("ids"), F.lit(False))
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return validate_batch(parsed).filter("accepted").drop("accepted")


def rejected(parsed: DataFrame) -> DataFrame:
    return validate_batch(parsed).filter("NOT accepted").drop("accepted")


def _reattach(batches: DataFrame, by_id: Column) -> DataFrame:
    paired = F.arrays_zip(F.col("ids").alias("own"), F.col("results").alias("item"))
    row_id = F.when(F.col("_by_id"), F.col("pair.item.id")).otherwise(F.col("pair.own"))
    fields = [F.col(f"pair.item.{name}").alias(name) for name in ("analysis", *SHORT_FLAGS)]
    return (
        batches.withColumn("_by_id", by_id)
        .select("batch", "_by_id", F.explode(paired).alias("pair"))
        .select("batch", row_id.alias("id"), *fields)
    )


def reattach_positional(batches: DataFrame) -> DataFrame:
    """Result i belongs to input i, whatever id the response carries."""
    return _reattach(batches, F.lit(False))


def reattach_by_id(batches: DataFrame) -> DataFrame:
    """Response ids hold if they are the batch's ids in any order, else positions do."""
    same = F.array_sort(F.array_distinct("ids")) == F.array_sort(
        F.array_distinct(F.col("results.id"))
    )
    return _reattach(batches, F.coalesce(same, F.lit(False)))


def retry_queue(parsed: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Rejected batches as requests of the next attempt, until the retries are used up."""
    return (
        rejected(parsed)
        .filter(F.col("attempt") <= max_retries)
        .withColumn("attempt", F.col("attempt") + 1)
        .drop("response", "results", "error")
    )


def rule_labeler(
    df: DataFrame,
    lexicon: DataFrame,
    categories: list[str] = CATEGORY_FLAGS,
    col: str = "body",
    id_col: str = "id",
) -> DataFrame:
    """Flags from lexicon hits; ``discriminatory_hate_speech`` is 1 iff any category is.

    Each row is judged by its own text, so rows are neither joined nor grouped and ids may repeat or be
    missing.  All categories' terms are searched in one pass.
    """
    entries = {
        term: [{"category": (e["category"] or "").lower()} for e in own] for term, own in term_entries(lexicon).items()
    }
    hits = F.transform(found(F.lower(col), entries, "struct<category:string>"), lambda x: x["category"])
    marked = df.withColumn("_hits", hits)
    hit = {c: F.coalesce(F.array_contains("_hits", c), F.lit(False)).cast("int") for c in categories}
    out = marked.withColumns(hit).drop("_hits")
    return out.withColumn("discriminatory_hate_speech", F.greatest(*[F.col(c) for c in categories]))


def check_label_invariants(df: DataFrame, short: bool = False) -> DataFrame:
    """Rows that break a label rule, with the reasons."""
    names = SHORT_FLAGS if short else FLAGS
    dhs, dims = names[2], names[3:]
    any_dim = F.greatest(*[F.coalesce(F.col(c), F.lit(0)) for c in dims])
    reasons = [F.when(F.col(dhs) != any_dim, F.lit(f"{dhs} differs from its categories"))]
    for name in names:
        reasons.append(F.when(F.col(name).isNull(), F.lit(f"{name} is null")))
        reasons.append(F.when(~F.col(name).isin(0, 1), F.lit(f"{name} is not 0 or 1")))
    return df.withColumn("reasons", F.array_compact(F.array(*reasons))).filter(
        F.size("reasons") > 0
    )


def flag_value(c) -> Column:
    """A flag as an integer, or null: whole numbers, numeric text, true and false."""
    text = F.lower(F.trim((F.col(c) if isinstance(c, str) else c).cast("string")))
    text = F.when(text == "true", "1").when(text == "false", "0").otherwise(text)
    return text.try_cast("double").try_cast("int")


def coerce_flags(df: DataFrame, flags: list[str] = SHORT_FLAGS) -> DataFrame:
    """Flags as integers.  A row with an unusable flag goes; a missing column is all 0."""
    present = [c for c in flags if c in df.columns]
    df = df.withColumns({c: flag_value(c) for c in present}).dropna(subset=present)
    missing = [c for c in flags if c not in df.columns]
    return df.withColumns({c: F.lit(0) for c in missing}) if missing else df


def label_checkpoint(df: DataFrame, path: str, round_no: int) -> None:
    """Save one round of responses; rewriting a round replaces it."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/round={round_no}")


def unlabelled(requests: DataFrame, saved: DataFrame, on="batch") -> DataFrame:
    """Requests that no saved round answered."""
    return requests.join(saved.select(on).distinct(), on, "left_anti")
