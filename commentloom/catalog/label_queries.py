"""Labelling tables, training records and ledgers."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from commentloom.catalog import views as v
from commentloom.catalog.registry import query
from commentloom.catalog.report_queries import STOPS, found_lexicon, minority_sql
from commentloom.catalog.row_queries import C, L
from commentloom.operators import audit, formatting, indexing, labeling, ledger
from commentloom.schemas import CATEGORY_FLAGS, FLAGS, SHORT_FLAGS, SHORT_TO_LONG
from commentloom.session import scratch_path

BATCHES = (
    "batches AS (SELECT *, i // 20 AS batch, i % 20 AS pos FROM (SELECT *, row_number() OVER"
    " (ORDER BY md5(concat('|', id)), id) - 1 AS i FROM labelled))"
)


def batches(spark, sf):
    return indexing.build_batches(v.labelled(spark, sf))


@query("l1_build_batches", f"{L}, {BATCHES} SELECT id, batch, pos FROM batches")
def _(spark, sf):
    return batches(spark, sf).select("id", "batch", "pos")


@query(
    "l2_build_requests",
    f"{L}, {BATCHES} SELECT batch, array_to_string(list(id ORDER BY pos), ',') AS ids,"
    " concat('Label these comments:', chr(10), string_agg(concat('ID: ', id, ' | Comment: ', text),"
    " chr(10) ORDER BY pos)) AS request FROM batches GROUP BY batch",
)
def _(spark, sf):
    requests = labeling.build_requests(batches(spark, sf), text="text")
    return requests.select("batch", F.array_join("ids", ",").alias("ids"), "request")


def word_labels(pdf):
    """A stand-in model: one flag per planted word, read from the request text."""
    words = dict(zip(("cst", "cr", "rx", "mg"), v.WORDS.values(), strict=True))
    out = []
    for ids, request in zip(pdf["ids"], pdf["request"], strict=True):
        low, results = request.lower(), []
        starts = [low.index(f"id: {i} | comment: ") for i in ids] + [len(low)]
        for k, i in enumerate(ids):
            text = low[starts[k] : starts[k + 1]]
            flags = {short: int(word in text) for short, word in words.items()}
            dhs = max(flags.values())
            results.append({"id": i, "analysis": "", "pv": 0, "tah": 0, "dhs": dhs, **flags})
        out.append(json.dumps({"results": results}))
    return out


@query(
    "l3_run_labeler",
    f"{L} SELECT id, "
    + ", ".join(
        f"CAST(contains(lower(text), '{w}') AS INT) AS {s}"
        for s, w in zip(("cst", "cr", "rx", "mg"), v.WORDS.values(), strict=True)
    )
    + " FROM labelled",
)
def _(spark, sf):
    requests = labeling.build_requests(batches(spark, sf), text="text")
    parsed = labeling.parse_responses(labeling.run_labeler(requests, word_labels))
    labels = labeling.coerce_flags(labeling.reattach_positional(labeling.accepted(parsed)))
    return labels.select("id", "cst", "cr", "rx", "mg")


# Responses in eight shapes, one per batch in turn: the asked-for object, a bare list, another
# key, a fence with flags as text, prose around a list, a cut-off object, one item short, and
# the items in reverse order.
def responses(spark, sf):
    own = [F.col(SHORT_TO_LONG[s]).alias(s) for s in SHORT_FLAGS]
    texts = [F.col(SHORT_TO_LONG[s]).cast("string").alias(s) for s in SHORT_FLAGS]
    note = F.concat(F.lit("note "), "id").alias("analysis")
    rows = batches(spark, sf).select(
        "batch",
        "pos",
        "id",
        F.to_json(F.struct("id", note, *own)).alias("item"),
        F.to_json(F.struct("id", note, *texts)).alias("item_text"),
    )
    grouped = rows.groupBy("batch").agg(
        F.array_sort(F.collect_list(F.struct("pos", "id", "item", "item_text"))).alias("r")
    )

    def listed(items):
        return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))

    items = F.col("r.item")
    results = F.concat(F.lit('{"results": '), listed(items), F.lit("}"))
    shape = F.col("batch") % 8
    fence = F.concat(
        F.lit('```json\n{"results": '), listed(F.col("r.item_text")), F.lit("}\n```")
    )
    response = (
        F.when(shape == 0, results)
        .when(shape == 1, listed(items))
        .when(shape == 2, F.concat(F.lit('{"model": "m", "labels": '), listed(items), F.lit("}")))
        .when(shape == 3, fence)
        .when(shape == 4, F.concat(F.lit("Here: "), listed(items), F.lit(" as asked.")))
        .when(shape == 5, F.substring(results, F.lit(1), F.length(results) - 10))
        .when(shape == 6, listed(F.slice(items, F.lit(2), F.size(items) - 1)))
        .otherwise(listed(F.reverse(items)))
    )
    return grouped.select(
        "batch", F.lit(1).alias("attempt"), F.col("r.id").alias("ids"), response.alias("response")
    )


def parsed(spark, sf):
    return labeling.parse_responses(responses(spark, sf))


_SHAPES = (
    f"{L}, {BATCHES}, sized AS (SELECT *, count(*) OVER (PARTITION BY batch) AS size,"
    " batch % 8 AS shape FROM batches)"
)
_GOOD = "shape NOT IN (5, 6)"
_FLAGS = ", ".join(f"{long} AS {short}" for short, long in SHORT_TO_LONG.items())
_OWN = f"s.id, concat('note ', x.id) AS analysis, {', '.join(f'x.{c}' for c in FLAGS)}"
_NAMES = ", ".join(f"x.{long} AS {short}" for short, long in SHORT_TO_LONG.items())


@query(
    "l4_parse_responses",
    f"{_SHAPES} SELECT batch, id, concat('note ', id) AS analysis, {_FLAGS} FROM sized"
    " WHERE shape <> 5 AND NOT (shape = 6 AND pos = 0)",
)
def _(spark, sf):
    items = parsed(spark, sf).select("batch", F.inline("results"))
    return items.select("batch", "id", "analysis", *[F.col(c).cast("int") for c in SHORT_FLAGS])


@query(
    "l5_validate_batch",
    f"{_SHAPES} SELECT DISTINCT batch, size, {_GOOD} AS accepted FROM sized",
)
def _(spark, sf):
    checked = labeling.validate_batch(parsed(spark, sf))
    return checked.select("batch", F.size("ids").cast("long").alias("size"), "accepted")


@query(
    "l6_reattach_positional",
    f"{_SHAPES} SELECT s.batch, s.id, concat('note ', x.id) AS analysis, {_NAMES} FROM sized s"
    " JOIN sized x ON x.batch = s.batch"
    " AND x.pos = CASE WHEN s.shape = 7 THEN s.size - 1 - s.pos ELSE s.pos END"
    " WHERE s.shape NOT IN (5, 6)",
)
def _(spark, sf):
    rows = labeling.reattach_positional(labeling.accepted(parsed(spark, sf)))
    return labeling.coerce_flags(rows)


@query(
    "l7_reattach_by_id",
    f"{_SHAPES} SELECT batch, id, concat('note ', id) AS analysis, {_FLAGS} FROM sized"
    f" WHERE {_GOOD}",
)
def _(spark, sf):
    return labeling.coerce_flags(labeling.reattach_by_id(labeling.accepted(parsed(spark, sf))))


@query(
    "l8_retry_queue",
    f"{_SHAPES} SELECT batch, CAST(2 AS INT) AS attempt, max(size) AS size FROM sized"
    " WHERE shape IN (5, 6) GROUP BY batch",
)
def _(spark, sf):
    queue = labeling.retry_queue(parsed(spark, sf))
    return queue.select("batch", "attempt", F.size("ids").cast("long").alias("size"))


_RULES = (
    f"{L}, {minority_sql(12)}, found AS (SELECT c.id, m.category FROM comments c JOIN minority m"
    " ON contains(lower(c.body), m.word)), rules AS (SELECT c.id, "
    + ", ".join(
        f"max(CASE WHEN f.category = '{c}' THEN 1 ELSE 0 END) AS {c}" for c in CATEGORY_FLAGS
    )
    + ", max(CASE WHEN f.category IS NULL THEN 0 ELSE 1 END) AS discriminatory_hate_speech"
    " FROM comments c LEFT JOIN found f ON f.id = c.id GROUP BY c.id)"
)
_REPEATED = (  # every id twice, the second time with a text of its own
    f"{L}, {minority_sql(12)}, twice AS (SELECT id, body FROM comments UNION ALL SELECT id, concat(id, ' fine') FROM comments)"
    " SELECT t.id, t.body, "
    + ", ".join(
        f"CAST(EXISTS (SELECT 1 FROM minority m WHERE m.category = '{c}' AND contains(lower(t.body), m.word)) AS INT) AS {c}"
        for c in CATEGORY_FLAGS
    )
    + " FROM twice t"
)


@query("l9_rule_labeler_repeated_ids", _REPEATED)
def _(spark, sf):
    rows = v.comments(spark, sf).select("id", "body")
    twice = rows.unionByName(rows.withColumn("body", F.concat("id", F.lit(" fine"))))
    return labeling.rule_labeler(twice, found_lexicon(spark, sf)).select("id", "body", *CATEGORY_FLAGS)



@query("l9_rule_labeler", f"{_RULES} SELECT * FROM rules")
def _(spark, sf):
    out = labeling.rule_labeler(v.comments(spark, sf), found_lexicon(spark, sf))
    return out.select("id", *CATEGORY_FLAGS, "discriminatory_hate_speech")


# Flags with planted faults: a negative score breaks a value, a high one removes it.
_FAULTY = (
    f"{L}, faulty AS (SELECT l.id, CASE WHEN c.score < 0 THEN 3 WHEN c.score > 7 THEN NULL"
    " ELSE l.caste END AS caste, l.discriminatory_hate_speech AS dhs, l.communal_religious AS cr,"
    " l.regional_xenophobic AS rx, l.misogyny_gender AS mg"
    " FROM labelled l JOIN comments c ON c.id = l.id)"
)


def faulty(spark, sf):
    scores = v.comments(spark, sf).select("id", "score")
    caste = (
        F.when(F.col("score") < 0, 3)
        .when(F.col("score") > 7, F.lit(None))
        .otherwise(F.col("caste"))
    )
    return v.labelled(spark, sf).join(scores, "id").withColumn("caste", caste)


@query(
    "l10_check_label_invariants",
    f"{_FAULTY} SELECT id, list_filter([CASE WHEN dhs <> greatest(coalesce(caste, 0), cr, rx, mg)"
    " THEN 'discriminatory_hate_speech differs from its categories' END, CASE WHEN caste IS NULL"
    " THEN 'caste is null' END, CASE WHEN caste NOT IN (0, 1) THEN 'caste is not 0 or 1' END],"
    " lambda x: x IS NOT NULL).array_to_string('; ') AS reasons FROM faulty WHERE caste IS NULL"
    " OR caste NOT IN (0, 1) OR dhs <> greatest(caste, cr, rx, mg)",
)
def _(spark, sf):
    bad = labeling.check_label_invariants(faulty(spark, sf))
    return bad.select("id", F.array_join("reasons", "; ").alias("reasons"))


@query(
    "l11_coerce_flags",
    f"{L} SELECT l.id, l.caste AS cst, CAST(0 AS INT) AS mg FROM labelled l"
    " JOIN comments c ON c.id = l.id WHERE c.score BETWEEN 0 AND 7",
)
def _(spark, sf):
    text = (
        F.when(F.col("score") < 0, "yes")
        .when(F.col("score") > 7, F.lit(None))
        .when(F.col("score") > 4, F.concat(F.lit(" "), F.col("caste").cast("string")))
        .otherwise(F.when(F.col("caste") == 1, "true").otherwise("0.0"))
    )
    scores = v.comments(spark, sf).select("id", "score")
    rows = v.labelled(spark, sf).join(scores, "id").select("id", text.alias("cst"))
    return labeling.coerce_flags(rows, ["cst", "mg"])


@query(
    "l12_label_checkpoint",
    f"{_SHAPES} SELECT DISTINCT batch FROM sized WHERE shape IN (5, 6)",
)
def _(spark, sf):
    path = scratch_path(spark, "labels")
    good = labeling.accepted(parsed(spark, sf)).select("batch", "response")
    for _attempt in range(2):  # the second save of a round replaces the first
        labeling.label_checkpoint(good, path, 1)
    saved = spark.read.schema("batch long, response string, round int").parquet(path)
    return labeling.unlabelled(responses(spark, sf), saved).select("batch")


# --- usage -----------------------------------------------------------------------------------

_USAGE = (
    "usage AS (SELECT length(text) AS p, length(subreddit) AS c,"
    " CASE WHEN caste = 1 THEN NULL ELSE length(text) + length(subreddit) + 1 END AS t,"
    " CASE WHEN profanity_vulgarity = 1 THEN NULL ELSE length(text) // 2 END AS h,"
    " length(text) // 3 AS d FROM labelled)"
)


@query(
    "a20_token_usage",
    f"{L}, {_USAGE}, s AS (SELECT CAST(sum(p) AS BIGINT) AS prompt_tokens,"
    " CAST(sum(c) AS BIGINT) AS completion_tokens, CAST(sum(coalesce(t, p + c)) AS BIGINT)"
    " AS total_tokens, CAST(sum(coalesce(h, d)) AS BIGINT) AS cache_hits,"
    " CAST(sum(p - coalesce(h, d)) AS BIGINT) AS cache_misses FROM usage)"
    " SELECT *, round(cache_hits * 100.0::DOUBLE / prompt_tokens, 4) AS hit_rate,"
    " round(total_tokens::DOUBLE / (SELECT count(*) FROM labelled), 4) AS tokens_per_comment"
    " FROM s",
)
def _(spark, sf):
    df = v.labelled(spark, sf)
    prompt, completion = F.length("text").cast("long"), F.length("subreddit").cast("long")
    usage = df.select(
        prompt.alias("prompt_tokens"),
        completion.alias("completion_tokens"),
        F.when(F.col("caste") != 1, prompt + completion + 1).alias("total_tokens"),
        F.when(F.col("profanity_vulgarity") != 1, F.floor(prompt / 2)).alias(
            "prompt_cache_hit_tokens"
        ),
        F.floor(prompt / 3).alias("cached_tokens"),
    )
    return audit.token_usage(usage, df)


# --- records ---------------------------------------------------------------------------------

_WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def _strip(x):
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


RECORDS = (
    f"records AS (SELECT l.id, {_strip('c.body')} AS text, CASE WHEN c.score < 0 THEN 'unknown'"
    " ELSE l.subreddit END AS subreddit, l.created_utc, l.year_month, "
    + ", ".join(f"l.{c}" for c in FLAGS)
    + f", CASE WHEN c.score > 5 THEN NULL ELSE {_strip('l.text')} END AS analysis"
    " FROM labelled l JOIN comments c ON c.id = l.id)"
)


def records(spark, sf):
    """Labelled comments with gaps: no subreddit on some rows, no analysis on others."""
    raw = v.comments(spark, sf).select("id", "body", "score")
    rows = v.labelled(spark, sf).join(raw, "id").withColumns(
        {
            "subreddit": F.when(F.col("score") >= 0, F.col("subreddit")),
            "analysis": F.when(F.col("score") <= 5, F.col("text")),
        }
    )
    return formatting.to_training_record(rows)


@query("m1_to_training_record", f"{L}, {RECORDS} SELECT * FROM records")
def _(spark, sf):
    return records(spark, sf)


_JSON = (
    "concat('{', "
    + ", ', ', ".join(f"'\"{c}\": ', {c}" for c in FLAGS)
    + ", CASE WHEN analysis IS NOT NULL THEN concat(', \"analysis\": ', to_json(analysis))"
    " ELSE '' END, '}')"
)
PROMPT = "Label the comment."


@query("m2_label_json", f"{L}, {RECORDS} SELECT id, {_JSON} AS label_json FROM records")
def _(spark, sf):
    return formatting.label_json(records(spark, sf)).select("id", "label_json")


@query(
    "m3_to_chatml",
    f"{L}, {RECORDS} SELECT id, 'system/user/assistant' AS roles, '{PROMPT}' AS system, text AS"
    f" user_text, {_JSON} AS assistant_text FROM records",
)
def _(spark, sf):
    m = formatting.to_chatml(records(spark, sf), PROMPT)
    return m.select(
        "id",
        F.array_join("messages.role", "/").alias("roles"),
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[1]["content"].alias("user_text"),
        F.col("messages")[2]["content"].alias("assistant_text"),
    )


@query(
    "m4_turns_to_chatml",
    f"SELECT conv_id, turn // 4 AS block, 'system={PROMPT}|' || string_agg(coalesce(role, '') || '=' || coalesce(text, ''), '|'"
    " ORDER BY turn, role, text) AS said, count(*) + 1 AS n_messages FROM conversations GROUP BY ALL",
)
def _(spark, sf):
    m = formatting.turns_to_chatml(v.table(spark, sf, "conversations"), PROMPT, 4)
    lines = F.transform("messages", lambda x: F.concat_ws("=", x["role"], x["content"]))
    return m.select(
        "conv_id", "block", F.array_join(lines, "|").alias("said"), F.size("messages").cast("long").alias("n_messages")
    )


@query(
    "m4_turn_pairs",
    f"SELECT u.conv_id, u.turn, '{PROMPT}' AS system, u.text AS user_text, a.text AS"
    " assistant_text FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id"
    " AND a.turn = u.turn + 1 WHERE u.role = 'user' AND a.role = 'assistant'",
)
def _(spark, sf):
    m = formatting.pairs_to_chatml(v.table(spark, sf, "conversations"), PROMPT)
    return m.select(
        "conv_id",
        "turn",
        F.col("messages")[0]["content"].alias("system"),
        F.col("messages")[1]["content"].alias("user_text"),
        F.col("messages")[2]["content"].alias("assistant_text"),
    )


_ROWS = "row_number() OVER (ORDER BY created_utc, body) - 1"


@query(
    "m5_fallback_ids",
    f"{C} SELECT CASE WHEN score >= 0 THEN id ELSE concat('migrated_', {_ROWS}) END AS id, body"
    " FROM comments",
)
def _(spark, sf):
    rows = v.comments(spark, sf).withColumn("id", F.when(F.col("score") >= 0, F.col("id")))
    return formatting_ids(rows)


def formatting_ids(rows):
    return indexing.fallback_ids(rows, ["created_utc", "body"]).select("id", "body")


@query(
    "m6_merge_masters",
    f"{C}, both_rows AS (SELECT 0 AS src, id, body, created_utc FROM comments UNION ALL"
    " SELECT 1, concat('h', id), body, created_utc - 1 FROM comments UNION ALL"
    " SELECT 1, concat('x', id), concat(body, ' x'), created_utc FROM comments),"
    " firsts AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY src, created_utc, id)"
    " AS n FROM both_rows) SELECT id, body, md5(concat('42|', id)) AS shuffle_key"
    " FROM firsts WHERE n = 1",
)
def _(spark, sf):
    base = v.comments(spark, sf).select("id", "body", "created_utc")
    left = base.withColumnRenamed("id", "id_x").withColumn("id_y", F.lit("y"))
    copies = base.select(
        F.concat(F.lit("h"), "id").alias("id_x"), "body", (F.col("created_utc") - 1)
        .alias("created_utc")
    )
    fresh = base.select(
        F.concat(F.lit("x"), "id").alias("id_x"), F.concat("body", F.lit(" x")).alias("body"),
        "created_utc"
    )
    merged = formatting.merge_masters(left, copies.unionByName(fresh))
    return merged.select("id", "body", "shuffle_key")


# --- ledgers ---------------------------------------------------------------------------------

_CHUNKS = (
    f"{C}, chunked AS (SELECT *, i // 100 AS chunk,"
    " printf('migration_base_part_%03d', i // 100) AS chunk_name FROM (SELECT *,"
    " row_number() OVER (ORDER BY created_utc, id) - 1 AS i FROM comments)),"
    " manifest AS (SELECT chunk, chunk_name, count(*) AS n_rows,"
    " CAST(sum(count(*)) OVER (ORDER BY chunk) AS BIGINT) AS total_rows FROM chunked"
    " GROUP BY chunk, chunk_name)"
)


def chunked(spark, sf):
    return indexing.assign_chunks(v.comments(spark, sf), ["created_utc", "id"], 100)


@query("s10_assign_chunks", f"{_CHUNKS} SELECT id, chunk, chunk_name FROM chunked")
def _(spark, sf):
    return chunked(spark, sf).select("id", "chunk", "chunk_name")


@query(
    "g1_ledger_append",
    f"{C} SELECT id FROM comments WHERE {v.KEPT}",
)
def _(spark, sf):
    data, ids = scratch_path(spark, "published"), scratch_path(spark, "ledger")
    kept = v.comments(spark, sf).select("id", "body").filter(v.KEPT)
    kept.write.parquet(data)
    published = spark.read.schema("id string, body string").parquet(data)
    ledger.ledger_append(published.filter("length(body) > 500"), ids)
    ledger.ledger_append(published, ids)
    ledger.ledger_append(published, ids)
    return ledger.read_ledger(spark, ids)


@query(
    "g2_pending_chunks",
    f"{_CHUNKS} SELECT id, chunk_name FROM chunked WHERE chunk_name NOT IN (SELECT chunk_name FROM"
    " manifest WHERE total_rows * 2 <= (SELECT count(*) FROM comments))",
)
def _(spark, sf):
    rows = chunked(spark, sf)
    total = v.comments(spark, sf).agg(F.count("*")).scalar()
    done = ledger.manifest(rows).filter(F.col("total_rows") * 2 <= total)
    return ledger.pending_chunks(rows, done).select("id", "chunk_name")


@query("g3_manifest", f"{_CHUNKS} SELECT * FROM manifest")
def _(spark, sf):
    return ledger.manifest(chunked(spark, sf))
