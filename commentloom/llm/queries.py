"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.llm import align, ann, bpe, chat, langid, mixing, repeats, runs, secrets, simhash, tokens, vafile, warc
from commentloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


@query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang")
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op2_hilbert_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), 10, F.col("_id") % 100 == 0)


@query
def op3_token_counts(spark, sf_dir):
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_secret_scan(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.filter("_spans", lambda x: x["k"] < len(secrets.BASE))
    count = lambda k: F.size(F.filter("_spans", lambda x: x["k"] == k)).cast("bigint")
    return found.select(
        "_row.doc_id",
        *[count(k).alias(f"n_{rule.kind}") for k, rule in enumerate(secrets.BASE)],
        F.sha2(secrets.listed(base, secrets.RULES), 256).alias("base_sha256"),
        secrets.listed(F.col("_spans"), secrets.RULES).alias("spans"),
    )


def _spans_sql(rule: secrets.Rule, order: int) -> str:
    """A list of (start, order, kind, end) structs of one rule over ``t``."""
    regex = rule.regex.replace("'", "''")
    return f"""
  (SELECT list({{'s': s, 'k': {order}, 'n': '{rule.kind}', 'e': s + m}}) FROM (
     SELECT m, v, (sum(g) OVER (ORDER BY i) + sum(m) OVER (ORDER BY i) - m)::INT AS s FROM (
       SELECT unnest(range(1, 1 + len(found))) AS i, unnest(list_transform(found, lambda x: length(x))) AS m,
              unnest(list_transform(vals, lambda x: length(x))) AS v, unnest(list_transform(gaps[1:len(found)], lambda x: length(x))) AS g
       FROM (SELECT regexp_extract_all(t, '{regex}', 0) AS found, regexp_extract_all(t, '{regex}', {rule.group}) AS vals,
                    string_split_regex(t, '{regex}') AS gaps)
     )) WHERE v >= {rule.least})"""


_KINDS = [f"coalesce({_spans_sql(r, i)}, [])" for i, r in enumerate(secrets.RULES)]
ORACLES["op4_secret_scan"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT doc_id, {", ".join(f"{sql} AS k{i}" for i, sql in enumerate(_KINDS))} FROM d),
y AS (SELECT *, list_sort(list_concat(k0, k1, k2)) AS base, list_sort(list_concat({", ".join(f"k{i}" for i in range(len(_KINDS)))})) AS every FROM x)
SELECT doc_id, len(k0)::BIGINT AS n_assign, len(k1)::BIGINT AS n_access, len(k2)::BIGINT AS n_hex,
       sha256(array_to_string(list_transform(base, lambda z: z.n || ':' || z.s || ':' || z.e), ',')) AS base_sha256,
       array_to_string(list_transform(every, lambda z: z.n || ':' || z.s || ':' || z.e), ',') AS spans
FROM y
"""


@query
def op5_simhash_dedup(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op6_repeated_bytes(spark, sf_dir):
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op7_vafile_topk(spark, sf_dir):
    return vafile.top_inner(table(spark, sf_dir, "embeddings"), 5, F.col("_id") % 50 == 0)


@query
def op8_bpe_codec(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(table(spark, sf_dir, "documents"), path, digests=True)


@query
def op10_warc_round_trip(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLES["op10_warc_round_trip"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


@query
def op9_source_mix(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"), mixing.default_levels())
    return mixed.select(
        "_row.doc_id", "_path.domain", "_path.language", "_path.source", F.col("_epoch").alias("epoch"), F.col("_tokens").alias("n_tokens")
    )


def _share_sql(out: str, nodes: str, parent: str, node: str) -> str:
    """The even share of a parent's budget among its children, as common table expressions."""
    order = f"PARTITION BY {parent} ORDER BY cap::DOUBLE / w::DOUBLE, {node}"
    return f"""
{out}_a AS (
  SELECT *, coalesce(sum(cap) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS before,
         sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS ahead
  FROM ({nodes}) WHERE w > 0
), {out}_b AS (
  SELECT *, cap::HUGEINT * ahead <= w::HUGEINT * (budget::HUGEINT - before) AS is_full FROM {out}_a
), {out}_c AS (
  SELECT *, budget::HUGEINT - coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {parent}), 0)::HUGEINT AS rest,
         sum(CASE WHEN NOT is_full THEN w END) OVER (PARTITION BY {parent})::HUGEINT AS open_w
  FROM {out}_b
), {out} AS (
  SELECT *, CASE WHEN is_full THEN cap ELSE (rest * w::HUGEINT) // open_w END::BIGINT AS share FROM {out}_c
)"""


ORACLES["op9_source_mix"] = rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, 'none') AS language, coalesce(source, 'none') AS source,
         len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\f\r]+'))::BIGINT AS n,
         CASE WHEN coalesce(regexp_extract(source, '[0-9]{{1,9}}'), '') = '' THEN 'other'
              ELSE (['web', 'books', 'news'])[regexp_extract(source, '[0-9]{{1,9}}')::INT % 3 + 1] END AS domain,
         CASE lang WHEN 'en' THEN 6 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END AS w_language
  FROM documents
), leaves AS (
  SELECT domain, language, source, max(w_language) AS w_language, sum(n)::BIGINT AS tokens, (2 * sum(n))::BIGINT AS cap,
         CASE domain WHEN 'web' THEN 5 WHEN 'books' THEN 3 WHEN 'news' THEN 2 ELSE 1 END AS w_domain
  FROM d GROUP BY domain, language, source
), root AS (
  SELECT least((sum(tokens)::HUGEINT * 3) // 5, sum(cap)::HUGEINT)::BIGINT AS budget FROM leaves
), {_share_sql('s1', 'SELECT 0 AS top, domain, max(w_domain) AS w, sum(cap)::BIGINT AS cap, max(budget) AS budget FROM leaves, root GROUP BY domain', 'top', 'domain')},
{_share_sql('s2', 'SELECT l.domain, language, max(w_language) AS w, sum(l.cap)::BIGINT AS cap, max(share) AS budget FROM leaves l JOIN s1 ON s1.domain = l.domain GROUP BY l.domain, language', 'domain', 'language')},
{_share_sql('s3', 'SELECT l.domain, l.language, l.source, 1 AS w, l.cap, l.tokens, s2.share AS budget FROM leaves l JOIN s2 ON s2.domain = l.domain AND s2.language = l.language', 'domain, language', 'source')},
plan AS (
  SELECT domain, language, source, CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS full_epochs,
         CASE WHEN tokens > 0 THEN share % tokens ELSE share END AS part
  FROM s3
), placed AS (
  SELECT d.*, full_epochs, part,
         ('0x' || substr(md5('mix|' || (full_epochs + 1)::VARCHAR || '|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS place
  FROM d JOIN plan USING (domain, language, source)
), upto AS (
  SELECT *, sum(n) OVER (PARTITION BY domain, language, source ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto FROM placed
), taken AS (
  SELECT *, full_epochs + (part > 0 AND upto <= part)::INT AS times FROM upto
)
SELECT doc_id, domain, language, source, epoch::INT AS epoch, n AS n_tokens
FROM taken, LATERAL (SELECT unnest(generate_series(1, times)) AS epoch)
"""


@query
def op11_token_alignment(spark, sf_dir):
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(table(spark, sf_dir, "documents"), a, b)


def _planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth text by crc32 repeats some of its words from one place on, as op12's contract says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words"))
    g, n = F.col("g"), F.size("words")
    a = g % n
    p = 1 + F.floor((n - F.col("a")) / (3 + g % 8))
    cut = cut.withColumn("a", F.when(n > 0, a)).withColumn("p", p)
    again = F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))))
    return cut.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


@query
def op12_periodic_runs(spark, sf_dir):
    found = runs.find_runs(_planted(table(spark, sf_dir, "documents")))
    whole = lambda x, y: F.floor(x.cast("double") / y.cast("double"))
    order = lambda r: F.struct(
        (r["length"] / r["period"]).alias("exponent"), (-r["start"]).alias("start"), (-r["period"]).alias("period"), r["length"].alias("length")
    )
    best = F.array_max(F.transform("runs", order)).alias("best")
    listed = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best, listed.alias("listed"), "collapsed").select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        whole(F.col("best.length") * 1000, -F.col("best.period")).alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op13_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    said = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    return chat.read_back(chat.format_parts(rows.unionByName(extra)))


def _escaped_sql(column: str) -> str:
    out = f"replace({column}, '\\', '\\\\')"
    for c in chat.INSTRUCT.control:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


def _allowed_sql(template: chat.Template) -> str:
    pairs = [f"('{state}', '{role}')" for state, roles in template.follows.items() for role in roles]
    return f"(state, role) IN ({', '.join(pairs)})"


_KNOWN = ", ".join(f"'{r}'" for r in chat.INSTRUCT.parts)
_AROUND = " ".join(f"WHEN '{r}' THEN {len(p.open) + len(p.close)}" for r, p in chat.INSTRUCT.parts.items())
_OTHER = len(chat.INSTRUCT.other.open) - len(chat.ROLE) + len(chat.INSTRUCT.other.close)

ORACLES["op13_chat_format"] = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, x.turn, x.role, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS x(turn, role)
), u AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM t
), v AS (
  SELECT *, coalesce(last_value(CASE WHEN role IN ({_KNOWN}) THEN role END IGNORE NULLS) OVER (
             PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 'start') AS state,
         coalesce(last_value(CASE WHEN role IN ({_KNOWN}) THEN role END IGNORE NULLS) OVER (
             PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'start') AS final
  FROM u
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length({_escaped_sql("text")})
           + CASE role {_AROUND} ELSE {_OTHER} + length({_escaped_sql("role")}) END)::BIGINT AS formatted_chars,
       count(*) FILTER (NOT {_allowed_sql(chat.INSTRUCT)})::BIGINT AS n_violations,
       any_value(final) IN ({", ".join(f"'{e}'" for e in chat.INSTRUCT.ends)}) AS complete
FROM v GROUP BY conv_id
"""
