"""Text column operators over pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentloom.catalog import views as v
from commentloom.catalog.registry import query
from commentloom.functions import text as t
from commentloom.operators import filters

# DuckDB spellings of the same patterns.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NONSPACE = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"


def rx(x, pattern, repl=""):
    return f"regexp_replace({x}, '{pattern}', '{repl}', 'g')"


def sql_strip(x):
    return rx(x, f"^{WS}+|{WS}+$")


def sql_squash(x, run=2):
    return sql_strip(rx(x, f"{WS}{{{run},}}", " "))


def sql_zero_width(x, chars=(8203, 8204, 8205)):
    for c in chars:
        x = f"replace({x}, chr({c}), '')"
    return x


def sql_unescape(x):
    """The entities that occur in the test pages, ``&amp;`` last and also without semicolon."""
    entities = (
        ("&middot;", "chr(183)"), ("&copy;", "chr(169)"), ("&quot;", "chr(34)"),
        ("&lt;", "'<'"), ("&gt;", "'>'"), ("&nbsp;", "chr(160)"),
    )
    for name, char in entities:
        x = f"replace({x}, '{name}', {char})"
    return rx(x, "&amp;?", "&")


TAGS, BREAKS, LINK = "<[^>]+>", r"[\r\n\t]+", r"\[([^\]]+)\]\([^\)]+\)"
MENTION = "/?u/[A-Za-z0-9_-]+"
URL = rf"http{NONSPACE}+|www\.{NONSPACE}+"
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = (
    r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})|\([0-9]{2,4}\)|\b[0-9]{2,4})"
    r"[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}\b"
    r"|(?:\+[0-9]{1,3}[ .-]?|\b)[0-9]{5}[ .-][0-9]{5}\b"
)


def _pages(name, column, sql):
    @query(name, f"SELECT page_id, {sql} AS text FROM pages")
    def run(spark, sf):
        return v.table(spark, sf, "pages").select("page_id", column("html").alias("text"))


def _documents(name, column, sql):
    @query(name, f"WITH {v.DECORATED} SELECT doc_id, {sql} AS text FROM decorated")
    def run(spark, sf):
        return v.decorated(spark, sf).select("doc_id", column("text").alias("text"))


_BASIC = "html"
for _name, _char in (
    ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&apos;", "chr(39)"),
    ("&nbsp;", "chr(160)"), ("&amp;", "'&'"),
):
    _BASIC = f"replace({_BASIC}, '{_name}', {_char})"

_pages("t1_unescape_html", t.unescape_html, sql_unescape("html"))
_pages("t1_unescape_html_basic", t.unescape_html_basic, _BASIC)
_pages("t2_strip_tags", t.strip_tags, rx("html", TAGS))
_pages("t3_flatten_lines", t.flatten_lines, rx("html", BREAKS, " "))
_documents("t4_unlink_markdown", t.unlink_markdown, rx("text", LINK, r"\1"))
_documents("t5_strip_user_mentions", t.strip_user_mentions, rx("text", MENTION))
_documents("t6_strip_zero_width", t.strip_zero_width, sql_zero_width("text"))
_documents("t7_strip_urls", t.strip_urls, rx("text", URL))
_documents("t8_strip_emails", lambda c: t.strip_emails(c, "<EMAIL>"), rx("text", EMAIL, "<EMAIL>"))
_documents("t9_strip_phones", t.strip_phones, rx("text", PHONE))
_documents("t10_fix_unicode", t.fix_unicode, "nfc_normalize(text)")


@query("t10_repair_mojibake", f"WITH {v.DECORATED} SELECT doc_id, length(text)::INT AS n, TRUE AS restored FROM decorated")
def _(spark, sf):
    """Texts that were misread no, one, two or three times come back as the text itself is repaired."""
    layers = F.pmod("doc_id", F.lit(4))
    damaged = F.col("text")
    for n in (1, 2, 3):
        damaged = F.when(layers == n, t.misread("text", n)).otherwise(damaged)
    rows = v.decorated(spark, sf).select("doc_id", F.length("text").alias("n"), "text", damaged.alias("damaged"))
    return rows.select("doc_id", "n", (t.repair_mojibake("damaged") == t.repair_mojibake("text")).alias("restored"))


_documents("t11_squash_whitespace", t.squash_whitespace, sql_squash("text"))
_documents("t11_squash_all_whitespace", lambda c: t.squash_whitespace(c, 1), sql_squash("text", 1))
_documents("t13_dedup_key", t.dedup_key, rx("lower(text)", "[^a-z0-9]"))


def worker_sql(x):
    x = rx(rx(sql_unescape(x), TAGS), BREAKS, " ")
    x = sql_zero_width(rx(rx(x, LINK, r"\1"), MENTION))
    x = rx(rx(rx(f"nfc_normalize({x})", URL), EMAIL), PHONE)
    return sql_squash(x)


def harvester_sql(x):
    x = rx(rx(rx(sql_unescape(x), TAGS), BREAKS, " "), MENTION)
    x = rx(rx(f"nfc_normalize({x})", URL, "<URL>"), EMAIL, "<EMAIL>")
    return sql_squash(x)


def notebook_sql(x):
    x = rx(rx(rx(sql_unescape(x), LINK, r"\1"), URL), f"{WS}+", " ")
    return sql_strip(sql_zero_width(x, (8203,)))


_PROFILES = {"worker": worker_sql, "harvester": harvester_sql, "notebook": notebook_sql}


def _sanitize(profile):
    sql = _PROFILES[profile]

    @query(
        f"t12_sanitize_{profile}",
        f"WITH {v.DECORATED} SELECT concat('d', doc_id) AS id, {sql('text')} AS body_clean"
        f" FROM decorated UNION ALL SELECT concat('p', page_id), {sql('html')} FROM pages",
    )
    def run(spark, sf):
        docs = v.decorated(spark, sf).select(
            F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
            F.col("text").alias("body"),
        )
        pages = v.table(spark, sf, "pages").select(
            F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
            F.col("html").alias("body"),
        )
        return t.sanitize(docs.unionByName(pages), profile).select("id", "body_clean")


for _profile in _PROFILES:
    _sanitize(_profile)


@query(
    "f7_min_clean_length",
    f"WITH {v.LINES}, c AS (SELECT id, {worker_sql('text')} AS body_clean FROM comment_lines)"
    " SELECT id, body_clean FROM c WHERE length(body_clean) > 5",
)
def _(spark, sf):
    lines = t.sanitize(v.comment_lines(spark, sf), "worker", "text")
    return filters.min_clean_length(lines, 5).select("id", "body_clean")


SPLIT = r"regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+')"


def tokens_sql(pattern):
    return f"[x FOR x IN {SPLIT} IF regexp_full_match(x, '{pattern}')]"


@query(
    "t14_tokenize",
    f"SELECT doc_id, array_to_string({tokens_sql('[a-z0-9]+')}, ' ') AS tokens FROM documents",
)
def _(spark, sf):
    docs = v.table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(t.tokenize("text"), " ").alias("tokens"))


@query(
    "t15_tokenize_alpha",
    f"SELECT doc_id, array_to_string({tokens_sql('[a-z]{3,}')}, ' ') AS tokens FROM documents",
)
def _(spark, sf):
    docs = v.table(spark, sf, "documents")
    return docs.select("doc_id", F.array_join(t.tokenize_alpha("text"), " ").alias("tokens"))
