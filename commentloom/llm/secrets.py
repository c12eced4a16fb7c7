"""Secret scans through a trigram inverted index; DataFrame and SQL functions only.

Every rule's regular expression gives a Boolean trigram query (``trigrams.py``).  The index holds postings (trigram, document)
for the trigrams that some rule's query names; a posting that no query reads is never built.  Postings are
intersected per document as bits, which gives the candidates of each rule, and only candidates are
matched against the rule's expression.  A rule without mandatory trigrams scans all texts.

A match's place comes from the lengths of the matches and of the pieces between them, in code points, end
exclusive.  Matches are leftmost and do not overlap within a rule; ``group`` must have at least ``least`` characters, and
failing matches are dropped after matching, so they still use up the text they cover.

Null and empty texts have no spans.  Rows that repeat an id share the candidates of all of them and are verified row
by row; null ids count as one id.  An empty table gives an empty result.  Other columns pass through or are dropped
as the function says; internal columns start with an underscore, and inputs are wrapped in a struct first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.llm.common import stored
from commentloom.llm.trigrams import Query, named, trigram_query


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    least: int
    group: int = 0
    any_case: bool = False

    @property
    def regex(self) -> str:
        return f"(?i){self.pattern}" if self.any_case else self.pattern


# Fixed patterns of the base kinds, then kinds of this scanner's own, in the order of listing.
BASE = [
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        6,
        group=2,
        any_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]+", 24),
]
MORE = [
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 20),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
]
RULES = [*BASE, *MORE]

WORD = 62  # bits used of a 64-bit integer


def build_index(docs: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """Postings (_trigram, _doc): which of ``trigrams`` a document's lower-cased text has."""
    low = F.lower(F.coalesce(docs[text_col].cast("string"), F.lit("")))
    terms = F.array(*map(F.lit, trigrams)).cast("array<string>")
    rows = docs.select(docs[id_col].alias("_doc"), low.alias("_low"))
    return rows.select("_doc", F.explode(F.filter(terms, lambda t: F.contains(F.col("_low"), t))).alias("_trigram"))


def candidates(postings: DataFrame, queries: list[Query], trigrams: list[str]) -> DataFrame:
    """(_doc, _hits): for documents that satisfy some query, the bits of the queries they satisfy."""
    slot = {t: divmod(i, WORD) for i, t in enumerate(trigrams)}
    words = max(1, -(-len(trigrams) // WORD))

    def bit(word: int) -> Column:
        mine = {t: 1 << b for t, (w, b) in slot.items() if w == word}
        table = F.create_map(*[F.lit(x) for t, m in mine.items() for x in (t, F.lit(m).cast("bigint"))])
        return F.bit_or(F.coalesce(F.element_at(table, F.col("_trigram")), F.lit(0).cast("bigint")))

    merged = postings.groupBy("_doc").agg(*[bit(w).alias(f"_w{w}") for w in range(words)])

    def has(alternative: frozenset[str]) -> Column:
        masks = [sum(1 << slot[t][1] for t in alternative if slot[t][0] == w) for w in range(words)]
        tests = [F.col(f"_w{w}").bitwiseAND(F.lit(m)) == F.lit(m) for w, m in enumerate(masks) if m]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def holds(query: Query) -> Column:
        out = F.lit(True)
        for clause in query:
            any_ = F.lit(False)
            for alternative in sorted(clause, key=sorted):
                any_ = any_ | has(alternative)
            out = out & any_
        return out

    hits = F.lit(0)
    for i, query in enumerate(queries):
        hits = hits + F.when(holds(query), F.lit(1 << i)).otherwise(F.lit(0))
    return merged.select("_doc", hits.cast("bigint").alias("_hits")).where("_hits > 0")


def _matches(rule: Rule, order: int) -> Column:
    """The rule's spans in ``_text`` as an array of (start, order, end)."""
    text, regex = F.col("_text"), F.lit(rule.regex)
    found = F.regexp_extract_all(text, regex, F.lit(0))
    value = F.regexp_extract_all(text, regex, F.lit(rule.group)) if rule.group else found
    gaps = F.split(text, rule.regex, -1)
    sizes = F.arrays_zip(
        F.transform(found, F.length).alias("m"), F.transform(value, F.length).alias("v"), F.transform(F.slice(gaps, 1, F.size(found)), F.length).alias("g")
    )
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,k:int,e:int>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + x["g"]
        end = start + x["m"]
        span = F.struct(start.alias("s"), F.lit(order).alias("k"), end.alias("e"))
        kept = F.when(x["v"] >= rule.least, F.array_append(acc["out"], span)).otherwise(acc["out"])
        return F.struct(end.alias("at"), kept.alias("out"))

    return F.aggregate(sizes, empty, step, lambda acc: acc["out"])


def _gate(rule: Rule) -> Column:
    """A cheap test that a scanned text has any match at all; for a class repeated, a run of that length."""
    if rule.group == 0 and rule.pattern.endswith("]+") and rule.pattern.count("[") == 1 and rule.pattern[0] == "[":
        return F.rlike(F.col("_text"), F.lit(f"{rule.pattern[:-1]}{{{rule.least}}}"))
    return F.rlike(F.col("_text"), F.lit(rule.regex))


def scan(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, _text, _spans): the input's columns, its text, and all spans in order of start, then rule.

    ``_spans`` is an array of (s, k, e): start, the rule's number, end.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    indexed = [i for i, q in enumerate(queries) if q]
    trigrams = named(queries)
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("_row"),
        docs[id_col].alias("_key"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"),
    )
    if indexed:
        postings, _ = stored(build_index(docs, trigrams, id_col, text_col), "postings")
        hits = candidates(postings, [queries[i] for i in indexed], trigrams)
        rows = rows.join(hits, F.col("_key").eqNullSafe(F.col("_doc")), "left")
    spans = []
    for i, rule in enumerate(rules):
        verify = F.coalesce(F.col("_hits").bitwiseAND(F.lit(1 << indexed.index(i))) != 0, F.lit(False)) if i in indexed else _gate(rule)
        spans.append(F.when(verify, _matches(rule, i)).otherwise(F.array().cast("array<struct<s:int,k:int,e:int>>")))
    return rows.select("_row", "_text", F.array_sort(F.concat(*spans)).alias("_spans"))


def listed(spans: Column, rules: list[Rule]) -> Column:
    """The spans as text: kind:start:end, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ","
    )


def redact(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", n_col: str | None = None) -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets; a length column follows the new text.

    Of spans that overlap, the first names the replacement and all of them go.
    """
    found = scan(docs, rules, id_col, text_col)
    kinds = F.array(*[F.lit(f"[{r.kind}]") for r in rules])
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        fresh = F.concat(acc["out"], F.substring(F.col("_text"), acc["at"] + 1, x["s"] - acc["at"]), F.get(kinds, x["k"]))
        out = F.when(x["s"] >= acc["at"], fresh).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), out.alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col("_text"), acc["at"] + 1, F.length("_text")))
    clean = F.when(F.size("_spans") == 0, F.col(f"_row.`{text_col}`")).otherwise(F.aggregate("_spans", begin, step, rest))
    shown = found.withColumn("_clean", clean)
    columns = []
    for c in docs.columns:
        own = F.col(f"_row.`{c}`")
        if c == text_col:
            own = F.col("_clean")
        elif c == n_col:
            own = F.when(F.size("_spans") == 0, own).otherwise(F.length("_clean")).cast(docs.schema[c].dataType)
        columns.append(own.alias(c))
    return shown.select(*columns)
