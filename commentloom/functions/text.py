"""Text operators as column expressions over whole tables.

Most texts need most steps not at all, and a regular expression costs far more than a plain
substring search.  Each step therefore asks for its trigger characters first.  It binds its
input to a lambda variable, so a chain of steps stays linear in size and computes each step once.

Only entity decoding and Unicode normalisation leave the JVM.  Both send Python the pieces of a text that can
change, never the text: its character references, or its characters before and among combining ones.
"""

from __future__ import annotations

import html
import unicodedata
from functools import cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace as Unicode defines it, plus the four ASCII separators.
_RARE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_SPACE = r"[\s\x1c-\x1f]"  # the same characters, under (?U)
# Single characters below U+0100 make one bit set in the regular expression; ranges would not.
_RARE_LATIN = r"[\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0]"
_RARE_SPAN = r"[\u1680-\u3000]"  # one cheap range around the rest
_RARE_OTHER = r"[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Patterns and the order in which the profiles apply them.
TAG = r"<[^>]+>"
LINE_BREAKS = r"[\r\n\t]+"
MARKDOWN_LINK = r"\[([^\]]+)\]\([^\)]+\)"
USER_MENTION = r"/?u/[A-Za-z0-9_-]+"
ZERO_WIDTH = "\u200b\u200c\u200d"
URL = r"http\S+|www\.\S+"

# Our own patterns.  An address starts at the beginning of its run of address characters, so
# the engine never rescans a long run.  A phone number has 9 to 12 digits after an optional
# country code, in three groups, or two of five, that a space, dot or hyphen may separate.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = (
    r"(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})|\([0-9]{2,4}\)|\b[0-9]{2,4})"
    r"[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}\b"
    r"|(?:\+[0-9]{1,3}[ .-]?|\b)[0-9]{5}[ .-][0-9]{5}\b"
)


# What windows-1252 shows for the bytes 80 to 9f, where it differs from Latin-1.
_1252 = {
    0x80: "€", 0x82: "‚", 0x83: "ƒ", 0x84: "„", 0x85: "…", 0x86: "†", 0x87: "‡", 0x88: "ˆ", 0x89: "‰",
    0x8A: "Š", 0x8B: "‹", 0x8C: "Œ", 0x8E: "Ž", 0x91: "‘", 0x92: "’", 0x93: "“", 0x94: "”", 0x95: "•",
    0x96: "–", 0x97: "—", 0x98: "˜", 0x99: "™", 0x9A: "š", 0x9B: "›", 0x9C: "œ", 0x9E: "ž", 0x9F: "Ÿ",
}
_SHOWN, _BYTES = "".join(_1252.values()), "".join(map(chr, _1252))
_HIGH_RUN = rf"[\x80-\xff{_SHOWN}]{{2,}}"
_CONFUSED = rf"[\xc2-\xf4][\x80-\xbf{_SHOWN}]"  # a lead byte's character before a following byte's
_CLOSING = "…“”‘’‚„‹›–—™•"
LAYERS = 8


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _decode_entities(refs: pd.Series) -> pd.Series:
    return refs.map(lambda xs: [html.unescape(x) for x in xs], na_action="ignore")


def _compose(runs: pd.Series) -> pd.Series:
    return runs.map(lambda xs: [unicodedata.normalize("NFC", x) for x in xs], na_action="ignore")


# As a plain expression a function may stand under a filter, which Spark would push below it and so repeat the call;
# it leaves filters above what it may not repeat.  ``sanitize`` guards its result itself and uses the second pair, through
# which filters on other columns pass.
_PIECES = T.ArrayType(T.StringType())
_html_unescape = F.pandas_udf(_decode_entities, _PIECES).asNondeterministic()
_nfc = F.pandas_udf(_compose, _PIECES).asNondeterministic()
_html_unescape_once = F.pandas_udf(_decode_entities, _PIECES)
_nfc_once = F.pandas_udf(_compose, _PIECES)

# Fixed value: what ``html.unescape`` takes for a character reference.
_CHARREF = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


def _in_python(c: Column, needed: Column, pattern: str, call) -> Column:
    """``c`` with ``call`` of all matches of ``pattern`` put in their place, in texts that meet ``needed``."""
    done = call(F.when(needed, F.regexp_extract_all(c, F.lit(pattern), F.lit(0))))
    whole = F.zip_with(F.split(c, pattern, -1), done, lambda gap, piece: F.concat(gap, F.coalesce(piece, F.lit(""))))
    return F.when(F.size(done) > 0, F.array_join(whole, "")).otherwise(c)


@cache
def _composing() -> str:
    """An expression of the runs that NFC may change, each with the character before it.

    NFC never acts across the beginning of a character that is a starter, equal to its own NFC and no second part of a
    composition.  All others are listed, in ranges that may hold more.
    """
    odd = set(range(0x1161, 0x1176)) | set(range(0x11A8, 0x11C3))  # Hangul vowels and finals
    for point in [*range(0x300, 0xD800), *range(0xE000, 0x110000)]:
        char = chr(point)
        parts = unicodedata.decomposition(char)
        if parts and parts[0] != "<":
            odd.update(int(p, 16) for p in parts.split()[1:])
        if unicodedata.combining(char) or unicodedata.normalize("NFC", char) != char:
            odd.add(point)
    ranges: list[list[int]] = []
    for point in sorted(p for p in odd if p >= 0x300):
        if ranges and point - ranges[-1][1] <= 16:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    listed = "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges)
    return rf"(?s).?(?:(?=[\x{{300}}-\x{{10ffff}}])[{listed}])+"


def unescape_html(c, call=_html_unescape) -> Column:
    """Decode every HTML entity; only a text's character references leave the JVM."""
    c = _col(c)
    return _in_python(c, c.contains("&"), _CHARREF, call)


def unescape_html_basic(c) -> Column:
    """JVM-only decoding of the five XML entities and ``&nbsp;``; ``&amp;`` goes last."""
    c = _col(c)
    # Fixed values.
    for entity, char in (
        ("&lt;", "<"),
        ("&gt;", ">"),
        ("&quot;", '"'),
        ("&apos;", "'"),
        ("&nbsp;", "\u00a0"),
        ("&amp;", "&"),
    ):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def _has(c: Column, *needles: str) -> Column:
    return reduce(lambda x, y: x | y, [c.contains(n) for n in needles])


def _not_ascii(c: Column) -> Column:
    return F.octet_length(c) != F.length(c)


def bind(c, change) -> Column:
    """``change`` of the column, which is evaluated once however often ``change`` names it."""
    return F.transform(F.array(_col(c)), change)[0]


def _replace_if(c, test, pattern: str, repl: str) -> Column:
    return bind(c, lambda x: F.when(test(x), F.regexp_replace(x, pattern, repl)).otherwise(x))


def strip_tags(c) -> Column:
    return _replace_if(c, lambda x: _has(x, "<"), TAG, "")


def flatten_lines(c) -> Column:
    return _replace_if(c, lambda x: _has(x, "\n", "\r", "\t"), LINE_BREAKS, " ")


def unlink_markdown(c) -> Column:
    return _replace_if(c, lambda x: _has(x, "]("), MARKDOWN_LINK, "$1")


def strip_user_mentions(c) -> Column:
    return _replace_if(c, lambda x: _has(x, "u/"), USER_MENTION, "")


def strip_zero_width(c, chars: str = ZERO_WIDTH) -> Column:
    for char in chars:
        c = F.replace(_col(c), F.lit(char), F.lit(""))
    return c


def strip_urls(c, repl: str = "") -> Column:
    return _replace_if(c, lambda x: _has(x, "http", "www."), "(?U)" + URL, repl)


def strip_emails(c, repl: str = "") -> Column:
    return _replace_if(c, lambda x: _has(x, "@"), EMAIL, repl)


def strip_phones(c, repl: str = "") -> Column:
    return _replace_if(c, lambda x: x.rlike("[0-9]{4}"), PHONE, repl)


def _decoded(run: Column, before: Column, after: Column, trusting: bool) -> Column:
    """A run of high characters as the UTF-8 that its bytes make, or as it is."""
    raw = F.encode(F.translate(run, _SHOWN, _BYTES), "ISO-8859-1")

    def judge(text: Column) -> Column:
        # A single character of two bytes is accepted only where it stands for one of Latin-1 or shows a control
        # character; a capital with closing punctuation behind it at a word's end may be meant.
        pair = run.rlike("^[\xc2\xc3]")
        if not trusting:
            pair = pair & ~(run.rlike(f"[{_CLOSING}]$") & before.rlike("[A-Z]$") & ~after.rlike(r"^\p{L}"))
        sure = (F.length(text) > 1) | (F.length(run) > 2) | pair | run.rlike(r"[\x80-\x9f]")
        return F.when(text.isNotNull() & sure, text).otherwise(run)

    return bind(F.try_validate_utf8(raw.cast("string")), judge)


def _one_layer(c: Column) -> Column:
    """One reading undone; what may be meant as it is counts as damage only beside a run that surely is."""
    found = F.struct(F.regexp_extract_all(c, F.lit(_HIGH_RUN), F.lit(0)).alias("runs"), F.split(c, _HIGH_RUN, -1).alias("gaps"))

    def join(x: Column) -> Column:
        def parts(trusting: bool) -> Column:
            after = lambda i: F.coalesce(F.get(x["gaps"], i + 1), F.lit(""))
            return F.transform(x["runs"], lambda run, i: _decoded(run, F.get(x["gaps"], i), after(i), trusting))

        def glue(runs: Column) -> Column:
            both = F.transform(x["gaps"], lambda gap, i: F.concat(gap, F.coalesce(F.get(runs, i), F.lit(""))))
            return F.array_join(both, "")

        chosen = bind(parts(False), lambda fixed: F.when(fixed == x["runs"], fixed).otherwise(parts(True)))
        return bind(chosen, glue)

    return bind(found, join)


def misread(c, layers: int = 1) -> Column:
    """The text as windows-1252 shows its UTF-8 bytes, ``layers`` times over: the damage that ``repair_mojibake`` undoes."""
    shown = lambda x: F.translate(F.decode(F.encode(x, "UTF-8"), "ISO-8859-1"), _BYTES, _SHOWN)
    return reduce(lambda x, _: shown(x), range(layers), _col(c))


def repair_mojibake(c) -> Column:
    """Undo UTF-8 that was read as windows-1252 or Latin-1, up to ``LAYERS`` times over.

    Each run of characters that such a reading can show is turned back into bytes.  It is replaced
    where these are UTF-8 and the text's score, the number of its characters beyond ASCII, falls, which it
    does by every character that is put together again.  Other runs, and texts without a lead byte's
    character before a following byte's, stay as they are.
    """
    again = lambda x, _: F.when(x.rlike(_CONFUSED), _one_layer(x)).otherwise(x)
    layers = F.sequence(F.lit(1), F.lit(LAYERS))
    return bind(c, lambda x: F.when(_not_ascii(x) & x.rlike(_CONFUSED), F.aggregate(layers, x, again)).otherwise(x))


def fix_unicode(c, needed: Column | None = None, call=_nfc) -> Column:
    """NFC; ``repair_mojibake`` comes before it in the profiles.  Only texts that meet ``needed``, by default
    non-ASCII ones, are searched, and only their runs that may change go to Python.
    """
    c = _col(c)
    if needed is None:
        needed = _not_ascii(c)
    return _in_python(c, needed, _composing(), call)


def strip_space(c) -> Column:
    return F.trim(_col(c), F.lit(" " + _RARE_SPACE))


def squash_runs(c, min_run: int = 2) -> Column:
    """Runs of at least ``min_run`` whitespace characters become one space."""

    def change(x: Column) -> Column:
        plain = F.when(_has(x, "  "), F.regexp_replace(x, " {2,}", " ")).otherwise(x)
        full = F.regexp_replace(x, rf"(?U){_SPACE}{{{min_run},}}", " ")
        other = _not_ascii(x) & x.rlike(_RARE_SPAN) & x.rlike(_RARE_OTHER)
        rare = x.rlike(_RARE_LATIN) | other
        return F.when(rare, full).otherwise(plain)

    return bind(c, change)


def squash_whitespace(c, min_run: int = 2) -> Column:
    return strip_space(squash_runs(c, min_run))


# The steps of each profile in order.
PROFILES = {
    "worker": [
        unescape_html,
        strip_tags,
        flatten_lines,
        unlink_markdown,
        strip_user_mentions,
        strip_zero_width,
        fix_unicode,
        strip_urls,
        strip_emails,
        strip_phones,
        squash_whitespace,
    ],
    "harvester": [
        unescape_html,
        strip_tags,
        flatten_lines,
        strip_user_mentions,
        fix_unicode,
        lambda c: strip_urls(c, "<URL>"),
        lambda c: strip_emails(c, "<EMAIL>"),
        squash_whitespace,
    ],
    "notebook": [
        unescape_html,
        unlink_markdown,
        strip_urls,
        lambda c: squash_runs(c, 1),
        lambda c: strip_zero_width(c, "\u200b"),
        strip_space,
    ],
}


def sanitize(
    df: DataFrame, profile: str = "worker", col: str = "body", out: str = "body_clean", repair: bool = False
) -> DataFrame:
    """Clean ``col`` into ``out``; a missing text becomes empty.  ``repair`` also undoes mojibake before NFC.

    What goes to Python, and the result, come out of generators of one element: Spark neither merges the
    steps before one with those behind it nor pushes a filter on its output below it, so nothing is
    cleaned twice, while filters on other columns pass through and reach the scan.
    """
    raw = F.coalesce(_col(col), F.lit(""))
    columns = [c for c in df.columns if c != "_clean"]

    def settled(frame: DataFrame, clean: Column) -> DataFrame:
        return frame.select(*[F.col(f"`{c}`") for c in columns], F.explode(F.array(clean)).alias("_clean"))

    clean = raw
    for step in PROFILES[profile]:
        if step is fix_unicode:  # an entity may stand for a non-ASCII character
            df = settled(df, repair_mojibake(clean) if repair else clean)
            clean = step(F.col("_clean"), _not_ascii(raw) | _has(raw, "&"), _nfc_once)
        elif step is unescape_html:
            clean = step(clean, _html_unescape_once)
        else:
            clean = step(clean)
        if step in (unescape_html, fix_unicode):  # a column of its own, so Python sees a text once
            df, clean = df.withColumn("_clean", clean), F.col("_clean")
    df = settled(df, clean)
    return df.select(*[F.col("_clean").alias(out) if c == out else F.col(f"`{c}`") for c in columns], *[F.col("_clean").alias(out)] * (out not in columns))


def dedup_key(c) -> Column:
    """Lower-case letters a-z and digits only."""
    return F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "")


_WORD = r"[\p{L}\p{N}_]"


def _tokens(c, ascii_word: str) -> Column:
    """Whole words that match ``ascii_word``.

    Each match eats a whole word, so a token never starts inside one; words of any other kind
    match the second branch and come out empty.
    """
    words = F.regexp_extract_all(
        F.lower(_col(c)), F.lit(rf"({ascii_word})(?!{_WORD})|{_WORD}++"), F.lit(1)
    )
    return F.array_remove(words, "")


def tokenize(c) -> Column:
    """ASCII word tokens that no other letter, digit or underscore touches."""
    return _tokens(c, "[a-z0-9]++")


def tokenize_alpha(c, min_len: int = 3) -> Column:
    return _tokens(c, f"[a-z]{{{min_len},}}+")
