"""Many terms in one pass, against looking for each by itself."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from commentloom.functions import terms
from commentloom.operators import filters, lexicon
from conftest import SMALL, plan_of

LETTERS = "ab.(é😀\\ -]^$\n"
some = st.lists(st.text(LETTERS, max_size=5), max_size=12)


@given(some, st.text(LETTERS, max_size=30))
def test_patterns(words, text):
    """The same expression in Python's syntax: the longest term at every place, and whether there is any."""
    words = [w for w in words if w]
    own = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", terms.pattern(words))
    longest = {m[1] for m in re.finditer(f"(?=({own}))", text, re.S)}
    want = {max((w for w in words if text.startswith(w, i)), key=len, default=None) for i in range(len(text))} - {None}
    assert longest - {""} == want
    any_ = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{int(m[1], 16):08x}", terms.pattern(words, shortest=True))
    assert bool(re.search(any_, text)) == any(w in text for w in words)


def tables(spark, n, seed=1):
    rng = random.Random(seed)
    words = {"".join(rng.choices("abcé😀.( ", k=rng.randrange(1, 7))) for _ in range(n)}
    pairs = [(rng.choice("xyz"), w) for w in sorted(words) for _ in range(rng.randrange(1, 3))]
    texts = ["".join(rng.choices("abcé😀.( AB\n", k=rng.randrange(60))) for _ in range(80)] + [None, ""]
    lex = spark.createDataFrame(pairs, "category string, term string")
    return list(enumerate(texts)), set(pairs), spark.createDataFrame(list(enumerate(texts)), "id long, body string"), lex


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_hits_and_matches(spark, n):
    texts, pairs, df, lex = tables(spark, n)
    want = sorted((i, c, t) for i, x in texts if x is not None for c, t in pairs if t in x.lower())
    hits = lexicon.lexicon_hits(df, lex)
    assert sorted(tuple(r) for r in hits.collect()) == want
    words = [t for _, t in pairs]
    matched = [r["id"] for r in filters.match_any_keyword(df, words).collect()]
    assert sorted(matched) == sorted({i for i, _, _ in want})


def test_an_empty_term_is_in_every_text(spark):
    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None)], "id long, body string")
    lex = spark.createDataFrame([("c", ""), ("d", "a"), ("d", "ab"), (None, "b"), ("e", None)], "category string, term string")
    got = sorted(map(str, map(tuple, lexicon.lexicon_hits(df, lex).collect())))
    assert got == sorted(map(str, [(1, "c", ""), (1, "d", "a"), (1, "d", "ab"), (1, None, "b"), (2, "c", "")]))
    assert df.filter(terms.holds_any(F.col("body"), ["", "q"])).count() == 2


def test_the_plan_has_the_terms_as_constants(spark):
    """No join, no exchange, nothing that is parsed or looked up by a row's number of terms."""
    _, _, df, lex = tables(spark, 500)
    plan = plan_of(lexicon.lexicon_hits(df, lex))
    assert not any(word in plan for word in ("Join", "Exchange", "from_json", "Subquery"))
    terms_ = [f"term {i} of many" for i in range(6000)]
    assert filters.match_any_keyword(df, terms_).count() == 0


@pytest.mark.parametrize("longest", [3, 14])
def test_lexicon_table(spark, longest):
    rng = random.Random(longest)
    make = lambda letters, n: "".join(rng.choices(letters, k=rng.randrange(n)))
    words = [make("abé😀. ", longest) for _ in range(30)] + ["x" * 12, "xx y", "aaaabbbbccccdd", None]
    texts = [make("abé😀. AB\n", 50) for _ in range(150)] + [None, "", "x" * 30, "Xx  y", "xXx Y", "zaaaabbbbccccddz", "aaaabbbbcccc"]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "id long, body string")
    for terms_ in (words, [w for w in words if w and w.strip()], ["xx y"], ["qq"], []):
        lex = spark.createDataFrame([("c", w) for w in terms_], "category string, term string")
        got = [r[0] for r in lexicon.ids_with_terms(df, lex).collect()]
        want = {i // 2 for i, t in enumerate(texts) if t is not None and any(w.lower() in t.lower() for w in terms_ if w is not None)}
        assert sorted(got) == sorted(want)


def test_lexicon_table_stays_off_the_driver(spark, monkeypatch):
    """A vocabulary of the texts themselves: no more than a few numbers come back."""
    taken = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: taken.append(collect(df)) or taken[-1])
    entry.queries()["f6_match_many_keywords"](spark, SMALL)
    assert sum(map(len, taken)) <= lexicon.SEED + 1
