"""Operators on texts against plain versions of themselves."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from commentloom.llm import bpe, crf, langid, mixing, repeats, secrets, simhash, tokens
from commentloom.llm.automaton import Lexicon, compile_lexicon
from commentloom.llm.trigrams import trigram_query
from llm.fixtures import WORDS, answers, documents, empty, ordered, prose, rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark).cache()


# ---- language identification


def test_marginals_equal_plain_forward_backward():
    rng = np.random.default_rng(1)
    model = crf.Model.blank(["a", "b", "c"], {})
    model.moves = rng.normal(size=(3, 3))
    lengths = np.array([1, 5, 600, 256, 257, 2])
    potentials = rng.normal(size=(lengths.sum(), 3)) * 2
    found, at = crf.marginals(model, potentials, lengths), 0
    for n in lengths:
        e, moves = np.exp(potentials[at : at + n]), np.exp(model.moves)
        ahead, back = [np.ones(3) / 3 @ moves * e[0]], np.ones(3)
        for t in range(1, n):
            ahead.append(ahead[-1] / ahead[-1].sum() @ moves * e[t])
        for t in range(n - 1, -1, -1):
            p = ahead[t] * back
            assert np.allclose(p / p.sum(), found[at + t])
            back = moves @ (e[t] * back)
            back /= back.sum()
        at += n


def test_language_of_fixture(spark, docs):
    model = langid.fit(docs, "text", "lang", sequences=400)
    assert model.labels == ["de", "en"]
    found = langid.identify(docs, model, runs=True)
    assert found.columns == ["doc_id", "lang_pred", "score", "runs"]
    got = {r.doc_id: r for r in found.collect()}
    assert found.count() == len(rows())
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(60) if i != 3)
    for i in (400, 401, 402, 403):
        assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = langid.keep_known(docs, model, 0.3)
    assert kept.columns == docs.columns
    assert {400, 401, 402, 403}.isdisjoint({r.doc_id for r in kept.collect()})


def test_switched_text_is_labelled_word_by_word(spark, docs):
    import random

    model = langid.fit(docs, "text", "lang", sequences=400)
    rng = random.Random(9)
    text = prose(rng, "en", 40) + " " + prose(rng, "de", 30)
    runs = langid.identify(documents(spark, [(1, text, None, None, 0)]), model, runs=True).first().runs
    assert [(r["lang"], r["from"], r["to"]) for r in runs] == [("en", 0, 40), ("de", 40, 70)]


def test_language_without_labels(spark, docs):
    model = langid.fit(docs.withColumn("lang", F.lit(None).cast("string")), "text", "lang")
    assert {r.lang_pred for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(empty(spark), model).count() == 0


def test_held_out_accuracy(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(df.where(~langid.held_out(F.col("doc_id"))), "text", "lang", sequences=1500)
    found = langid.identify(df, model).join(df.select("doc_id", "lang").where(langid.held_out(F.col("doc_id"))), "doc_id")
    assert found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97


# ---- token counts and the BPE codec


def test_token_counts(spark, docs):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECES)
    want = [(r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "")), n > 64) for r in rows()]
    got = tokens.count_tokens(docs, PIECES, max_tokens=64)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert answers(got) == ordered(want)
    assert tokens.count_tokens(empty(spark), PIECES).count() == 0


@pytest.mark.parametrize("text", [" ", "a ", "  a", " a  b   ", "\n a", "▁x▁y ▁", "   ", "</s> <s> x", "a　b\tc", "a" * 200])
def test_pre_tokens_add_up(text):
    library, _ = tokens._encoder(PIECES)
    assert sum(tokens._length(library, w) for w in tokens.pre_tokens(text)) == len(library.encode(text))


def test_codec(spark, docs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for r in rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), ids, library.decode(ids, skip_special_tokens=False)))
    got = [(r[0], r[1], list(r[2]), r[3]) for r in bpe.encode(docs, WORD_BPE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    short = bpe.encode(docs, WORD_BPE, digests=True)
    assert answers(short) == ordered([(i, n, digest(" ".join(map(str, ids))), digest(d)) for i, n, ids, d in want])
    assert bpe.encode(empty(spark), WORD_BPE).count() == 0


def test_lexicon_counts_every_text(spark, monkeypatch):
    """The words counted are those of the whole table, also where they stand in its last rows only."""
    monkeypatch.setattr(bpe, "COUNTED", 50)
    texts = ["alpha beta gamma"] * 3500 + ["omega w%d" % (i % 70) for i in range(210)] + [None, "", "once", "é\u0301 x"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    keyed = bpe.keyed(table, "doc_id", "text")
    own = bpe.codec(WORD_BPE)
    want = Counter(w for t in texts for w in own.words(t or "") if w[0] > "\1")
    assert {r[0]: r[1] for r in bpe.word_counts(keyed, WORD_BPE).collect()} == want
    lexicon = Lexicon(bpe.build_lexicon(keyed, WORD_BPE, 4))
    assert len(lexicon) == 4
    assert (lexicon.find(["alpha", "beta", "gamma", "w", "once"]) >= 0).tolist() == [w in {x for x, _ in sorted(want.items(), key=lambda e: (-e[1], e[0]))[:4]} for w in ["alpha", "beta", "gamma", "w", "once"]]
    assert (Lexicon(bpe.build_lexicon(keyed, WORD_BPE, 100)).find(["omega", "w"]) >= 0).all()


def test_cutting_equals_the_library_for_every_low_character():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(WORD_BPE), bpe.codec(WORD_BPE)
    for point in [*range(0x300), *range(0x300, 0x3000, 17), 0x1F600]:
        text = f"a{chr(point)}B1 {chr(point)}{chr(point)} x"
        assert [i for w in own.words(text) for i in own.merge(w)] == library.encode(text, add_special_tokens=False).ids, hex(point)


def test_automaton_shares_suffixes_and_finds_words():
    entries = {w: [i, i + 1] for i, w in enumerate(["walking", "talking", "walked", "talked", "ü", "walk"])}
    lexicon = Lexicon(compile_lexicon(entries))
    words = [*entries, "wal", "walkings", "", "z"]
    found = lexicon.find(words).tolist()
    assert found[len(entries) :] == [-1] * 4
    assert [lexicon.ids_of(i) for i in found[: len(entries)]] == list(entries.values())
    assert len(lexicon.keys) < sum(map(len, entries)) - 8
    assert Lexicon(compile_lexicon({})).find(["a"]).tolist() == [-1]


# ---- secrets


def brute_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text, re.I | re.A if rule.any_case else re.A):
            if len(m.group(rule.group)) >= rule.least:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_secret_spans(spark, docs):
    found = secrets.scan(docs).select("_row.doc_id", "_text", "_spans").collect()
    assert len(found) == len(rows())
    for r in found:
        assert [tuple(s) for s in r._spans] == brute_spans(r._text)
    assert sum(len(r._spans) for r in found) >= 8
    assert secrets.scan(empty(spark)).count() == 0


def test_failing_matches_use_up_text():
    assert brute_spans("secret=token: abcdefgh") == []
    assert [s[:2] for s in brute_spans("token=abc token=abcdef")] == [(10, 0)]


def test_trigram_queries():
    by_kind = {r.kind: trigram_query(r.pattern) for r in secrets.RULES}
    assert by_kind["hex"] == []
    assert by_kind["access"] == [frozenset({frozenset({"aki", "kia"})})]
    (assign,) = by_kind["assign"]
    assert frozenset({"tok", "oke", "ken"}) in assign and len(assign) == 6
    assert trigram_query("a.*b") == [] and trigram_query("(abc)?") == []
    assert trigram_query("abcd+e") == [frozenset({frozenset({"abc", "bcd"})})]


def test_redaction(spark, docs):
    clean = secrets.redact(docs, n_col="n_chars")
    assert clean.columns == docs.columns
    got = {r.doc_id: r for r in clean.collect()}
    assert got[500].text.startswith('x [assign]" y [access] z [hex] token=abc')
    assert got[500].n_chars == len(got[500].text)
    assert got[400].text is None and got[401].text == "" and got[1].text == rows()[1][1]


# ---- near duplicates


def brute_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints: list[int]) -> dict[int, int]:
    root = {p: p for p in prints}
    changed = True
    while changed:
        changed = False
        for a in root:
            for b in root:
                if (a ^ b).bit_count() <= 2 and root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def test_simhash(spark, docs):
    got = simhash.near_duplicates(docs).collect()
    prints = [brute_fingerprint(r[1] or "") for r in rows()]
    root, least = brute_classes(prints), defaultdict(list)
    for r, p in zip(rows(), prints, strict=True):
        if r[0] is not None:
            least[root[p]].append(r[0])
    want = [(r[0], f"{p:016x}", min(least[root[p]], default=None)) for r, p in zip(rows(), prints, strict=True)]
    assert ordered(tuple(r) for r in got) == ordered(want)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_links_reach_all_pairs_within_two_bits(spark):
    rng = np.random.default_rng(2)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    prints = {b ^ sum(1 << int(k) for k in set(rng.integers(0, 64, n))) for b in base for n in (0, 1, 1, 2, 2, 3, 4) for _ in range(6)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {r.fp: r.root for r in simhash.classes(frame).collect()}
    want = brute_classes(sorted(prints))
    groups = lambda root: {frozenset(k for k in root if root[k] == v) for v in set(root.values())}
    assert groups({k % (1 << 64): v for k, v in found.items()}) == groups(want)


def test_keep_one(spark, docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    labels = simhash.near_duplicates(docs).collect()
    assert kept.count() == len({brute_classes([int(r.fingerprint, 16) for r in labels])[int(r.fingerprint, 16)] for r in labels})
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[7] == 1 and not any(ids[200 + i] for i in range(5))


# ---- repeated strings


def brute_repeats(texts: list[bytes], length: int) -> list[tuple[int, int, int, str]]:
    seen = Counter(t[p : p + length] for t in texts for p in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        rest = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(t), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def test_repeats(spark, docs):
    got = repeats.remove_repeats(docs)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    plain = brute_repeats([(r[1] or "").encode() for r in rows()], 400)
    assert answers(got) == ordered([(r[0], *p) for r, p in zip(rows(), plain, strict=True)])
    assert sum(p[1] for p in plain) > 5000
    assert repeats.remove_repeats(empty(spark)).count() == 0


@pytest.mark.parametrize("hot", [1000, 40, 2])
def test_repeats_that_start_and_end_inside_texts(spark, monkeypatch, hot):
    """Also where most blocks are hot, where some are, and where none is."""
    import random

    monkeypatch.setattr(repeats, "HOT", hot)

    rng = random.Random(4)
    base = [prose(rng, "en", 400) for _ in range(3)]
    texts = []
    for i in range(30):
        b = rng.choice(base)
        a = rng.randint(0, len(b) - 500)
        texts.append(prose(rng, "de", rng.randint(0, 5)) + b[a : a + rng.randint(380, 900)] + prose(rng, "de", rng.randint(0, 5)))
    texts += [base[0][:800] + base[0][:700], "é" * 450]
    frame = documents(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)])
    plain = brute_repeats([t.encode() for t in texts], 400)
    got = {r.doc_id: r for r in repeats.remove_repeats(frame, keep=True).collect()}
    assert [tuple(got[i])[1:5] for i in range(len(texts))] == plain
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got.values())


# ---- mixing


def test_mix_shares(spark):
    rows_ = [("a", "x", 100, 6), ("a", "y", 1000, 2), ("b", "x", 10, 1), ("b", "y", 10, 1), ("c", "x", 5000, 0)]
    leaves = spark.createDataFrame([(*r[:2], 1 if r[0] != "c" else 2, r[3], r[2]) for r in rows_], "_l0 string, _l1 string, w__l0 int, w__l1 int, tokens bigint")
    got = {(r._l0, r._l1): r.share for r in mixing.budgets(leaves, ["_l0", "_l1"], 500, 1).collect()}
    # c has no child that may get tokens and b falls short, so a gets 480 of 500; its x falls short of 360, y takes the rest.
    assert got[("b", "x")] == 10 and got[("b", "y")] == 10
    assert got[("a", "x")] == 100
    assert got[("a", "y")] == 380


def test_mix_takes_prefixes(spark, docs):
    mixed = mixing.mix(docs, mixing.default_levels(), max_epochs=3, budget=(1, 2))
    assert mixed.columns == ["_row", "_path", "_tokens", "_epoch"]
    got = mixed.select("_row.doc_id", "_path.domain", "_path.language", "_path.source", "_tokens", "_epoch").collect()
    count = lambda t: len(re.findall(r"[^ \t\n\f\r]+", t or ""))
    total = sum(count(r[1]) for r in rows())
    assert sum(r._tokens for r in got) <= total // 2
    by = Counter((r.domain, r.language, r.source) for r in got)
    assert all(r.language == "none" for r in got if r.source == "none" and r.doc_id == 301)
    assert len(by) > 5
    again = mixing.mix(docs.repartition(3), mixing.default_levels(), max_epochs=3, budget=(1, 2))
    pick = lambda d: sorted(map(str, d.select("_row.doc_id", "_tokens", "_epoch").collect()))
    assert pick(again) == pick(mixed)
    assert mixing.mix(empty(spark), mixing.default_levels()).count() == 0


def test_whole_budget_takes_everything(spark, docs):
    levels = [(n, node, F.lit(1)) for n, node, _ in mixing.default_levels()]
    mixed = mixing.mix(docs, levels, max_epochs=1, budget=(1, 1))
    with_tokens = sum(1 for r in rows() if re.search(r"[^ \t\n\f\r]", r[1] or ""))
    assert mixed.where("_tokens > 0").count() == with_tokens
    assert WORDS


def test_lexicon_words_are_resolved_without_a_step_each(monkeypatch):
    """Frequent words get their ids and tokens from arrays over the automaton; only words it lacks are merged."""
    own, merged = bpe.Codec(WORD_BPE), []
    known = ["the", "café", "a", "tokenizer", "unrecognisable", "7"]
    buffer = compile_lexicon({w: own.merge(w) for w in known})
    monkeypatch.setattr(Lexicon, "ids_of", lambda *_: pytest.fail("a word by itself"))
    monkeypatch.setattr(own, "merge", lambda w, merge=own.merge: merged.append(w) or merge(w))
    words = [known[k % 6] if k % 3 else f"other{k % 4}" for k in range(40)]
    for _ in range(2):
        places, sizes, ids, tokens = bpe._resolve(own, bpe.mapped(own, buffer), words)
        for w, k in zip(words, places, strict=True):
            want = [t.id for t in own.model.tokenize(w if w.isascii() else "".join(own.letters[c] for c in w))]
            assert (sizes[k], ids[k].as_py()) == (len(want), " ".join(map(str, want)))
            assert tokens[k].as_py() == " ".join(own.names[i] for i in want)
    assert sorted(merged) == ["other0", "other1", "other2", "other3"]
    empty = bpe._resolve(own, bpe.mapped(own, compile_lexicon({})), ["the"])
    assert empty[2][empty[0][0]].as_py() == " ".join(map(str, own.merge("the")))


def test_anchors_of_hot_blocks_meet_no_join(spark, monkeypatch):
    """Frequent names are filtered for; the one lookup by a join is for spans that are not frequent themselves."""
    monkeypatch.setattr(repeats, "HOT", 20)
    keys = [(1, 1)] * 60 + [(1, 2)] * 2 + [(1, 3)] + [(2, 1)] * 40 + [(k, 0) for k in range(10, 40)] + [(50, 5)] * 2 + [(51, 1), (51, 2)]
    data = [(c, w, i, 0, i << 8) for i, (c, w) in enumerate(keys)]
    suffixes = spark.createDataFrame(data, "core bigint, whole bigint, _id bigint, _twin bigint, span bigint")
    blocks = repeats.shared_blocks(suffixes)
    joins = [line for line in blocks._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert len(joins) == 1 and "LeftSemi" in joins[0]
    got = {(r["_id"], r["full"], r["ask"]) for r in blocks.collect() if r["full"] or r["ask"]}
    seen, blocks_of = Counter(keys), defaultdict(set)
    for c, w in seen:
        blocks_of[c].add(w)
    full = {(i, True) for i, k in enumerate(keys) if seen[k] > 1}
    asks = {keys.index((c, w)) for c, ws in blocks_of.items() if sum(seen[c, w] for w in ws) > 1 and min(seen[c, w] for w in ws) == 1 for w in ws}
    assert {(i, f) for i, f, _ in got if f} == full
    assert {i for i, _, a in got if a} == asks
