"""Token alignment against comparing whole texts' byte offsets, and counting every link in plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest

from commentloom.llm import align, queries
from conftest import SMALL
from llm.fixtures import answers, documents, empty, ordered, rows

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
MIX = [*"ab cd  eé😀中\n\t\r1２ ﬁ 　\u0085​'stlN.,!-<>|\\/́ñß한", "  ", "   ", " the", " hello", "<|endoftext|>", "</s>", "<0x41>", "<unk>", "🏳️‍🌈", "'ll", "\x1c", "\0", "﻿"]


@pytest.fixture(scope="module")
def pair():
    return align.pair_for(A, B)


def whole(pair, text):
    """The groups of a text by the byte offsets at which its tokens end, or None without tokens."""
    raw = b" " + (text or "").encode()
    ids_a = pair.a.encode(" " + (text or ""), add_special_tokens=False).ids
    ids_b = pair.b.encode(text or "")
    parts_a, parts_b = [pair.bytes_a[i] for i in ids_a], [pair.bytes_b[i] for i in ids_b]
    if not text or b"".join(parts_a) != raw or b"".join(parts_b) != raw:
        return None

    def ends(parts):
        out, n = {}, 0
        for k, p in enumerate(parts):
            n += len(p)
            out[n] = k + 1
        return out

    ends_a, ends_b, groups, i, j = ends(parts_a), ends(parts_b), [], 0, 0
    for cut in sorted(ends_a.keys() & ends_b.keys()):
        groups.append((ids_a[i : ends_a[cut]], ids_b[j : ends_b[cut]]))
        i, j = ends_a[cut], ends_b[cut]
    return groups


def shown(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups or [])


def expected(pair, data):
    groups = [whole(pair, text) or [] for _, text, *_ in data]
    links = [[(i, j) for x, y in g for i in x for j in y] for g in groups]
    held = Counter(p for own in links for p in set(own))
    most = {}
    for (i, _), n in held.items():
        most[i] = max(most.get(i, 0), n)
    out = []
    for (doc_id, *_), g, own in zip(data, groups, links, strict=True):
        text = shown(g)
        sha = hashlib.sha256(text.encode()).hexdigest() if g else ""
        counts = (sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(own))
        out.append((doc_id, *counts, sum(held[p] == most[p[0]] for p in own), sum(held[p] for p in own), sha))
    return ordered(out)


def units_shown(pair, text):
    units = align.units_of(text)
    distinct = list(dict.fromkeys(units))
    block, places = pair.align(distinct)
    at = [places[distinct.index(u)] for u in units]
    return ";".join(block.shown[int(i)].as_py() for i in at) if all(block.good[i] for i in at) else None


def test_units_align_as_whole_texts_do(pair):
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice(MIX) for _ in range(rng.randrange(1, 40)))
        groups = whole(pair, text)
        assert units_shown(pair, text) == (None if groups is None else shown(groups)), repr(text)


def test_split_characters_are_refined(pair):
    """A cuts the emoji's bytes, B has it as one piece or as single bytes."""
    for text in ("😀", "a 😀😀 b", "ṩ 🏳️‍🌈 x", "中文字符", "é\n\ń"):
        groups = whole(pair, text)
        assert units_shown(pair, text) == shown(groups)
        assert b"".join(pair.bytes_a[i] for x, _ in groups for i in x) == b" " + text.encode()


def test_texts_whose_bytes_differ_have_no_tokens(pair, spark):
    assert whole(pair, "a▁b") is None
    data = [(1, "a▁b and more", "en", "s", 0), (2, "and more", "en", "s", 0), (3, None, None, None, None), (4, "", None, None, None)]
    got = answers(align.align(documents(spark, data), A, B))
    assert got == expected(pair, data) and got[0] == (1, 0, 0, 0, 0, 0, 0, "")


def test_tables(spark, pair):
    data = rows()
    rng = random.Random(8)
    data += [(900 + i, "".join(rng.choice(MIX) for _ in range(60)), None, None, None) for i in range(40)]
    data += [(990, "x" * 20_000 + " " * 5000 + "中" * 3000, "en", "s", 0)]
    got = align.align(documents(spark, data), A, B, groups=True)
    assert ordered(tuple(r[:-1]) for r in got.collect()) == expected(pair, data)
    texts = {r.doc_id: r.groups for r in got.collect() if r.doc_id is not None and r.doc_id >= 900}
    assert texts == {d[0]: shown(whole(pair, d[1])) for d in data if d[0] is not None and d[0] >= 900}
    assert align.align(empty(spark), A, B).count() == 0


def test_a_pair_that_all_texts_share_costs_a_row_per_chunk(spark):
    data = [(i, "the same words in every text", "en", "s", 0) for i in range(3000)]
    out = align.align(documents(spark, data), A, B)
    assert {(r.n_links, r.count_sum) for r in out.collect()} == {(r.n_links, 3000 * r.n_links) for r in out.limit(1).collect()}


def test_a_full_cache_keeps_what_was_met_again(monkeypatch):
    own = align.Pair(A, B)
    monkeypatch.setattr(align, "CACHE_SIZE", 12)
    for k in range(30):
        text = f"word{k} of 😀{k} the text " + "long" * 20
        assert units_shown(own, text) == shown(whole(own, text))
        assert len(own.places) == len(own.known.good) == len(own.used) <= 12
    assert {"of", "the", "text"} <= own.places.keys()


def test_units_seen_together_align_as_alone(pair):
    rng = random.Random(9)
    for _ in range(60):
        units = list(dict.fromkeys(u for _ in range(40) for u in align.units_of("".join(rng.choice([*MIX, "▁"]) for _ in range(25)))))
        one, other = pair.aligned(units), pair.aligned(units, alone=True)
        assert one.shown.to_pylist() == other.shown.to_pylist() and one.good.tolist() == other.good.tolist()
        assert one.counts.tolist() == other.counts.tolist() and one.codes.tolist() == other.codes.tolist()


def test_the_libraries_see_a_slice_of_new_units_at_a_time(monkeypatch):
    own, seen = align.Pair(A, B), []
    monkeypatch.setattr(align, "SLICE", 5)
    monkeypatch.setattr(align.Pair, "aligned", lambda self, units, *a, f=align.Pair.aligned: seen.append(len(units)) or f(self, units, *a))
    for k in range(6):  # units met before, new and unknown ones in turn
        text = f"the text {k} of word{k} ▁{k} and " + " ".join(f"unit{j}" for j in range(4 * k)) + " " + "long" * 20
        groups = [whole(own, x) for x in align.units_of(text)]
        block, places = own.align(list(dict.fromkeys(align.units_of(text))))
        shown_ = dict(zip(dict.fromkeys(align.units_of(text)), (block.shown[int(i)].as_py() for i in places), strict=True))
        assert [shown_[u] for u in align.units_of(text)] == [shown(g) for g in groups]
    assert max(seen) <= 5


def test_no_row_holds_more_than_one_text(spark, pair, monkeypatch):
    """Neither what is written between the passes nor what the last pass reads holds a chunk's texts in one row."""
    kept = []
    monkeypatch.setattr(align, "stored", lambda df, label, f=align.stored, **o: kept.append(f(df, label, **o)) or kept[-1])
    data = [(i, f"the same words in every text and number {i} 😀", "en", "s", 0) for i in range(500)] + [(None, None, None, None, None)]
    before = [spark.conf.get(k) for k in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # chunks go over batches, pairs and texts of a chunk over several
    try:
        out = align.align(documents(spark, data), A, B)
        got = answers(out)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before[0])
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before[1]
    assert got == expected(pair, data)
    chunks = kept[0][0]
    n_chunks = chunks.select("chunk").distinct().count()
    assert n_chunks <= chunks.rdd.getNumPartitions() * 2 and chunks.count() == n_chunks + len(data)
    assert "collect_list" not in out._jdf.queryExecution().toString()


def test_query(spark, pair):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    out = queries.QUERIES["op11_token_alignment"](spark, SMALL)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert out.columns == names and answers(out) == expected(pair, [tuple(r) for r in docs])
