"""The pipeline's stages, and the registered queries of the package."""

from __future__ import annotations

import hashlib
import random

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import check
import corpus_pipeline
from commentloom.llm import queries, secrets
from conftest import SMALL
from llm.fixtures import SCHEMA, answers, documents, empty, ordered
from llm.fixtures import rows as fixture_rows
from llm.test_texts import brute_classes, brute_fingerprint, brute_spans


def test_stages_keep_columns(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.count() > 0, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert last.count() == docs.count()


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_an_empty_table(spark, stage):
    assert corpus_pipeline.STAGES[stage][1](spark, empty(spark), SMALL).count() == 0


def redacted(text: str) -> str:
    """The text with each stretch of overlapping secrets replaced by the kind of the first."""
    out, at = "", 0
    for start, k, end in brute_spans(text):
        if start >= at:
            out += text[at:start] + f"[{secrets.RULES[k].kind}]"
        at = max(at, end)
    return out + text[at:]


def plain_run(rows):
    """What stages 2 to 5 make of rows (doc_id, text, lang, source): (doc_id, n_tokens, ids_sha256, decoded_sha256) of each copy."""
    prints = {r[0]: brute_fingerprint(r[1] or "") for r in rows}
    root, least = brute_classes(sorted(set(prints.values()))), {}
    for doc_id in sorted(prints):
        least.setdefault(root[prints[doc_id]], doc_id)
    kept = [(r[0], redacted(r[1] or ""), *r[2:]) for r in rows if r[0] in set(least.values())]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", kept)
    taken = [r[0] for r in con.execute(queries.ORACLES["op9_source_mix"]).fetchall()]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    texts, sha = {r[0]: r[1] for r in kept}, lambda x: hashlib.sha256(x.encode()).hexdigest()
    coded = {i: library.encode(texts[i], add_special_tokens=False).ids for i in set(taken)}
    return ordered(
        (i, len(coded[i]), sha(" ".join(map(str, coded[i]))), sha(library.decode(coded[i], skip_special_tokens=False))) for i in taken
    )


@pytest.mark.parametrize("table", [SMALL, "fixture"])
def test_run_equals_plain_python(spark, table, tmp_path):
    """The rows of ``run`` as a multiset: a plain redaction, mix and tokenizer on the documents that the first two stages keep."""
    if table == "fixture":
        texts = [r for r in fixture_rows() if r[0] is not None]
        spark.createDataFrame(list({r[0]: r for r in texts}.values()), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
        table = str(tmp_path)
    docs = spark.read.parquet(f"{table}/documents.parquet")
    source = {r.doc_id: r for r in docs.collect()}
    known = [r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, table).collect()]
    assert len(known) == len(set(known)) and all(any(map(str.isalpha, source[i].text)) for i in known)
    if table == SMALL:  # clean documents stay
        assert set(known) == {i for i, r in source.items() if r.text and any(map(str.isalpha, r.text))}
    out = corpus_pipeline.run(spark, table)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = plain_run([(i, source[i].text, source[i].lang, source[i].source) for i in known])
    assert answers(out) == want and len(want) > len(known) // 3


def test_copies_go(spark):
    """Exact copies, and copies whose fingerprints differ by two bits or fewer, leave the smallest id."""
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(400)) for _ in range(6)]
    texts += [t.upper().replace(" ", "  ") for t in texts] + [t + " end" for t in texts]
    prints = [brute_fingerprint(t) for t in texts]
    root = brute_classes(prints)
    docs = documents(spark, [(i, t, "en", "src0", 0) for i, t in enumerate(texts)])
    want = {min(i for i, p in enumerate(prints) if root[p] == r) for r in set(root.values())}
    assert {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SMALL).collect()} == want and len(want) < 13


@pytest.fixture(scope="module")
def con():
    return check.connect(SMALL)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, con, name):
    assert check.compare(spark, con, SMALL, name) == ""


def test_every_operator_is_registered():
    numbers = {int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in queries.QUERIES
