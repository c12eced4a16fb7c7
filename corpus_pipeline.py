"""A training-data pipeline over ``documents``: five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's result as Parquet to the shared folder and reads it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentloom.llm import bpe, langid, mixing, secrets, simhash
from commentloom.llm.common import stored, table

#: A text whose words agree on no language to this degree is rejected, as is one without letters.
MIN_LANGUAGE_SCORE = 0.3

#: How near copies are told, as the operator's contract has it.
SHINGLE_WORDS, MAX_BITS = 3, 2

#: The language model cannot be written in SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def _shown(docs: DataFrame) -> DataFrame:
    """The input's columns in one struct, beside which no name can clash."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the language model rejects: null, without letters, or in no language by its score."""
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))), "text", "lang")
    return langid.keep_known(docs, model, MIN_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near copies: the one with the smallest id, of equal ids the first by its text.

    Near copies are linked as ``op5`` links them: fingerprints of shingles of ``SHINGLE_WORDS`` words that differ in at
    most ``MAX_BITS`` bits.  Rows with a null id stay only if their class has no other.
    """
    return simhash.keep_one(docs, words=SHINGLE_WORDS, bits=MAX_BITS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by its kind in brackets; ``n_chars`` follows the new text."""
    return secrets.redact(docs, n_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix has epochs for it, once per row."""
    mixed = mixing.mix(docs, mixing.default_levels())
    return mixed.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"), digests=True)


STAGES = [
    ("language ID", identify_language),
    ("near-dedup", drop_near_copies),
    ("secret scan", redact_secrets),
    ("source mix", mix_sources),
    ("BPE encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
