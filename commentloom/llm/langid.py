"""Language identification of code-switched text by a linear-chain conditional random field (``crf.py``).

The model is trained on the driver from a bounded sample: at most ``per_language`` labelled texts for each
language, in the order of a hash, and from each at most ``spans`` runs of ``span_words`` words spread over the whole text.
Runs of different languages are strung together into sequences, so transitions are learned from text that
switches.  Labelling runs forward-backward over all words of the whole text; a text's language is the label with the
largest sum of word probabilities (ties: the first in alphabetical order) and its score that sum's share.

Null texts and texts without a letter get ``und`` with score 0, as does every text when nothing is labelled.  Null ids
are kept and never held out; repeated rows are labelled row by row; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from commentloom.llm.common import keyed, numbered, worker_state
from commentloom.llm.crf import Model, has_letter, marginals, train, words_of

UNKNOWN = "und"
CHUNK_WORDS = 100_000  # words labelled at a time, besides one text's own
CACHE_WORDS = 100_000


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the id's fold is the one that training must not see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def fit(
    labelled: DataFrame, text_col: str, lang_col: str, per_language: int = 300, spans: int = 12, span_words: int = 24, length: int = 72, sequences: int = 4000, seed: int = 5, max_languages: int = 2000
) -> Model:
    """Trains on a bounded sample of ``labelled``; languages come in alphabetical order."""
    rows = labelled.select(labelled[lang_col].cast("string").alias("_lang"), labelled[text_col].cast("string").alias("_text"))
    rows = rows.where("_lang is not null and _text is not null").withColumn("_at", F.xxhash64("_text"))
    # Distinct texts are chosen by their hashes alone, so copies count once and no text is shuffled to be ranked.
    first = Window.partitionBy("_lang").orderBy("_at")
    chosen = rows.select("_lang", "_at").distinct().withColumn("_n", F.row_number().over(first))
    upto = chosen.where(F.col("_n") <= per_language).groupBy("_lang").agg(F.max("_at").alias("_upto"))
    cuts = upto.limit(max_languages + 1).collect()
    if len(cuts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    cuts = labelled.sparkSession.createDataFrame(cuts, upto.schema)  # small enough by the check above
    near = rows.join(F.broadcast(cuts), "_lang").where(F.col("_at") <= F.col("_upto"))
    sample = near.groupBy("_lang", "_at").agg(F.min("_text").alias("_text")).select("_lang", "_text")

    def cut(batches):
        for batch in batches:
            langs, runs = [], []
            for lang, text in zip(batch.column("_lang").to_pylist(), batch.column("_text").to_pylist(), strict=True):
                words = [w[:40] for w in words_of(text)]
                starts = sorted({int(s) for s in np.linspace(0, max(0, len(words) - span_words), spans)})
                for s in starts if words else ():
                    langs.append(lang)
                    runs.append(words[s : s + span_words])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(runs, pa.list_(pa.string()))], names=["lang", "run"])

    runs = [(r.lang, list(r.run)) for r in sample.mapInArrow(cut, "lang string, run array<string>").collect()]
    runs.sort()
    labels = sorted({lang for lang, _ in runs})
    if not labels:
        return Model([])
    seen: dict[str, dict[str, int]] = {}
    for lang, run in runs:
        for w in run:
            seen.setdefault(w, {})[lang] = seen.setdefault(w, {}).get(lang, 0) + 1
    lexicon = sorted(w for w, by in seen.items() if max(by.values()) >= 4 and max(by.values()) >= 0.8 * sum(by.values()))
    model = Model.blank(labels, {w: i for i, w in enumerate(lexicon)})
    rng = np.random.default_rng(seed)
    by_label = [[run for lang, run in runs if lang == name] for name in labels]
    texts = []
    for _ in range(sequences):
        words, gold = [], []
        label = int(rng.integers(len(labels)))
        while len(words) < length:
            run = by_label[label][int(rng.integers(len(by_label[label])))]
            run = run[: int(rng.integers(3, span_words + 1))]
            words += run
            gold += [label] * len(run)
            label = int(rng.integers(len(labels)))
        texts.append((words[:length], np.array(gold[:length])))
    return train(model, texts)


def _label(model: Model, texts: list[list[str]]) -> list[np.ndarray]:
    """For each text its words' label probabilities; no text is empty."""
    state = worker_state("langid")
    if state.get("model") is not model:  # a worker outlives a job, and so must not keep another model's words
        state.clear()
        state["model"] = model
    cache, rows = state.setdefault("cache", {}), state.get("rows")
    if len(cache) > CACHE_WORDS:
        cache.clear()
        rows = None
    distinct, numbers, lengths = numbered(texts)
    fresh = [w for w in distinct if w not in cache]
    if fresh:
        own = model.potentials(fresh)
        if rows is None or len(cache) + len(fresh) > len(rows):
            grown = np.empty((len(cache) + 2 * len(fresh) + 50_000, own.shape[1]), np.float32)
            if rows is not None:
                grown[: len(cache)] = rows[: len(cache)]
            rows = state["rows"] = grown
        rows[len(cache) : len(cache) + len(fresh)] = own
        cache.update(zip(fresh, range(len(cache), len(cache) + len(fresh)), strict=True))
    at = np.fromiter(map(cache.__getitem__, distinct), np.int64, len(distinct))
    return np.split(marginals(model, rows[at][numbers], lengths), np.cumsum(lengths)[:-1])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", runs: bool = False) -> DataFrame:
    """(id, lang_pred, score) for every row; with ``runs`` also the runs of words of one language as (lang, from, to)."""
    return _identified(keyed(docs, id_col, text_col), model, runs).withColumnRenamed("_id", id_col)


def keep_known(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is in a known language with at least the score ``least``."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"))
    found = _identified(keyed(rows.select("_row", F.col(f"_row.`{text_col}`").alias("_t")), "_row", "_t"), model, False)
    known = found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least))
    return known.select(*[F.col(f"_id.`{c}`").alias(c) for c in docs.columns])


def _identified(texts: DataFrame, model: Model, runs: bool) -> DataFrame:
    """(_id, lang_pred, score), whatever ``_id`` holds."""
    shared = texts.sparkSession.sparkContext.broadcast(model)
    run_type = pa.list_(pa.struct([("lang", pa.string()), ("from", pa.int32()), ("to", pa.int32())]))

    def decide(own: Model, ids: pa.Array, texts: list[list[str]]) -> pa.RecordBatch:
        full = [k for k, words in enumerate(texts) if words and own.labels and has_letter(words)]
        preds, scores, found = [UNKNOWN] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        for k, p in zip(full, _label(own, [texts[k] for k in full]) if full else (), strict=True):
            share = p.mean(axis=0)
            best = int(np.argmax(share))
            preds[k], scores[k] = own.labels[best], min(1.0, float(share[best]))
            if runs:
                label = p.argmax(axis=1)
                cuts = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(label)]
                found[k] = [{"lang": own.labels[label[a]], "from": a, "to": b} for a, b in zip(cuts, cuts[1:], strict=False)]
        columns = [ids, pa.array(preds, pa.string()), pa.array(scores, pa.float64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(found, run_type)][: 3 + runs], names=["_id", "lang_pred", "score", "runs"][: 3 + runs])

    def run(batches):
        own = shared.value
        for batch in batches:
            column, texts, size, at = batch.column("_text"), [], 0, 0
            for k in range(len(column)):
                texts.append(words_of(column[k].as_py()))
                size += len(texts[-1])
                if size >= CHUNK_WORDS or k == len(column) - 1:
                    yield decide(own, batch.column("_id").slice(at, len(texts)), texts)
                    at, size, texts = at + len(texts), 0, []

    shape = StructType([texts.schema["_id"]]).add("lang_pred", "string").add("score", "double")
    if runs:
        part = StructType().add("lang", "string").add("from", "integer").add("to", "integer")
        shape = shape.add("runs", ArrayType(part))
    return texts.mapInArrow(run, shape)
