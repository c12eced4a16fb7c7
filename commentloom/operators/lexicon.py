"""Word statistics, lexicon discovery and lexicon matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commentloom.functions.terms import found, holds_any
from commentloom.functions.text import tokenize, tokenize_alpha
from commentloom.operators.ranking import lowest_per_group
from commentloom.schemas import CATEGORY_FLAGS
from commentloom.session import materialize


def _words(df: DataFrame, tokens: Column, *keep) -> DataFrame:
    return df.select(*keep, F.explode(tokens).alias("word"))


def document_frequency(df: DataFrame, col: str = "text", out: str = "df") -> DataFrame:
    """Number of texts that hold each word."""
    words = _words(df, F.array_distinct(tokenize(col)))
    return words.groupBy("word").agg(F.count("*").alias(out))


def _frequent(words: DataFrame, corpus: DataFrame, share: float, col: str) -> DataFrame:
    limit = F.floor(corpus.agg(F.count(col)).scalar() * F.lit(share))
    return words.filter(F.col("df") > limit).select("word")


def dynamic_stopwords(
    df: DataFrame, static: DataFrame | None = None, share: float = 0.15, col: str = "text"
) -> DataFrame:
    """Words in more than ``int(share * texts)`` texts, joined by the static list.

    At most (distinct words of an average text) / share words can pass, whatever the corpus size.
    """
    words = _frequent(document_frequency(df, col), df, share, col)
    return words if static is None else words.unionByName(static.select("word")).distinct()


def term_frequency(
    df: DataFrame, flag: str, stopwords: DataFrame, min_len: int = 3, col: str = "text"
) -> DataFrame:
    """Occurrences in the texts with ``flag = 1``.

    Words are counted before the stop-word join, so it meets the vocabulary, not every token.
    """
    counts = (
        _words(df.filter(F.col(flag) == 1), tokenize(col)).groupBy("word").agg(
            F.count("*").alias("tf")
        )
    )
    return counts.filter(F.length("word") >= min_len).join(stopwords, "word", "left_anti")


def _vocabulary(df: DataFrame, flag: str, col: str) -> DataFrame:
    """(word, df, bg_df, tf): texts with the word, those of them with ``flag = 0``, and occurrences where it is 1.

    A text's words are sorted, so the first of each run of equal words stands for the text.  Every text that is not null also has a null
    word, whose ``df`` is the number of texts.
    """
    sorted_ = df.select(F.col(flag).alias("_flag"), F.array_sort(tokenize(col)).alias("_words"))
    new = lambda x, i: (i == 0) | (x != F.get("_words", i - 1))
    marked = F.transform("_words", lambda x, i: F.struct(x.alias("word"), new(x, i).alias("new")))
    text = F.array(F.struct(F.lit(None).cast("string").alias("word"), F.lit(True).alias("new")))
    return (
        sorted_.select("_flag", F.inline(F.concat(text, marked)))
        .groupBy("word")
        .agg(
            F.count_if("new").alias("df"),
            F.count_if(F.col("new") & (F.col("_flag") == 0)).alias("bg_df"),
            F.count_if(F.col("_flag") == 1).alias("tf"),
        )
    )


def tfidf_scores(
    df: DataFrame,
    flag: str,
    static: DataFrame | None = None,
    share: float = 0.15,
    min_len: int = 3,
    col: str = "text",
) -> DataFrame:
    """``tf * ln(max(V, 1) / (bg_df + 1))`` per word of the flagged texts.

    V is the number of distinct background words, not of texts.  One pass over the texts writes the
    vocabulary with its three counts and the number of texts; all else reads the vocabulary.
    """
    counted = materialize(_vocabulary(df, flag, col), "vocabulary")
    vocabulary, texts = counted.filter("word IS NOT NULL"), counted.filter("word IS NULL").agg(F.sum("df")).scalar()
    stop = vocabulary.filter(F.col("df") > F.floor(texts * F.lit(share))).select("word")
    if static is not None:
        stop = stop.unionByName(static.select("word")).distinct()
    bg = (
        vocabulary.filter((F.col("bg_df") > 0) & (F.length("word") >= min_len))
        .join(stop, "word", "left_anti")
        .select("word", "bg_df")
    )
    size = F.greatest(bg.agg(F.count("*")).scalar(), F.lit(1))
    bg_df = F.coalesce("bg_df", F.lit(0))
    flagged = vocabulary.filter((F.col("tf") > 0) & (F.length("word") >= min_len)).select("word", "tf")
    return (
        flagged.join(stop, "word", "left_anti")
        .join(bg, "word", "left")
        .select("word", "tf", bg_df.alias("bg_df"))
        .withColumn("score", F.round(F.col("tf") * F.log(size / (F.col("bg_df") + 1)), 6))
    )


def tfidf_seeds(
    df: DataFrame,
    flag: str,
    k: int = 10,
    static: DataFrame | None = None,
    share: float = 0.15,
    min_len: int = 3,
    col: str = "text",
) -> DataFrame:
    scores = tfidf_scores(df, flag, static, share, min_len, col)
    return scores.orderBy(F.desc("score"), "word").limit(k)


def minority_keywords(
    df: DataFrame,
    k: int = 12,
    stopwords: list[str] = (),
    categories: list[str] = CATEGORY_FLAGS,
    col: str = "text",
) -> DataFrame:
    """The most frequent words of each category's texts.

    Each text is tokenised once and counted once per word with one sum per category.
    """
    hit = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) == 1, F.lit(False)) for c in categories])
    words = _words(df.filter(hit), tokenize_alpha(col), *categories)
    if stopwords:
        words = words.filter(~F.col("word").isin(list(stopwords)))
    counts = (
        words.groupBy("word")
        .agg(*[F.count_if(F.col(c) == 1).alias(c) for c in categories])
        .unpivot("word", list(categories), "category", "n")
        .filter("n > 0")
    )
    top = lowest_per_group(counts, ["category"], [F.desc("n"), F.col("word")], k, "rank")
    return top.select("category", "word", "n", F.col("rank").cast("long").alias("rank"))


def term_entries(lexicon: DataFrame) -> dict[str, list[dict]]:
    """The lexicon's distinct (category, term), lower-cased, by term.  A lexicon is configuration: it is read whole."""
    pairs = lexicon.select("category", F.lower("term").alias("term")).dropna(subset="term").distinct().collect()
    out: dict[str, list[dict]] = {}
    for r in sorted(pairs, key=lambda r: (r["term"], r["category"] or "")):
        out.setdefault(r["term"], []).append({"category": r["category"], "term": r["term"]})
    return out


ENTRY = "struct<category:string,term:string>"


def lexicon_hits(
    df: DataFrame, lexicon: DataFrame, col: str = "body", id_col: str = "id"
) -> DataFrame:
    """(id, category, term) for every term a lower-cased text contains.

    All terms are searched in one pass (``functions.terms``), whose cost does not grow with their number;
    texts are neither joined nor shuffled.
    """
    return df.select(id_col, F.inline(found(F.lower(col), term_entries(lexicon), ENTRY)))


SEED = 9  # so many characters of a term's piece choose the words that it is held against
_GAP = r"\s+"


def _pieces(text: Column) -> Column:
    return F.split(text, _GAP)


def ids_with_terms(df: DataFrame, lexicon: DataFrame, col: str = "body", id_col: str = "id") -> DataFrame:
    """The ids, each once, of the lower-cased texts that contain any term of a lexicon that is a table of any size.

    Nothing of the lexicon but the lengths up to ``SEED`` and its blank terms reaches the driver.  Terms and texts are cut at white space:
    a term's longest piece lies within one piece of every text that holds the term.  So the texts' distinct pieces
    and the terms' meet on the first ``SEED`` characters of the latter, or all of a shorter one, and are compared in full.  Only ids
    and pieces are shuffled; texts are looked at again for terms of several pieces alone.
    """
    text = F.lower(col)
    longest = lambda x: F.array_max(F.transform(_pieces(x), lambda y: F.struct(F.length(y).alias("n"), y.alias("p"))))["p"]
    terms = lexicon.select(F.lower("term").alias("term")).dropna().distinct().withColumn("piece", longest(F.col("term")))
    terms = materialize(terms.withColumn("seed", F.substring("piece", 1, SEED)), "terms")
    sizes = sorted(r[0] for r in terms.select(F.length("seed")).distinct().collect())  # SEED + 1 numbers at most
    blank = terms.filter("piece = ''").select("term")
    out = []
    if 0 in sizes:  # white space only
        out.append(df.filter(holds_any(text, [r["term"] for r in blank.collect()])).select(id_col))
    sizes = [n for n in sizes if n]
    if sizes:
        words = df.select(id_col, F.explode(F.array_distinct(_pieces(text))).alias("_word"))
        words = materialize(words.filter(F.length("_word") >= sizes[0]), "words")
        seeds = [F.regexp_extract_all("_word", F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in sizes]
        vocabulary = words.select("_word").distinct()
        met = vocabulary.select("_word", F.explode(F.array_distinct(F.concat(*seeds))).alias("seed")).join(terms, "seed")
        met = materialize(met.filter(F.contains("_word", "piece")).select("_word", "piece", "term"), "met")
        whole = met.filter("term = piece").select("_word").distinct()
        out.append(words.join(whole, "_word", "left_semi").select(id_col))
        several = met.filter("term <> piece").select("_word", "term")
        if not several.isEmpty():
            maybe = words.join(several, "_word").select(F.col(id_col).alias("_id"), "term").distinct()
            texts = df.select(id_col, text.alias("_text"))
            sure = texts.join(maybe, texts[id_col].eqNullSafe(F.col("_id"))).filter(F.contains("_text", "term"))
            out.append(sure.select(id_col))
    if not out:
        return df.select(id_col).limit(0)
    return reduce(DataFrame.unionByName, out).distinct()


def hit_counts(hits: DataFrame) -> DataFrame:
    return hits.groupBy("category", "term").agg(F.count("*").alias("n"))
