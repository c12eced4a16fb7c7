"""Figures recorded for the sf0.01 tables."""

import pytest
from pyspark.sql import functions as F

from commentloom.catalog import views as v
from commentloom.operators import audit, dedup, filters, labeling, lexicon, sampling
from commentloom.schemas import FLAGS
from conftest import MEDIUM


@pytest.fixture(scope="module")
def labelled(spark):
    return v.labelled(spark, MEDIUM).cache()


def test_comments(spark):
    rows = v.comments(spark, MEDIUM)
    got = rows.agg(F.count("*"), F.min("created_utc"), F.max("created_utc")).first()
    assert tuple(got) == (1000, 789264794, 996624719)
    kept = filters.length_between(filters.drop_tombstones(rows), 10, 1000)
    assert kept.count() == 291
    narrow = filters.length_between(filters.drop_tombstones(rows), 30, 500)
    assert filters.min_score(narrow, 2).count() == 51


def test_labelled(labelled):
    got = labelled.agg(
        F.count("*"), F.count_distinct("text"), F.count_distinct("subreddit"),
        F.count_distinct("year_month"), *[F.sum(c) for c in FLAGS]
    ).first()
    assert tuple(got) == (399, 363, 20, 78, 51, 38, 33, 21, 18, 19, 19)
    split = audit.class_split(labelled).first()
    assert (split["toxic"], split["clean"]) == (51, 348)
    assert labeling.check_label_invariants(labelled).count() == 0
    assert dedup.dedup_normalised(labelled).count() == 363
    assert labelled.select("subreddit", "year_month").distinct().count() == 367


def test_stratified_sample(labelled):
    drawn = sampling.sample_per_stratum(labelled, ["subreddit"], 5, 42)
    got = drawn.agg(F.count("*"), F.sum(F.col("id").cast("long"))).first()
    assert tuple(got) == (100, 46770)


def test_lines(spark):
    lines = v.comment_lines(spark, MEDIUM)
    assert lines.count() == 9344
    assert dedup.dedup_by_text(lines).count() == 7611
    assert dedup.dedup_normalised(lines, ascii_strict=True).count() == 7600
    assert filters.length_between(lines, 10, 1000, "text").count() == 8778


def test_seeds(spark):
    rows = v.corpus(spark, MEDIUM)
    assert lexicon.dynamic_stopwords(rows).count() == 116
    seeds = lexicon.tfidf_seeds(rows, "toxic", 12).collect()
    assert [(r["word"], round(r["score"], 5)) for r in seeds[:3]] == [
        ("ononst", 6619.32595), ("hehely", 6609.14237), ("orantion", 5887.05803)
    ]
    assert {r["word"] for r in seeds[8:12]} == {"trash", "worthless", "idiot", "scum"}
