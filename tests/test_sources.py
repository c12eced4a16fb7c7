import json
import os
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import ORACLES
from commentloom.operators import audit, ledger
from commentloom.plans import harvest, worker
from commentloom.schemas import COMMENTS
from commentloom.sources import config, scan, sinks
from commentloom.streaming import ingest
from check import compare, connect
from conftest import SMALL, plan_of

ROWS = [("1", "one", 100, "a", 1, 0, None), ("2", "two", 200, "b", 2, 0, None), ("1", "late", 300, "a", 3, 0, None)]


def comments(spark, data=ROWS):
    return spark.createDataFrame(data, COMMENTS)


def stage(df, path, name="tmp_batch_x"):
    df.coalesce(1).write.mode("append").option("mapreduce.output.basename", name).parquet(path)


def test_consolidate(spark, tmp_path):
    staging, main = str(tmp_path / "s"), str(tmp_path / "m")
    stage(comments(spark), staging)
    stage(comments(spark), staging, "train_old")
    done = sinks.consolidate(spark, staging, main)
    assert (done.files, done.appended) == (1, 2)
    assert sorted(r["body"] for r in spark.read.parquet(main).collect()) == ["one", "two"]
    assert all(f.startswith(("train_append", "_", ".")) for f in os.listdir(main))
    assert not [f for f in os.listdir(staging) if f.startswith("tmp_batch")]
    assert [f for f in os.listdir(staging) if f.startswith("train_old")]
    assert sinks.consolidate(spark, staging, main) == sinks.Consolidation(0, 0)


def test_consolidate_against_main_is_repeatable(spark, tmp_path):
    staging, main = str(tmp_path / "s"), str(tmp_path / "m")
    for _ in range(2):
        stage(comments(spark), staging)
        sinks.consolidate(spark, staging, main, against_main=os.path.exists(main))
    assert spark.read.parquet(main).count() == 2


@pytest.mark.parametrize("step", ["append", "half", "mark", "remove", "half removed"])
def test_consolidation_that_breaks_off_is_finished(spark, tmp_path, monkeypatch, step):
    """Wherever a run stops, the next one ends in the same table without reading it."""
    staging, main = str(tmp_path / "s"), str(tmp_path / "m")
    stage(comments(spark, [("0", "old", 1, "a", 1, 0, None)]), staging)
    sinks.consolidate(spark, staging, main)
    for name in ("tmp_batch_a", "tmp_batch_b"):
        stage(comments(spark), staging, name)
    append, write, gone = sinks.append_slices, sinks.write_text, sinks._remove

    def lost(*args, **kwargs):
        raise RuntimeError("lost")

    def half(df, path, run):
        append(df.limit(1), path, run=run)
        lost()

    with monkeypatch.context() as m:
        if step in ("append", "half"):
            m.setattr(sinks, "append_slices", lost if step == "append" else half)
        elif step == "mark":
            m.setattr(sinks, "write_text", lambda s, p, x: lost() if p.endswith("appended") else write(s, p, x))
        else:
            m.setattr(sinks, "_remove", lambda s, f: (gone(s, f[:1]) if step == "half removed" else None, lost()))
        with pytest.raises(RuntimeError):
            sinks.consolidate(spark, staging, main)
    stage(comments(spark, [("9", "late", 1, "a", 1, 0, None)]), staging, "tmp_batch_c")
    sinks.consolidate(spark, staging, main)
    assert sorted(r["body"] for r in spark.read.parquet(main).collect()) == ["late", "old", "one", "two"]
    assert not [f for f in os.listdir(staging) if f.startswith("tmp_batch")]
    assert sinks.consolidate(spark, staging, main) == sinks.Consolidation(0, 0)


def test_failed_append_keeps_staging(spark, tmp_path):
    staging, main = str(tmp_path / "s"), tmp_path / "m"
    stage(comments(spark), staging)
    main.write_text("a file where the table should be")
    with pytest.raises(Exception):
        sinks.consolidate(spark, staging, str(main))
    assert [f for f in os.listdir(staging) if f.startswith("tmp_batch")]


def test_chunks_are_bounded(spark, tmp_path):
    path = str(tmp_path / "c")
    sinks.write_chunks(spark.range(1050).coalesce(1), path, 100, "worker_2017")
    counts = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in counts) == 100 and len(counts) == 11
    assert all("worker_2017" in r[0] for r in counts)


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    texts = ['a "q", b', "two\nlines\r\n", " spaced ", "back\\slash", "é,ü"]
    sinks.write_csv(spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("t", "n"), path)
    got = scan.read_comment_csv(spark, path).orderBy(F.col("n").cast("int")).collect()
    assert [r["body"] for r in got] == texts


def test_select_shards(spark):
    paths = [f"/arc/comments/{y}/{i:02d}.parquet" for y in (2016, 2017, 2018) for i in range(30)]
    got = scan.select_shards(paths, "/arc", [2017], 10, 1)
    assert len(got) == 10 and all("/2017/" in p for p in got)
    moved = [p.replace("/arc", "/copy") for p in paths]
    again = scan.select_shards(moved[::-1], "/copy", [2017], 10, 1)
    assert [p.replace("/copy", "/arc") for p in again] == got
    assert scan.select_shards(paths, "/arc", [2017], 10, 2) != got
    assert len(scan.select_shards(paths, "/arc", [2016, 2018], 500)) == 60


def test_epoch_range_is_pushed(spark, tmp_path):
    path = str(tmp_path / "p")
    stage(comments(spark), path, "train-1")
    stage(comments(spark), path, "tmp_batch_1")
    df = scan.scan_epoch_range(spark, path, 150, 250)
    assert [r["body"] for r in df.collect()] == ["two"]
    plan = plan_of(df)
    assert "GreaterThanOrEqual(created_utc,150)" in plan
    assert "ReadSchema: struct<body:string,created_utc:bigint,subreddit:string>" in plan


def test_pages(spark):
    page = json.dumps({"data": [{"id": "1", "body": "x", "created_utc": 5, "subreddit": "Other", "score": 2, "new": 1}]})
    df = spark.createDataFrame([("asked", page), ("asked", '{"data": []}'), ("asked", "broken")], "subreddit string, page string")
    got = scan.parse_pages(df)
    assert got.columns == COMMENTS.fieldNames()
    assert [tuple(r) for r in got.collect()] == [("1", "x", 5, "asked", 2, None, None)]


def test_subreddit_config(spark, tmp_path):
    doc = {"config": {"toxicity_focused": 1, "off": 0}, "categories": {"toxicity_focused": ["Aa"], "off": ["B"], "new": ["aA", "C", "c"]}}
    path = tmp_path / "c.json"
    path.write_text(json.dumps(doc, indent=2))
    got = config.load_subreddit_dim(spark, str(path))
    assert sorted(tuple(r) for r in got.collect()) == [("aa", "new", True, 2), ("aa", "toxicity_focused", True, 1), ("b", "off", False, 2), ("c", "new", True, 2)]


def test_lexicon_round_trip(spark, tmp_path):
    doc = {"CASTE": ["zed", "alpha"], "MISOGYNY_GENDER": ["é"]}
    path = tmp_path / "l.json"
    path.write_text(json.dumps(doc))
    text = config.lexicon_json(config.load_lexicon(spark, str(path))).first()[0]
    assert json.loads(text) == doc


def test_targets_and_stopwords(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(json.dumps({"global_goal": 20, "clean_data": 10, "categories": {"misogyny_gender": 3, "caste": 2}}))
    got = [tuple(r) for r in config.load_targets(spark, str(path)).orderBy("ord").collect()]
    assert got == [("misogyny_gender", 3, 0), ("caste", 2, 1), ("clean_data", 10, 2)]
    words = tmp_path / "w.txt"
    words.write_text(" The \n\nand\nthe\n")
    assert sorted(r[0] for r in config.load_stopwords(spark, str(words)).collect()) == ["and", "the"]
    assert config.load_stopwords(spark, str(tmp_path / "none.txt")).count() == 4


def test_ledger(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.ledger_append(comments(spark), path)
    ledger.ledger_append(comments(spark, [*ROWS, ("9", "n", 1, "a", 1, 0, None)]), path)
    assert sorted(r[0] for r in ledger.read_ledger(spark, path).collect()) == ["1", "2", "9"]
    data = comments(spark, [("7", "n", 1, "a", 1, 0, None)])
    assert [r[0] for r in ledger.reconcile_ledger(data, ledger.read_ledger(spark, path)).collect()] == ["7"]


def test_stream_ingest_over_runs(spark, tmp_path):
    landing, main, state = (str(tmp_path / n) for n in ("l", "m", "s"))
    stage(comments(spark, [*ROWS, ("3", "[deleted]", 1, "a", 1, 0, None)]), landing)
    ingest.stream_ingest(spark, landing, main, state).awaitTermination()
    assert spark.read.parquet(main).count() == 2
    stage(comments(spark, [("2", "two", 200, "b", 2, 0, None), ("4", "new", 90000000, "b", 2, 0, None)]), landing)
    ingest.stream_ingest(spark, landing, main, state).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(main).collect()) == ["1", "2", "4"]
    # A replay of everything, as after a lost stream state, adds nothing.
    ingest.stream_ingest(spark, landing, main, state + "2").awaitTermination()
    assert spark.read.parquet(main).count() == 3


def test_labelling_rounds(spark):
    """A labeler that fails on first sight of each batch succeeds in the second round."""
    sample = comments(spark).withColumn("body_clean", F.col("body")).dropDuplicates(["id"])

    def flaky(pdf):
        item = '{"pv": 1, "tah": 0, "dhs": 0, "cst": 0, "cr": 0, "rx": 0, "mg": 0}'
        return [
            "oops" if a == 1 else "[" + ", ".join([item] * len(i)) + "]"
            for a, i in zip(pdf["attempt"], pdf["ids"])
        ]

    run = worker.label_batches(sample, flaky, size=1)
    assert run.rounds == 2
    assert sorted((r["id"], r["pv"]) for r in run.labels.collect()) == [("1", 1), ("2", 1)]


def test_harvest_stops_when_targets_are_met(spark):
    df = spark.createDataFrame([("t", 1, 1, 1, 1, 1, 1, 1)], "text string, profanity_vulgarity int, targeted_abuse_harassment int, discriminatory_hate_speech int, caste int, communal_religious int, regional_xenophobic int, misogyny_gender int")
    none = spark.createDataFrame([], "category string, term string, pos long")
    assert harvest.harvest_plan(df, audit.targets_from_goal(spark, 8), none) is None
    plan = harvest.harvest_plan(df, audit.targets_from_goal(spark, 80), none)
    assert (plan.category, plan.shortfall) == ("caste", 9)


@pytest.mark.parametrize("hits", [12499, 12500])
def test_harvest_flows_over_tables_that_just_miss_or_meet_every_goal(spark, tmp_path, hits):
    """The queries' goal is 12,500 hits a category; when it is met there are no candidates, as in SQL, and no error."""
    sf, own = str(tmp_path), {
        "documents": "i AS doc_id, concat('trash worthless idiot scum text ', i) AS text, 'en' AS lang, concat('src', i % 5) AS source, 32::BIGINT AS n_chars",
        "labels": "i AS doc_id, 0::BIGINT AS quality, 1::BIGINT AS toxic",
        "orders": "i AS o_orderkey, TIMESTAMP '2020-01-01' AS o_orderdate",
    }
    for path in Path(SMALL).iterdir():
        if path.stem in own:
            duckdb.sql(f"COPY (SELECT {own[path.stem]} FROM range(1, {hits} + 1) t(i)) TO '{sf}/{path.name}' (FORMAT parquet)")
        else:
            (tmp_path / path.name).symlink_to(path)
    con = connect(sf)
    for name in ("flow_harvest_candidates", "flow_harvest_run"):
        assert compare(spark, con, sf, name) == ""
    assert (con.execute(f"SELECT count(*) FROM ({ORACLES['flow_harvest_candidates']})").fetchone()[0] > 0) == (hits < 12500)


def test_a_second_harvest_publishes_other_comments(spark, tmp_path):
    """The ledger keeps what the first round published out of the second one's draw."""
    flags = "profanity_vulgarity int, targeted_abuse_harassment int, discriminatory_hate_speech int, caste int, communal_religious int, regional_xenophobic int, misogyny_gender int"
    labelled = spark.createDataFrame([("t", 1, 1, 1, 1, 1, 1, 1)], f"text string, {flags}")
    lexicon = spark.createDataFrame([("caste", "wordy", 1)], "category string, term string, pos long")
    archive = comments(spark, [(str(i), f"a wordy comment {i}", 100 + i, "a", 5, 0, None) for i in range(8)])
    dim = spark.createDataFrame([("a", 1, True)], "subreddit string, tier int, enabled boolean")
    out, ledger_path = str(tmp_path / "out"), str(tmp_path / "ledger")

    def labeler(pdf):
        item = '{"pv": 1, "tah": 0, "dhs": 0, "cst": 0, "cr": 0, "rx": 0, "mg": 0}'
        return ["[" + ", ".join([item] * len(i)) + "]" for i in pdf["ids"]]

    seen = set()
    for rounds in (1, 2, 3):
        harvest.publish_harvest_run(
            labelled, audit.targets_from_goal(spark, 80), lexicon, archive, dim, labeler, out, "p", threshold=20, ledger_path=ledger_path
        )
        ids = [r["id"] for r in spark.read.schema("id string").parquet(out).collect()]
        assert len(ids) == len(set(ids)) == 2 * rounds and seen < set(ids)
        seen = set(ids)
        assert {r["id"] for r in spark.read.parquet(ledger_path).collect()} == seen


def test_years_are_found_with_and_without_month():
    names = ["2017/a.parquet", "2017.parquet", "201701.parquet", "RC_2017-01.parquet", "year=2017/b.parquet", "120170.parquet", "201799.parquet", "2018.parquet"]
    paths = [f"/x/{n}" for n in names]
    assert scan.select_shards(paths, "/x", [2017], 100) == sorted(paths[:5])
    assert len(scan.select_shards(paths, "/x", [2017], 2)) == 2


def test_batches_that_no_round_labels_come_back(spark):
    sample = comments(spark).withColumn("body_clean", F.col("body")).dropDuplicates(["id"])

    def half(pdf):
        item = '{"pv": 1, "tah": 0, "dhs": 0, "cst": 0, "cr": 0, "rx": 0, "mg": 0}'
        return ["[" + item + "]" if list(i) == ["1"] else "oops" for i in pdf["ids"]]

    run = worker.label_batches(sample, half, size=1, max_retries=2)
    assert [r["id"] for r in run.labels.collect()] == ["1"]
    assert [list(r["ids"]) for r in run.given_up.collect()] == [["2"]]
