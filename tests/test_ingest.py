"""The stream's id set: pruned reads, merged runs, and batches that break off at any step."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from commentloom.operators import audit, id_index
from commentloom.schemas import COMMENTS, FLAGS
from commentloom.streaming import ingest
from conftest import plan_of


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def batch(spark, rows):
    return spark.createDataFrame([(i, f"text {i}", t, "sub", 1, 0, None) for i, t in rows], COMMENTS)


def stored(spark, main):
    return sorted((r["id"] or "", r["year_month"]) for r in spark.read.schema("id string, year_month string").parquet(main).collect())


DAY = 86400
FIRST = [("a", 1), ("b", 2), ("c", 40 * DAY), (None, 5)]
SECOND = [("a", 100 * DAY), ("d", 3), ("d", 90 * DAY), ("e", 40 * DAY), (None, 6)]
BOTH = [("", "1970-01"), ("a", "1970-01"), ("b", "1970-01"), ("c", "1970-02"), ("d", "1970-01"), ("e", "1970-02")]


def test_a_lookup_reads_its_own_buckets_only(spark, tmp_path):
    path = str(tmp_path / "set")
    id_index.add_ids(ids(spark, [str(i) for i in range(2000)]), path)
    asked = [3, 77]
    known = id_index.read_ids(spark, path, asked)
    assert "bucket" in plan_of(known).split("PartitionFilters: [")[1].split("]")[0]
    files = known.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("bucket=")[1].split("/")[0] for r in files} == {"3", "77"}
    want = {str(i) for i in range(2000)}
    assert {r["id"] for r in id_index.read_ids(spark, path).collect()} == want
    fresh = id_index.unseen(ids(spark, ["5", "x", None]), path)
    assert {r["id"] for r in fresh.collect()} == {"x", None}
    scans = plan_of(id_index.unseen(ids(spark, ["5"]), path))
    assert "PartitionFilters: [" in scans and scans.count("Scan parquet") == 1


def test_runs_are_merged_and_lost_ones_ignored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(id_index, "MAX_RUNS", 4)
    path = str(tmp_path / "set")
    for i in range(12):
        id_index.add_ids(ids(spark, [str(i), str(100 + i), None]), path)
        assert len(id_index.runs(spark, path)) <= 5
    (tmp_path / "set" / "run=lost" / "bucket=1").mkdir(parents=True)
    assert len(id_index.runs(spark, path)) <= 5
    got = [r["id"] for r in id_index.read_ids(spark, path).distinct().collect()]
    assert sorted(map(str, got)) == sorted([str(i) for i in range(12)] + [str(100 + i) for i in range(12)] + ["None"])


def test_an_id_is_stored_once_whatever_its_month(spark, tmp_path):
    main, index = str(tmp_path / "main"), str(tmp_path / "main" / "_ids")
    for rows in (FIRST, SECOND, FIRST, SECOND):
        ingest._append_new(batch(spark, rows), main, index)
    assert stored(spark, main) == BOTH


@pytest.mark.parametrize("step", ["append_slices", "add_ids", "remove", "late"])
def test_a_batch_that_breaks_off_is_settled(spark, tmp_path, monkeypatch, step):
    """Broken off before the append, before the ids, before the note goes, or half way through the append."""
    main, index = str(tmp_path / "main"), str(tmp_path / "ids")
    ingest._append_new(batch(spark, FIRST), main, index)
    append = ingest.append_slices
    with monkeypatch.context() as m:
        if step == "late":

            def half(df, path, by):
                append(df.filter(F.col("id") == "d"), path, by)
                raise RuntimeError("lost")

            m.setattr(ingest, "append_slices", half)
        else:
            calls = []

            def fail(*args):
                calls.append(args)
                if step == "remove" and len(calls) == 1:  # the first call clears what is left of earlier batches
                    return id_index.remove(*args)
                raise RuntimeError("lost")

            m.setattr(ingest, step, fail)
        with pytest.raises(RuntimeError):
            ingest._append_new(batch(spark, SECOND), main, index)
    ingest._append_new(batch(spark, SECOND), main, index)
    assert stored(spark, main) == BOTH


@pytest.mark.parametrize("few", [0, 100_000])
def test_a_batch_writes_its_texts_to_the_main_table_only(spark, tmp_path, monkeypatch, few):
    """The first row per id, times before texts, a missing time first; nothing but ids and times is written besides."""
    main, index, written = str(tmp_path / "main"), str(tmp_path / "ids"), []
    keep = ingest.materialize
    monkeypatch.setattr(ingest, "materialize", lambda df, label: written.append(df.columns) or keep(df, label))
    monkeypatch.setattr(ingest, "_FEW", few, raising=False)
    data = [(i, f"text {k}", t, "sub", 1, 0, None) for k, (i, t) in enumerate([*FIRST, *SECOND, ("a", 1), ("d", None), ("d", None), ("", 5), ("", 5)])]
    ingest._append_new(spark.createDataFrame(data[::-1], COMMENTS).repartition(5), main, index)
    ingest._append_new(spark.createDataFrame(data, COMMENTS), main, index)
    least = {}
    for row in data:
        rank = row[2] is not None, row[2] or 0, row[1]
        least[row[0]] = min(least.get(row[0], (rank, row)), (rank, row), key=lambda x: x[0])
    got = spark.read.schema("id string, body string, created_utc long").parquet(main).select("id", "body", "created_utc").collect()
    assert sorted(map(tuple, got), key=str) == sorted((row[:3] for _, row in least.values()), key=str)
    assert written and not [c for c in written if "body" in c]


def test_a_table_without_a_set_gets_one(spark, tmp_path):
    main = str(tmp_path / "main")
    ingest.append_slices(batch(spark, FIRST).withColumn("year_month", F.lit("1970-01")), main, ["year_month"])
    ingest._append_new(batch(spark, SECOND), main, f"{main}/_ids")
    assert [r[0] for r in stored(spark, main)] == [r[0] for r in BOTH]


def test_the_main_table_is_not_read(spark, tmp_path):
    main, index = str(tmp_path / "main"), str(tmp_path / "ids")
    ingest._append_new(batch(spark, FIRST), main, index)
    plan = plan_of(id_index.unseen(batch(spark, SECOND).select("id"), index))
    assert str(tmp_path / "main") not in plan and "bucket" in plan


# ---- running totals


FLAGS_SQL = ", ".join(f"{c} int" for c in FLAGS)


def labelled(spark, rows):
    return spark.createDataFrame([(i, *([0] * (len(FLAGS) - 1)), f) for i, f in rows], f"id string, {FLAGS_SQL}")


def current(spark, totals):
    goal = audit.targets_from_goal(spark, 80)
    return {r["metric"]: r["current"] for r in ingest.running_audit(spark, totals, goal).collect()}


def test_totals_count_an_id_once_and_stay_small(spark, tmp_path):
    landing, totals, state = (str(tmp_path / n) for n in ("l", "t", "s"))
    schema = labelled(spark, []).schema
    arrivals = [[("a", 1), ("b", 0)], [("a", 1), ("c", 1), ("c", 1)], [("d", 0)], [("b", 0)], [("e", 1)]]
    for k, rows in enumerate(arrivals):
        labelled(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        stream = ingest.read_landing(spark, landing, "*.parquet", schema, 1)
        ingest.stream_label_audit(stream, totals, state).awaitTermination()
        kept = [p.name for p in (tmp_path / "t").iterdir() if p.name.startswith("upto=")]
        assert len(kept) <= 2
    seen = current(spark, totals)
    assert seen[FLAGS[-1]] == 3 and seen[ingest.CLEAN] == 5


def test_a_replayed_batch_changes_no_totals(spark, tmp_path, monkeypatch):
    """Broken off after its totals or after its ids, a batch that runs again writes the same."""
    landing, totals, state = (str(tmp_path / n) for n in ("l", "t", "s"))
    schema = labelled(spark, []).schema

    def run():
        stream = ingest.read_landing(spark, landing, "*.parquet", schema, 1)
        ingest.stream_label_audit(stream, totals, state).awaitTermination()

    labelled(spark, [("a", 1), ("b", 0)]).coalesce(1).write.mode("append").parquet(landing)
    run()
    add = ingest.add_ids
    for after in (False, True):
        labelled(spark, [("a", 1), (f"x{after}", 1)]).coalesce(1).write.mode("append").parquet(landing)
        with monkeypatch.context() as m:

            def fail(*args, **kwargs):
                if after:
                    add(*args, **kwargs)
                raise RuntimeError("lost")

            m.setattr(ingest, "add_ids", fail)
            with pytest.raises(Exception):
                run()
        run()
    seen = current(spark, totals)
    assert seen[FLAGS[-1]] == 3 and seen[ingest.CLEAN] == 4


def test_an_audit_of_nothing(spark, tmp_path):
    assert set(current(spark, str(tmp_path / "none")).values()) == {0}


# ---- sketches


def test_profiles_from_sketches(spark, tmp_path):
    """Slices overlap; a slice saved again counts once; the estimate stays within four standard errors."""
    path = str(tmp_path / "sketches")
    rows = spark.range(60_000).selectExpr("string(id) AS id", "concat('t', id % 20000) AS text")
    for name, part in (("a", rows.limit(40_000)), ("b", rows.filter("id >= 20000")), ("b", rows.filter("id >= 20000"))):
        audit.save_sketches(part, path, name)
    audit.save_sketches(spark.createDataFrame([(None, None)] * 3, "id string, text string"), path, "nulls")
    got = audit.sketched_profile(spark.read.parquet(path)).first()
    assert got["total"] == 80_003
    assert abs(got["unique_ids"] - 60_000) < 0.065 * 60_000 and abs(got["unique_texts"] - 20_000) < 0.065 * 20_000
    exact = audit.distinct_profile(rows, approx=True).first()
    assert exact["total"] == 60_000 and abs(exact["unique_texts"] - 20_000) < 0.2 * 20_000
