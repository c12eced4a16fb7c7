import hashlib
import random

import pytest
from pyspark.sql import functions as F

from commentloom.operators import (
    audit,
    dedup,
    filters,
    formatting,
    indexing,
    joins,
    labeling,
    ledger,
    lexicon,
    ranking,
    sampling,
)
from commentloom.plans import migration
from commentloom.schemas import FLAGS
from conftest import plan_of


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def hot(spark, n=4000):
    """A third of all rows in one group, the rest in small ones."""
    group = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97 + 1)
    return spark.range(n).select(
        F.col("id").cast("string").alias("id"), group.cast("string").alias("subreddit"),
        (F.col("id") % 5).cast("string").alias("year_month"), F.col("id").alias("created_utc"),
    )


def brute_lowest(spark_rows, n, seed=42):
    def key(r):
        return hashlib.md5(f"{seed}|{r['id']}".encode()).hexdigest(), r["id"]

    return sorted(spark_rows, key=key)[:n]


# --- filters ---------------------------------------------------------------------------------


def test_null_body_is_a_tombstone(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", "[removed]"), ("d", "x")], "id string, body string")
    assert rows(filters.drop_tombstones(df), "id") == [("d",)]


def test_keywords(spark):
    df = spark.createDataFrame([("1", "A 100% Sure_thing"), ("2", "sureXthing 100 %")], "id string, body string")
    assert rows(filters.match_any_keyword(df, ["100%", "sure_thing"]), "id") == [("1",)]
    assert rows(filters.match_any_keyword(df, []), "id") == []
    assert rows(filters.match_any_keyword(df, ["a", "b", "sure"], max_terms=2), "id") == [("1",)]
    assert rows(filters.match_any_keyword(df, ["sure"], whole_word=True), "id") == []


def test_units(spark):
    units = filters.fetch_units(spark, " B, a,b,", "2019-11", "2020-02")
    got = [tuple(r) for r in units.orderBy("subreddit_pos", "year_month").collect()]
    assert [g[1:3] for g in got[:4]] == [("b", m) for m in ("2019-11", "2019-12", "2020-01", "2020-02")]
    assert got[0][3:] == (1572566400, 1575158400)
    assert len(got) == 8
    for bad in (("", "2020-01", "2020-02"), ("a", "2020-13", "2020-14"), ("a", "2020-02", "2020-01"), ("a", "x", "2020-01")):
        with pytest.raises(ValueError):
            filters.fetch_units(spark, *bad)


def test_unit_bounds_are_half_open(spark):
    units = filters.fetch_units(spark, "a", "2020-01", "2020-01")
    df = spark.createDataFrame(
        [("1", "A", 1577836799), ("2", "a", 1577836800), ("3", "a", 1580515199), ("4", "a", 1580515200)],
        "id string, subreddit string, created_utc long",
    )
    assert rows(filters.assign_to_units(df, units), "id") == [("2",), ("3",)]


def test_all_units_empty(spark):
    units = filters.fetch_units(spark, "a,b", "2020-01", "2020-02")
    none = spark.createDataFrame([], "subreddit string, year_month string")
    got = audit.fetch_outcome(none, none, units)
    assert got.count() == 4 and rows(got.select("status").distinct()) == [("no data",)]


def test_list_membership_reaches_parquet(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stored = docs.select(F.col("source").alias("subreddit"))
    plan = plan_of(filters.in_subreddits(stored, ["src1"], stored_lower=True))
    assert "PushedFilters: [EqualTo" in plan or "PushedFilters: [In" in plan or "EqualTo(source,src1)" in plan


# --- ranking and sampling --------------------------------------------------------------------


def test_dedup_trims_before_the_shuffle(spark):
    plan = plan_of(dedup.dedup_by_id(hot(spark)))
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("n", [3, 1500])
def test_draw_per_group_is_exact(spark, n):
    df = hot(spark, 6000).repartition(13)
    got = ranking.draw_per_group(df, ["subreddit"], n, 42)
    groups = {}
    for r in df.collect():
        groups.setdefault(r["subreddit"], []).append(r)
    want = sorted(r["id"] for g in groups.values() for r in brute_lowest(g, n))
    assert [r[0] for r in rows(got, "id")] == want


@pytest.mark.parametrize("n", [10, 2500])
def test_cap_total_is_exact(spark, n):
    df = hot(spark, 5000)
    want = sorted(r["id"] for r in brute_lowest(df.collect(), n))
    assert [r[0] for r in rows(sampling.cap_total(df.repartition(17), n), "id")] == want


def test_draws_with_leading_columns_and_nulls(spark):
    """Order by a column first, its null first; null ids come before all others; null groups are groups."""
    data = [(None if i % 50 == 0 else str(i), None if i % 7 == 0 else i % 3, "g" if i % 2 else None) for i in range(900)]
    df = spark.createDataFrame(data, "id string, year int, g string").repartition(6)
    rank = lambda r: (r[1] is not None, r[1] or 0, r[0] is not None, hashlib.md5(f"42|{r[0]}".encode()).hexdigest() if r[0] else "")
    for n in (1, 40, 200):
        got = ranking.draw_per_group(df, ["g"], n, 42, before=["year"]).collect()
        for g in ("g", None):
            want = sorted((r for r in data if r[2] == g), key=rank)[:n]
            assert sorted(map(str, ((r["id"], r["year"]) for r in got if r["g"] == g))) == sorted(str(r[:2]) for r in want)


@pytest.mark.parametrize("n", [200, 12500])
def test_draws_drop_rows_before_anything_moves(spark, n):
    """About n rows of a hot group are left for the one shuffle, in any session and for any n."""
    df = hot(spark, 90_000).withColumn("text", F.concat("id", F.lit(" some text")))
    near = ranking.under_cut(df, ["subreddit"], n, 42)
    left = {r["subreddit"]: r["count"] for r in near.groupBy("subreddit").count().collect()}
    assert n <= left["0"] <= 1.2 * n
    full = plan_of(sampling.sample_per_stratum(df, ["subreddit"], n))
    assert full.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in full
    assert full.index("Exchange hashpartitioning") < full.index("_place")  # the cut lies below the exchange


def test_repeated_ids_are_drawn_as_often_as_they_are(spark):
    df = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "c"), ("2", "d")], "id string, body string")
    assert sampling.cap_total(df, 4).count() == 4
    assert sampling.cap_total(df, 10).count() == 4
    assert [sampling.cap_total(df, n).count() for n in (1, 2, 3)] == [1, 2, 3]


def test_samples_ignore_partitioning(spark):
    df = hot(spark).withColumn("tier", F.when(F.col("subreddit") < "3", "Tier 1").otherwise("Tier 2"))
    for draw in (
        lambda d: sampling.balance_tiers(d, 300).select("id", "drawn"),
        lambda d: sampling.balance_quota(d, 700).select("id"),
        lambda d: sampling.equal_per_subreddit(d, 400).select("id"),
    ):
        assert rows(draw(df)) == rows(draw(df.repartition(11, "created_utc")))


@pytest.mark.parametrize("target", [50, 300, 3000, 100000])
def test_balance_tiers(spark, target):
    df = hot(spark).withColumn("tier", F.when(F.col("subreddit") < "3", "Tier 1").otherwise("Tier 2"))
    got = sampling.balance_tiers(df, target).collect()
    ids = [r["id"] for r in got]
    assert len(ids) == len(set(ids))
    buckets = df.select("tier", "subreddit", "year_month").distinct().groupBy("tier").count()
    n_buckets = {r["tier"]: r["count"] for r in buckets.collect()}
    assert len(ids) >= min(target, df.count())
    drawn = sum(max(q, n_buckets[t]) for t, q in sampling.tier_quotas(target))
    assert len(ids) <= max(target, drawn)


def test_balance_quota_overshoot_and_strict(spark):
    df = hot(spark)
    buckets = df.select("subreddit", "year_month").distinct().count()
    assert sampling.balance_quota(df, 10).count() == buckets
    assert sampling.balance_quota(df, 10, strict=True).count() == 10


def test_quotas():
    assert sampling.harvest_quotas() == {"Tier 1": 60, "Tier 2": 320, "Tier 3": 20}
    assert sampling.tier_quotas(12500) == [("Tier 1", 8750), ("Tier 2", 3750)]
    assert sampling.tier_quotas(1) == [("Tier 1", 1), ("Tier 2", 1)]


# --- indexing --------------------------------------------------------------------------------


def test_row_index_with_equal_keys(spark):
    df = spark.range(3000).select(F.lit("same").alias("k"), (F.col("id") % 2).alias("x"))
    got = indexing.row_index(df.repartition(9), ["k"])
    assert sorted(r["row_index"] for r in got.collect()) == list(range(3000))


def test_row_index_is_the_place_in_the_whole_order(spark):
    random.seed(4)
    data = [(random.randrange(50), random.choice([None, "x", "y"]), f"wide text {random.randrange(3)}") for _ in range(2000)]
    df = spark.createDataFrame(data + [(7, "x", "copy")] * 700, "k long, a string, body string").repartition(7)
    out = indexing.row_index(df, [F.desc("k"), "a"])
    got = sorted(((r["row_index"], r["k"], r["a"], r["body"]) for r in out.collect()), key=lambda r: r[0])
    assert [r[0] for r in got] == list(range(2700))
    assert [r[1:3] for r in got] == sorted(((r[1], r[2]) for r in got), key=lambda r: (-r[0], r[1] is not None, r[1] or ""))
    assert sorted(map(str, (r[1:] for r in got))) == sorted(map(str, data + [(7, "x", "copy")] * 700))


def test_row_index_sorts_names_and_moves_rows_once(spark):
    df = spark.createDataFrame([(1, "body")], "k long, body string")
    plan = plan_of(indexing.sorted_names(indexing._named(df), ["k"]))
    ranges = next(line for line in plan.splitlines() if "rangepartitioning" in line)
    inside = plan[plan.index(ranges) :].splitlines()[1]
    assert "body#" not in inside.split("Project")[1].split("xxhash64")[0] and "Exchange" in ranges
    final = plan_of(indexing.row_index(df, ["k"]))
    assert sum("Exchange hashpartitioning(_h1" in x for x in final.splitlines()) == 2  # the rows, and their numbers
    assert "rangepartitioning" not in final


def test_row_index_in_stored_order(spark):
    got = indexing.row_index(spark.range(0, 1000, 1, 7)).orderBy("id").collect()
    assert [r["row_index"] for r in got] == list(range(1000))


def test_random_row_index(spark):
    got = indexing.random_row_index(hot(spark, 2000), seed=5, digits=2)
    assert sorted(r["row_index"] for r in got.collect()) == list(range(2000))


def test_manifest_totals(spark):
    chunked = indexing.assign_chunks(hot(spark, 2501), ["created_utc"], 2)
    got = ledger.manifest(chunked).orderBy("chunk").collect()
    assert [r["total_rows"] for r in got] == [*range(2, 2501, 2), 2501]
    assert got[1250]["chunk_name"] == "migration_base_part_1250"
    assert got[7]["chunk_name"] == "migration_base_part_007"


# --- dedup -----------------------------------------------------------------------------------


def test_other_scripts_do_not_collapse(spark):
    df = spark.createDataFrame([("1", "नमस्ते", 1), ("2", "धन्यवाद", 2), ("3", "नमस्ते", 3), ("4", None, 4), ("5", None, 5)], "id string, text string, created_utc long")
    assert rows(dedup.dedup_normalised(df), "id") == [("1",), ("2",), ("4",)]
    assert rows(dedup.dedup_normalised(df, ascii_strict=True), "id") == [("1",), ("4",)]


def test_dedup_is_idempotent(spark):
    df = hot(spark).withColumn("text", F.concat(F.lit("T "), F.col("subreddit")))
    once = dedup.two_lock_dedup(df)
    assert rows(dedup.two_lock_dedup(once), "id") == rows(once, "id")


def test_merge_lexicon(spark):
    s = "category string, term string, pos long"
    cached = spark.createDataFrame([("caste", "alpha", 0), ("caste", "beta", 1), ("caste", "beta", 2)], s)
    seeds = spark.createDataFrame([("CASTE", "beta", 0), ("CASTE", "abc", 1), ("CASTE", "gamma", 2)], s)
    got = dedup.merge_lexicon(cached, seeds).orderBy("pos").collect()
    assert [(r["category"], r["term"]) for r in got] == [("CASTE", t) for t in ("alpha", "beta", "gamma")]
    assert rows(dedup.merge_lexicon(cached, seeds, new_only=True)) == [("CASTE", "gamma", 0)]


# --- audit -----------------------------------------------------------------------------------


def flagged(spark, n_toxic, n_clean, **ones):
    data = [(f"t{i}", f"text t{i}", 1, *[int(ones.get(c, 0) > i) for c in FLAGS[1:]]) for i in range(n_toxic)]
    data += [(f"c{i}", f"text c{i}", 0, *[0] * 6) for i in range(n_clean)]
    return spark.createDataFrame(data, "id string, text string, " + ", ".join(f"{c} int" for c in FLAGS))


@pytest.mark.parametrize(
    "clean, caste, action", [(4, 1, 0), (4, 0, 2), (3, 1, 3), (3, 0, 2)]
)
def test_next_action(spark, clean, caste, action):
    df = flagged(spark, 2, clean, caste=caste, communal_religious=1, regional_xenophobic=1, misogyny_gender=1)
    status = audit.audit_status(df, audit.targets_from_goal(spark, 8))
    assert audit.next_action(status).first()[0] == action


def test_missing_flag_columns_count_as_zero(spark):
    df = flagged(spark, 2, 1).drop("caste", "discriminatory_hate_speech")
    got = {r["category"]: r["n"] for r in audit.category_breakdown(df).collect()}
    assert got["caste"] == 0 and got["profanity_vulgarity"] == 2
    assert audit.class_split(df.limit(0)).first()["toxic_pct"] is None


def test_priority_ties_go_to_target_order(spark):
    short = audit.shortfalls(flagged(spark, 1, 1), audit.targets_from_goal(spark, 80))
    assert audit.priority_category(short).first()["metric"] == "caste"
    met = audit.shortfalls(flagged(spark, 1, 1), audit.targets_from_goal(spark, 0))
    assert audit.priority_category(met).count() == 0


def test_token_usage_fallbacks(spark):
    usage = spark.createDataFrame([(10, 5), (30, None)], "prompt_tokens long, completion_tokens long")
    got = audit.token_usage(usage).first().asDict()
    assert got == {"prompt_tokens": 40, "completion_tokens": 5, "total_tokens": 45, "cache_hits": 0, "cache_misses": 40, "hit_rate": 0.0}


# --- lexicon ---------------------------------------------------------------------------------


def test_long_lexicons_are_matched_in_one_pass(spark):
    random.seed(3)
    words = ["".join(random.choices("abcd", k=4)) for _ in range(60)]
    terms = spark.createDataFrame([("c", w) for w in words], "category string, term string")
    texts = [" ".join(random.choices(words, k=6)) + random.choice("abcd") for _ in range(50)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    hits = lexicon.lexicon_hits(df, terms)
    assert plan_of(hits).count("Union") == 0
    got = rows(hits)
    assert got == sorted((i, "c", w) for i, t in enumerate(texts) for w in set(words) if w in t)


def test_lexicon_needs_no_join(spark):
    terms = spark.createDataFrame([("c", "Word")], "category string, term string")
    df = spark.createDataFrame([(1, "a WORD")], "id long, body string")
    hits = lexicon.lexicon_hits(df, terms)
    assert rows(hits) == [(1, "c", "word")]
    assert "Join" not in plan_of(hits)


# --- labelling -------------------------------------------------------------------------------

ITEM = '{"id": "%s", "analysis": "a", "pv": %s, "tah": 0, "dhs": 0, "cst": 0, "cr": 0, "rx": 0, "mg": 0}'
A, B = ITEM % ("1", 1), ITEM % ("2", 0)
SHAPES = {
    "object": ('{"results": [%s, %s]}' % (A, B), ["1", "2"]),
    "list": ("[%s, %s]" % (A, B), ["1", "2"]),
    "other key": ('{"n": 3, "labels": [%s, %s], "x": []}' % (A, B), ["1", "2"]),
    "empty results": ('{"results": [], "labels": [%s]}' % A, []),
    "fenced": ("```json\n{\"results\": [%s, %s]}\n```" % (A, B), ["1", "2"]),
    "plain fence": ("  ```\n[%s]```  " % A, ["1"]),
    "prose": ("Sure! Here: [%s, %s] Enjoy [1]." % (A, B), ["1", "2"]),
    "bracket in a bare list": ("Here: [%s] and [2]" % A.replace('"a"', '"x }] y"'), ["1"]),
    "truncated": ('{"results": [%s, %s' % (A, B[:20]), None),
    "nonsense": ("no", None),
    "number": ("12", None),
    "string": ('"[{}]"', None),
    "null": (None, None),
    "object without list": ('{"a": {"b": 1}}', None),
    "braces in text": ('{"results": [{"id": "1", "analysis": "x [y] {z}", "pv": 1}]}', ["1"]),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_parse_responses(spark, shape):
    text, want = SHAPES[shape]
    df = spark.createDataFrame([(text,)], "response string")
    got = labeling.parse_responses(df).select("results.id").first()[0]
    assert got == want


def parsed_batch(spark, ids, response, attempt=1):
    df = spark.createDataFrame([(0, attempt, ids, "q", response, None)], labeling.RESPONSES)
    return labeling.parse_responses(df)


def test_reattach(spark):
    swapped = parsed_batch(spark, ["1", "2"], f"[{B}, {A}]")
    assert rows(labeling.reattach_positional(swapped), "id", "pv") == [("1", "0"), ("2", "1")]
    assert rows(labeling.reattach_by_id(swapped), "id", "pv") == [("1", "1"), ("2", "0")]
    other = parsed_batch(spark, ["7", "8"], f"[{B}, {A}]")
    assert rows(labeling.reattach_by_id(other), "id", "pv") == [("7", "0"), ("8", "1")]


def test_short_batches_are_retried_then_dropped(spark):
    for attempt, left in ((1, [(2,)]), (4, [(5,)]), (5, [])):
        short = parsed_batch(spark, ["1", "2"], f"[{A}]", attempt)
        assert labeling.accepted(short).count() == 0
        assert rows(labeling.retry_queue(short), "attempt") == left


def test_coerce_flags(spark):
    df = spark.createDataFrame([("1", "1"), ("2", "1.0"), ("3", "true"), ("4", " 0 "), ("5", "no"), ("6", None), ("7", "FALSE")], "id string, pv string")
    got = labeling.coerce_flags(df, ["pv", "mg"])
    assert rows(got) == [("1", 1, 0), ("2", 1, 0), ("3", 1, 0), ("4", 0, 0), ("7", 0, 0)]


def test_invariants(spark):
    df = flagged(spark, 2, 1, caste=2, discriminatory_hate_speech=1)
    got = labeling.check_label_invariants(df).collect()
    assert [(r["id"], r["reasons"]) for r in got] == [("t1", ["discriminatory_hate_speech differs from its categories"])]


def test_requests_keep_order(spark):
    df = spark.createDataFrame([(0, 1, "b", "two"), (0, 0, "a", "one")], "batch long, pos long, id string, body_clean string")
    got = labeling.build_requests(df, "Label these {n} comments:").first()
    assert got["ids"] == ["a", "b"]
    assert got["request"] == "Label these 2 comments:\nID: a | Comment: one\nID: b | Comment: two"


def test_joins(spark):
    df = spark.createDataFrame([("1",), ("2",)], "id string")
    labels = spark.createDataFrame([("1", 1)], "id string, pv int")
    assert rows(joins.attach_labels(df, labels).na.fill(-1)) == [("1", 1), ("2", -1)]
    assert rows(joins.exclude_seen(df, labels.select("id"))) == [("2",)]
    with pytest.raises(ValueError):
        joins.attach_labels(df, labels, "outer")


# --- records ---------------------------------------------------------------------------------


def test_label_json_escapes(spark):
    df = spark.createDataFrame([("q\"\\\né/", *[0] * 6, 1), (None, *[0] * 7)], "analysis string, " + ", ".join(f"{c} int" for c in FLAGS))
    import json

    want = [json.dumps({**{c: 0 for c in FLAGS}, FLAGS[-1]: 1, "analysis": "q\"\\\né/"}, ensure_ascii=False), json.dumps({c: 0 for c in FLAGS})]
    assert [r["label_json"] for r in formatting.label_json(df).collect()] == want


def test_record_defaults(spark):
    df = flagged(spark, 1, 0).withColumn("body", F.lit("  raw text\n"))
    got = formatting.to_chatml(formatting.to_training_record(df), "sys").first()
    assert (got["text"], got["subreddit"], got["created_utc"], got["analysis"]) == ("raw text", "unknown", None, None)
    assert [m["role"] for m in got["messages"]] == ["system", "user", "assistant"]


def test_labeler_is_bounded_ordered_and_keeps_failures(spark):
    """At most three calls at a time; answers in the order of requests though later calls end first; a failing call costs its rows."""
    requests = spark.range(24).coalesce(1).selectExpr("id AS batch", "1 AS attempt", "array(string(id)) AS ids", "string(id) AS request")

    def slow(pdf):
        import threading
        import time

        state = slow.__dict__.setdefault("state", {"lock": threading.Lock(), "now": 0})
        with state["lock"]:
            state["now"] += 1
            seen = state["now"]
        first = int(pdf["batch"].iloc[0])
        time.sleep(0.05 if first % 3 == 0 else 0.005)
        with state["lock"]:
            state["now"] -= 1
        if first == 8:
            raise RuntimeError("no answer")
        return [f"{b}/{seen}" for b in pdf["batch"]][: 1 if first == 10 else None]

    got = labeling.run_labeler(requests, slow, threads=3, per_call=2).collect()
    assert [r["batch"] for r in got] == list(range(24))
    good = [r for r in got if r["error"] is None]
    assert [r["response"].split("/")[0] for r in good] == [str(i) for i in range(24) if i not in (8, 9, 10, 11)]
    assert max(int(r["response"].split("/")[1]) for r in good) in (2, 3)
    errors = {r["batch"]: r["error"] for r in got if r["error"]}
    assert errors == {8: "RuntimeError: no answer", 9: "RuntimeError: no answer"} | {i: "ValueError: 1 responses for 2 requests" for i in (10, 11)}
    saved = labeling.parse_responses(spark.createDataFrame(got))
    again = labeling.retry_queue(saved.filter("batch >= 8 AND batch < 12"))
    assert rows(again, "batch", "attempt") == [(i, 2) for i in (8, 9, 10, 11)] and again.columns == requests.columns


def test_rule_labels_follow_each_text(spark):
    df = spark.createDataFrame([("1", "a Bad one"), ("1", "fine"), (None, "bad"), ("2", None)], "id string, body string")
    terms = spark.createDataFrame([("caste", "bad")], "category string, term string")
    out = labeling.rule_labeler(df, terms)
    got = out.select("id", "body", "caste", "discriminatory_hate_speech").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("1", "a Bad one", 1, 1), ("1", "fine", 0, 0), (None, "bad", 1, 1), ("2", None, 0, 0)]))
    assert "Join" not in plan_of(out)


def test_every_turn_is_kept(spark):
    data = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(10)] + [(2, 0, "system", None)]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["block"]): [m["content"] for m in r["messages"]] for r in formatting.turns_to_chatml(turns, "p", 4).collect()}
    assert got == {(1, 0): ["p", "t0", "t1", "t2", "t3"], (1, 1): ["p", "t4", "t5", "t6", "t7"], (1, 2): ["p", "t8", "t9"], (2, 0): ["p", ""]}


def test_turn_pairs(spark):
    turns = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "last")], "conv_id long, turn long, role string, text string")
    got = formatting.pairs_to_chatml(turns, "p").collect()
    assert [(r["turn"], [m["content"] for m in r["messages"]]) for r in got] == [(1, ["p", "u", "a"])]


def test_fallback_ids_are_unique(spark):
    df = spark.range(500).select(F.lit("copy").alias("body"))
    got = indexing.fallback_ids(df)
    assert got.select("id").distinct().count() == 500


def test_limited_migration_lists_only_its_own_chunks(spark, tmp_path):
    """A later chunk that a broken run left incomplete is not listed by a run that ends before it."""
    table = spark.createDataFrame([(f"i{k}", f"text {k}", *[0] * len(FLAGS)) for k in range(6)], ["id", "body", *FLAGS])
    out, broken, state = (str(tmp_path / name) for name in ("out", "broken", "state"))
    migration.migrate(spark, table.where("id < 'i5'"), out, broken, "prompt", size=2)
    listed = migration.migrate(spark, table, out, state, "prompt", size=2, max_chunks=1)
    assert rows(listed, "chunk", "n_rows") == [(0, 2)]
    listed = migration.migrate(spark, table, out, state, "prompt", size=2)
    assert rows(listed, "chunk", "n_rows") == [(0, 2), (1, 2), (2, 2)]
    assert rows(spark.read.parquet(out), "id") == [(f"i{k}",) for k in range(6)]


def test_quota_extract_moves_keys_and_drawn_texts_only(spark, monkeypatch):
    """Below a join that shuffles, the draw sees no text; rows that share an id, or have none, are drawn like any other."""
    rows = [(str(i // 2) if i % 9 else None, f"{'the ' * (i % 3)}text {i}" if i % 7 else None, i * 40_000_000) for i in range(60)]
    df = spark.createDataFrame(rows, "id string, body string, created_utc long")
    tiers = spark.createDataFrame([(r[0], f"Tier {1 + i % 3}") for i, r in enumerate(rows[::2]) if r[0]] + [(None, "Tier 2")], "_k string, tier string").distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        pool = df.join(tiers, df["id"].eqNullSafe(tiers["_k"])).drop("_k")
        seen = []
        draw = sampling.draw_per_group
        monkeypatch.setattr(sampling, "draw_per_group", lambda d, *a, **k: seen.append(d.columns) or draw(d, *a, **k))
        quotas = {"Tier 1": 3, "Tier 2": 7, "Tier 3": 5}
        out = sampling.quota_extract(pool, ["the"], quotas)
        got = sorted(map(str, out.select(*pool.columns, "year").collect()))
        keys = sampling.year_month("created_utc")
        plain = pool.filter((F.col("tier") == "Tier 3") | F.lower("body").contains("the")).withColumn("year", F.substring(keys, 1, 4).cast("int"))
        ranked = draw(plain, ["tier"], 7, 42, "id", before=["year"]).collect()
        want = sorted(str(r[:-1]) for r in map(tuple, ranked) if r[-1] <= quotas[r[plain.columns.index("tier")]])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [str(tuple(r)) for r in sorted(out.select(*plain.columns).collect(), key=lambda r: str(tuple(r)))] == want
    assert len(got) == len(want) > 10
    assert seen == [["tier", "year", "id"]]
    below = plan_of(out).split("SortMergeJoin", 1)[1]
    assert " IN (" in below or "INSET" in below  # on the scan's side of the join


def test_tiers_are_joined_without_moving_the_comments(spark):
    df = spark.createDataFrame([("A", "x"), ("b", "y")], "subreddit string, body string")
    dim = spark.createDataFrame([("a", True, 2), ("A", True, 1), ("b", False, 1)], "subreddit string, enabled boolean, tier int")
    tagged = filters.tag_tier(df, dim)
    assert [tuple(r) for r in tagged.select("subreddit", "body", "tier").collect()] == [("a", "x", "Tier 1")]
    assert "Exchange hashpartitioning" not in plan_of(tagged)


def test_flags_need_no_text_above_the_joins(spark):
    from commentloom.catalog import views
    from conftest import SMALL

    plan = plan_of(views.labelled(spark, SMALL).select("id", "caste"))
    assert "body#" not in plan and "raw#" not in plan  # the text ends at the documents' scan


def test_scores_count_texts_in_the_pass_that_counts_words(spark):
    df = spark.createDataFrame([("aaa bbb", 1), ("aaa", 0), ("!!", 0), (None, 0), ("ccc", 1)], "text string, f int")
    counted = {r["word"]: r["df"] for r in lexicon._vocabulary(df, "f", "text").collect()}
    assert counted == {None: 4, "aaa": 2, "bbb": 1, "ccc": 1}
    assert {r["word"] for r in lexicon.tfidf_scores(df, "f", share=0.25).collect()} == {"bbb", "ccc"}


def test_a_migrated_chunk_is_one_file(spark, tmp_path, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    table = spark.range(60).selectExpr("concat('i', lpad(id, 2, '0')) AS id", "concat('text ', id) AS body", *[f"0 AS {c}" for c in FLAGS])
    twice = table.unionByName(table.where("id = 'i07'"))  # equal rows stay rows of their own
    migration.migrate(spark, twice.repartition(6), out, state, "prompt", size=8, max_chunks=2)
    listed = migration.migrate(spark, twice.repartition(6), out, state, "prompt", size=8)
    assert rows(listed, "chunk", "n_rows", "total_rows") == [(k, 8 if k < 7 else 5, min(8 * k + 8, 61)) for k in range(8)]
    got = spark.read.parquet(out)
    assert [r[0] for r in rows(got, "id")] == sorted([f"i{k:02d}" for k in range(60)] + ["i07"])
    assert rows(got.where("id = 'i07'"), "chunk_name") == [("migration_base_part_000",), ("migration_base_part_001",)]
    files = got.select("chunk_name", F.input_file_name().alias("f")).distinct()
    assert files.count() == 8
