"""Readers, writers and streams.  Written tables go to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from commentloom.catalog import views as v
from commentloom.catalog.registry import query
from commentloom.catalog.report_queries import _SHORT, _STATUS, _TARGETS, counts_sql, targets
from commentloom.catalog.row_queries import C, L, MONTH, twice, with_refetch
from commentloom.functions.flags import year_month
from commentloom.operators.indexing import random_row_index
from commentloom.schemas import COMMENTS
from commentloom.session import scratch_path
from commentloom.sources import config, scan, sinks
from commentloom.streaming import ingest

_ALL = ", ".join(f.name for f in COMMENTS.fields)


@query("s1_scan_shards", "SELECT doc_id, source, n_chars FROM documents")
def _(spark, sf):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    path = f"{sf.rstrip('/')}/documents.parquet"
    return scan.scan_shards(spark, [path], ["doc_id", "source", "n_chars"], schema)


@query(
    "s2_select_shards",
    f"{C} SELECT id, subreddit FROM comments WHERE left({MONTH}, 4) IN ('1996', '1998')",
)
def _(spark, sf):
    root = scratch_path(spark, "archive")
    year = F.substring(year_month("created_utc"), 1, 4)
    v.comments(spark, sf).withColumn("year", year).write.partitionBy("year").parquet(root)
    files = scan.list_files(spark, root)
    shards = scan.select_shards(files, root, [1996, 1998], len(files))
    return scan.scan_shards(spark, shards, ["id", "subreddit"])


def landed(spark, sf):
    """A folder with main files and staging files side by side."""
    root = scratch_path(spark, "landed")
    rows = v.comments(spark, sf)
    for name in ("train-old", "tmp_batch_a"):
        rows.write.mode("append").option("mapreduce.output.basename", name).parquet(root)
    return root


@query(
    "s3_scan_epoch_range",
    f"{C} SELECT body, subreddit, created_utc FROM comments"
    " WHERE created_utc BETWEEN 820454400 AND 915148799",
)
def _(spark, sf):
    return scan.scan_epoch_range(spark, landed(spark, sf), 820454400, 915148799)


@query("s4_read_staging", f"{C} SELECT {_ALL} FROM comments")
def _(spark, sf):
    return scan.read_staging(spark, landed(spark, sf))


@query(
    "s5_conform",
    f"{C} SELECT id, body, created_utc, subreddit, try_cast(CASE WHEN score < 0 THEN 'bad' ELSE"
    " CAST(score AS VARCHAR) END AS BIGINT) AS score, controversiality, collapsed_reason_code"
    " FROM (SELECT * REPLACE (CAST(NULL AS BIGINT) AS controversiality) FROM comments)",
)
def _(spark, sf):
    score = F.when(F.col("score") < 0, "bad").otherwise(F.col("score").cast("string"))
    rows = v.comments(spark, sf).drop("controversiality", "collapsed_reason_code")
    return scan.conform(rows.withColumn("score", score).withColumn("extra", F.lit(1)))


@query(
    "s6_parse_pages",
    f"{C} SELECT id, body, created_utc, concat('asked_', lower(subreddit)) AS subreddit, score,"
    " controversiality, collapsed_reason_code FROM comments",
)
def _(spark, sf):
    rows = random_row_index(v.comments(spark, sf), out="i")
    asked = F.concat(F.lit("asked_"), F.lower("subreddit")).alias("asked")
    item = F.struct(*COMMENTS.fieldNames()).alias("c")
    cut = F.floor(F.col("i") / 100).alias("cut")  # a page holds at most 100 comments
    pages = rows.select(asked, cut, item).groupBy("asked", "cut")
    page = F.to_json(F.struct(F.collect_list("c").alias("data")))
    landed_pages = pages.agg(page.alias("page")).select(F.col("asked").alias("subreddit"), "page")
    return scan.parse_pages(landed_pages)


@query("s7_read_comment_csv", f"{C} SELECT id, nullif(body, '') AS body, subreddit, created_utc FROM comments")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(v.comments(spark, sf).select("body", "id", "subreddit", "created_utc"), path)
    df = scan.read_comment_csv(spark, path)
    return df.withColumn("created_utc", F.col("created_utc").cast("long"))


@query("s8_write_csv", f"{C} SELECT id, nullif(body, '') AS body FROM comments")
def _(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(v.comments(spark, sf).select("id", "body"), path)
    return scan.read_comment_csv(spark, path, "body")


@query("s9_write_chunks", f"{C} SELECT {_ALL} FROM comments")
def _(spark, sf):
    path = scratch_path(spark, "chunks")
    sinks.write_chunks(v.comments(spark, sf), path, 100, "worker_1996")
    files = scan.list_files(spark, path, "worker_1996*")
    return scan.scan_shards(spark, files)


@query(
    "s11_append_slices",
    f"{C} SELECT {_ALL} FROM comments UNION ALL SELECT {_ALL} FROM comments",
)
def _(spark, sf):
    path = scratch_path(spark, "main")
    for _slice in range(2):
        sinks.append_slices(v.comments(spark, sf), path)
    return spark.read.schema(COMMENTS).option("pathGlobFilter", "train_append*").parquet(path)


@query("s12_consolidate", f"{C} SELECT id, body, created_utc FROM comments")
def _(spark, sf):
    staging, main = scratch_path(spark, "staging"), scratch_path(spark, "main")
    rows = v.comments(spark, sf)
    sinks.append_slices(rows.filter("subreddit = lower(subreddit)"), main)
    fetched = twice(spark, sf)
    fetched.write.option("mapreduce.output.basename", "tmp_batch_x").parquet(staging)
    sinks.consolidate(spark, staging, main, against_main=True)
    return spark.read.schema(COMMENTS).parquet(main).select("id", "body", "created_utc")


@query("s13_load_subreddit_dim", f"WITH {v.DIM} SELECT * FROM dim")
def _(spark, sf):
    path = scratch_path(spark, "config")
    v.config_docs(spark, sf).write.option("maxRecordsPerFile", 1).text(path)
    return config.load_subreddit_dim(spark, path, v.CORE)


@query(
    "s14_load_stopwords",
    f"WITH {v.LINES} SELECT DISTINCT lower(trim(text, ' ' || chr(9))) AS word FROM comment_lines"
    " WHERE trim(text, ' ' || chr(9)) <> ''",
)
def _(spark, sf):
    path = scratch_path(spark, "words")
    v.comment_lines(spark, sf).select("text").write.text(path)
    return config.load_stopwords(spark, path)


# --- streams ---------------------------------------------------------------------------------


@query(
    "r1_stream_ingest",
    f"{C} SELECT id, body, created_utc, {MONTH} AS year_month FROM comments WHERE {v.KEPT}",
)
def _(spark, sf):
    landing, main = scratch_path(spark, "landing"), scratch_path(spark, "main")
    state = scratch_path(spark, "stream")
    rows = v.comments(spark, sf)
    for refetch in (False, True):  # the second brings every id again
        arrival = with_refetch(rows.filter(v.KEPT)) if refetch else rows
        arrival.write.mode("append").option("mapreduce.output.basename", "tmp_batch_m").parquet(
            landing
        )
        ingest.stream_ingest(spark, landing, main, state).awaitTermination()
        rows = spark.read.schema(rows.schema).parquet(landing)  # as landed, without the joins anew
    return spark.read.schema("id string, body string, created_utc long, year_month string").parquet(
        main
    )


@query(
    "r1_stream_ingest_other_months",
    f"{C} SELECT id, {MONTH} AS year_month FROM comments WHERE {v.KEPT}",
)
def _(spark, sf):
    """The second arrival has later copies only, in other months; the first ones stay."""
    landing, main = scratch_path(spark, "landing"), scratch_path(spark, "main")
    state = scratch_path(spark, "stream")
    rows = v.comments(spark, sf)
    for days in (0, 40):
        rows.withColumn("created_utc", F.col("created_utc") + days * 86400).write.mode("append").option(
            "mapreduce.output.basename", "tmp_batch_m"
        ).parquet(landing)
        ingest.stream_ingest(spark, landing, main, state).awaitTermination()
        rows = spark.read.schema(rows.schema).parquet(landing)  # as landed, without the joins anew
    return spark.read.schema("id string, year_month string").parquet(main)


@query(
    "r2_stream_windowed_counts",
    "SELECT window_start, event_type, n FROM (SELECT CAST(epoch(date_trunc('day', ts)) AS BIGINT)"
    " AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2) WHERE"
    " window_start + 86400 <= (SELECT epoch(max(ts)) - 86400 FROM events)",
)
def _(spark, sf):
    out, state = scratch_path(spark, "counts"), scratch_path(spark, "stream")
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string"
    events = ingest.read_landing(spark, sf, "events.parquet", schema)
    micros = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")
    rows = events.select(F.timestamp_micros(micros).alias("ts"), "event_type")
    counts = ingest.windowed_counts(rows, by="event_type")
    ingest.stream_counts(counts, out, state).awaitTermination()
    return spark.read.schema("window_start long, event_type string, n long").parquet(out)


@query(
    "r3_stream_label_audit",
    f"{L}, {_TARGETS}, {counts_sql('labelled')}, short AS ({_SHORT}) {_STATUS}",
)
def _(spark, sf):
    landing, totals = scratch_path(spark, "landing"), scratch_path(spark, "totals")
    labelled = v.labelled(spark, sf)
    labelled.repartition(4, "id").write.parquet(landing)
    stream = ingest.read_landing(spark, landing, "*.parquet", labelled.schema, 1)
    ingest.stream_label_audit(stream, totals, scratch_path(spark, "stream")).awaitTermination()
    return ingest.running_audit(spark, totals, targets(spark))
