"""Pinned schemas and label names."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw comment schema.
COMMENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("score", T.LongType()),
        T.StructField("controversiality", T.LongType()),
        T.StructField("collapsed_reason_code", T.StringType()),
    ]
)

# Short label keys and the column names they are published under.
SHORT_TO_LONG = {
    "pv": "profanity_vulgarity",
    "tah": "targeted_abuse_harassment",
    "dhs": "discriminatory_hate_speech",
    "cst": "caste",
    "cr": "communal_religious",
    "rx": "regional_xenophobic",
    "mg": "misogyny_gender",
}
SHORT_FLAGS = list(SHORT_TO_LONG)
FLAGS = list(SHORT_TO_LONG.values())
CORE_FLAGS = FLAGS[:3]
CATEGORY_FLAGS = FLAGS[3:]

# Bodies that mean "this comment is gone".
TOMBSTONES = ("[deleted]", "[removed]", "")

# Label items as parsed from a response.  Flags stay strings until they are coerced.
LABEL_ITEM = T.StructType(
    [T.StructField("id", T.StringType()), T.StructField("analysis", T.StringType())]
    + [T.StructField(name, T.StringType()) for name in SHORT_FLAGS]
)

MESSAGES = T.ArrayType(
    T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
)

LABELLED = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("created_utc", T.LongType()),
        T.StructField("year_month", T.StringType()),
    ]
    + [T.StructField(name, T.IntegerType()) for name in FLAGS]
    + [T.StructField("analysis", T.StringType()), T.StructField("messages", MESSAGES)]
)
