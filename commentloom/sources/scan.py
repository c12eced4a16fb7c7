"""Readers with pinned schemas."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commentloom.schemas import COMMENTS


def scan_shards(
    spark: SparkSession,
    paths: list[str],
    columns: list[str] | None = None,
    schema: T.StructType = COMMENTS,
) -> DataFrame:
    """Read an explicit file list; only ``columns`` reach the scan."""
    df = spark.read.schema(schema).parquet(*paths)
    return df.select(*columns) if columns else df


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> list[str]:
    """Paths under ``root`` whose file name matches, from the file listing alone."""
    reader = spark.read.schema("_ string").option("pathGlobFilter", glob)
    return sorted(reader.option("recursiveFileLookup", "true").parquet(root).inputFiles())


def select_shards(paths: list[str], root: str, years: list[int], n: int, seed=42) -> list[str]:
    """At most ``n`` of the files whose path carries one of the years, by a seeded draw.

    A year may stand alone or with its month, as in ``2017``, ``2017-01`` or ``201701``.
    The draw hashes the path below ``root``, so a copy of the archive gives the same shards.
    Works on the listing: unselected files are never opened.
    """
    wanted = re.compile("(^|[^0-9])(" + "|".join(str(y) for y in years) + ")(0[1-9]|1[0-2])?([^0-9]|$)")

    def below(path: str) -> str:
        return path.split(root.rstrip("/"), 1)[-1].lstrip("/")

    named = [(below(p), p) for p in paths if wanted.search(below(p))]
    drawn = sorted(named, key=lambda s: (hashlib.md5(f"{seed}|{s[0]}".encode()).hexdigest(), s))
    return sorted(path for _, path in drawn[:n])


def scan_epoch_range(
    spark: SparkSession,
    root: str,
    lo: int,
    hi: int,
    columns: list[str] = ("body", "subreddit", "created_utc"),
    schema: T.StructType = COMMENTS,
) -> DataFrame:
    """Finished ``train*`` files only; epoch range and columns are pushed into parquet."""
    df = spark.read.schema(schema).option("pathGlobFilter", "train*.parquet").parquet(root)
    return df.filter(F.col("created_utc").between(lo, hi)).select(*columns)


STAGING_GLOB = "*tmp_batch_*"


def read_staging(
    spark: SparkSession, root: str, schema: T.StructType = COMMENTS, glob: str = STAGING_GLOB
) -> DataFrame:
    return spark.read.schema(schema).option("pathGlobFilter", glob).parquet(root)


def conform(df: DataFrame, schema: T.StructType = COMMENTS) -> DataFrame:
    """Exactly the schema's columns and types; bad values and missing columns are typed nulls."""
    present = set(df.columns)
    return df.select(
        *[
            (
                F.col(f.name).try_cast(f.dataType)
                if f.name in present
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


_PAGE = T.StructType([T.StructField("data", T.ArrayType(COMMENTS))])


def parse_pages(pages: DataFrame, json_col: str = "page", requested: str = "subreddit") -> DataFrame:
    """Landed result pages to comment rows, under the name that was asked for."""
    comment = F.explode(F.from_json(json_col, _PAGE)["data"])
    fields = [
        F.col(requested) if f.name == "subreddit" else F.col(f"_c.{f.name}").alias(f.name)
        for f in COMMENTS.fields
    ]
    return pages.select(requested, comment.alias("_c")).select(*fields)


def read_comment_csv(
    spark: SparkSession, path: str, text_col: str | None = None, out: str = "body"
) -> DataFrame:
    """Header CSV as strings; the text column, by default the first, is named ``body``.

    Empty fields, quoted or not, are null.
    """
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', nullValue="")
    name = text_col or df.columns[0]
    return df if name == out else df.withColumnRenamed(name, out)
