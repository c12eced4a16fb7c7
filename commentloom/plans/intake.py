"""From landed result pages to the main table, with an outcome per unit."""

from __future__ import annotations

from pyspark.sql import DataFrame

from commentloom.operators import audit, dedup, filters
from commentloom.session import materialize
from commentloom.sources.scan import conform, parse_pages
from commentloom.sources.sinks import append_slices


def kept_comments(pages: DataFrame, units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Raw and kept comments of the planned units."""
    raw = materialize(filters.assign_to_units(parse_pages(pages), units), "raw")  # pages are parsed once
    return raw, dedup.cross_slice_dedup(filters.drop_tombstones(raw))


def intake(pages: DataFrame, units: DataFrame, main: str) -> DataFrame:
    """Append the kept comments and return the outcome table.  Empty units are no error."""
    raw, kept = kept_comments(pages, units)
    append_slices(conform(kept), main)
    return audit.fetch_outcome(raw, kept, units)
