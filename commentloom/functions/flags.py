"""Expressions over label flags and epochs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commentloom.schemas import CORE_FLAGS


def toxic(flags=CORE_FLAGS) -> Column:
    """True where the largest core flag is 1; nulls are ignored, all-null is not toxic."""
    return F.coalesce(F.greatest(*[F.col(c) for c in flags]) == 1, F.lit(False))


def year_month(epoch) -> Column:
    """``YYYY-MM`` in UTC.  Goes through a date, so the session time zone plays no part."""
    c = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.date_format(F.date_from_unix_date(F.floor(c / F.lit(86400)).cast("int")), "yyyy-MM")


def pct(part: Column, total: Column) -> Column:
    """Percentage with four decimals; null for an empty total."""
    return F.round(F.try_divide(part * F.lit(100.0), total), 4)


def sample_rank(id_col: str, seed) -> Column:
    """The order every sample uses: the same on any engine and under any partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))
