"""Audit a published table and decide what to do next."""

from __future__ import annotations

from pyspark.sql import DataFrame

from commentloom.operators import audit


def review(labelled: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The audit table over unique rows, and the next action (0, 2 or 3) as one row."""
    status = audit.audit_status(labelled, targets, "two_lock")
    return status, audit.next_action(status)
