"""Age buckets and movement status as plain ``when`` chains (JVM side, codegen'd)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output labels.
DEFAULT_EDGES: tuple[int, ...] = (90, 180, 365, 730)
DEFAULT_LABELS = ("1. 0-90 days", "2. 91-180 days", "3. 181-365 days", "4. 366-730 days", "5. Over 730 days")
DEAD_STOCK = "Dead Stock - Never Issued"
NON_MOVING = "Non-Moving - 12m+"
SLOW_MOVING = "Slow Moving - 6m+"
ACTIVE = "Active"
NON_MOVING_STATUSES = (NON_MOVING, DEAD_STOCK)
RECEIPT_TYPE, ISSUE_TYPE = 18, 33  # material transaction types: PO receipt, issue


def bucket_labels(edges: Sequence[int] = DEFAULT_EDGES) -> list[str]:
    """Labels for inclusive upper edges; the default edges give ``DEFAULT_LABELS``."""
    labels, lo = [], 0
    for i, hi in enumerate(edges, start=1):
        labels.append(f"{i}. {lo}-{hi} days")
        lo = hi + 1
    labels.append(f"{len(edges) + 1}. Over {edges[-1]} days")
    return labels


def age_bucket(days: Column, edges: Sequence[int] = DEFAULT_EDGES, unknown_label: str | None = None) -> Column:
    """Searched CASE over inclusive upper edges.

    ``days <= edges[0]`` falls in the first bucket (negative days too: a receipt after the
    as-of date). A NULL age (never received) falls in the last bucket, as the reference
    does, unless ``unknown_label`` names a bucket of its own.
    """
    if list(edges) != sorted(edges):
        raise ValueError("bucket edges must ascend")
    labels = bucket_labels(edges)
    expr = None
    for hi, label in zip(edges, labels):
        expr = F.when(days <= hi, label) if expr is None else expr.when(days <= hi, label)
    if unknown_label is not None:
        expr = expr.when(days.isNull(), unknown_label)
    return expr.otherwise(labels[-1])


def movement_status(
    issue_count: Column,
    days_since_issue: Column,
    non_moving_days: int = 365,
    slow_moving_days: int = 180,
) -> Column:
    """Ordered CASE: never issued -> Dead; older than a year -> Non-Moving; half a year -> Slow."""
    return (
        F.when(F.coalesce(issue_count, F.lit(0)) == 0, DEAD_STOCK)
        .when(days_since_issue > non_moving_days, NON_MOVING)
        .when(days_since_issue > slow_moving_days, SLOW_MOVING)
        .otherwise(ACTIVE)
    )
