"""Reusable column expressions: buckets, movement status, periods, exact money arithmetic."""

from sparesledger.functions.aging import (
    ACTIVE,
    DEAD_STOCK,
    DEFAULT_EDGES,
    NON_MOVING,
    NON_MOVING_STATUSES,
    SLOW_MOVING,
    age_bucket,
    bucket_labels,
    movement_status,
)
from sparesledger.functions.money import avg_round, div_round, in_millions, to_money
from sparesledger.functions.periods import period_name, period_start, shift_years

__all__ = [
    "ACTIVE", "DEAD_STOCK", "DEFAULT_EDGES", "NON_MOVING", "NON_MOVING_STATUSES", "SLOW_MOVING",
    "age_bucket", "avg_round", "bucket_labels", "div_round", "in_millions", "movement_status",
    "period_name", "period_start", "shift_years", "to_money",
]
