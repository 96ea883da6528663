"""Column functions on hand-made rows: bucket edges, movement status, money, periods."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparesledger.functions import (
    ACTIVE, DEAD_STOCK, NON_MOVING, SLOW_MOVING, age_bucket, bucket_labels, div_round, in_millions,
    movement_status, period_name, period_start,
)


def test_bucket_labels_default():
    from sparesledger.functions.aging import DEFAULT_LABELS

    assert tuple(bucket_labels()) == DEFAULT_LABELS


def test_age_bucket_edges_inclusive(spark):
    days = [-5, 0, 90, 91, 180, 181, 365, 366, 730, 731, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = dict(df.select("d", age_bucket(F.col("d")).alias("b")).collect())
    assert got[-5] == got[0] == got[90] == "1. 0-90 days"
    assert got[91] == got[180] == "2. 91-180 days"
    assert got[181] == got[365] == "3. 181-365 days"
    assert got[366] == got[730] == "4. 366-730 days"
    assert got[731] == "5. Over 730 days"
    assert got[None] == "5. Over 730 days"  # never received falls in the last bucket


def test_age_bucket_unknown_label(spark):
    df = spark.createDataFrame([(None,), (10,)], "d int")
    got = dict(df.select("d", age_bucket(F.col("d"), (30, 60), "never").alias("b")).collect())
    assert got[None] == "never" and got[10] == "1. 0-30 days"


def test_movement_status_order(spark):
    rows = [(0, None), (None, None), (0, 10), (3, 181), (3, 180), (3, 365), (3, 366), (1, -4)]
    df = spark.createDataFrame(rows, "n long, d int")
    got = [r.s for r in df.select(movement_status(F.col("n"), F.col("d")).alias("s")).collect()]
    assert got == [DEAD_STOCK, DEAD_STOCK, DEAD_STOCK, SLOW_MOVING, ACTIVE, SLOW_MOVING, NON_MOVING, ACTIVE]


def test_period_roundtrip(spark):
    df = spark.createDataFrame([(dt.date(2026, 3, 14),)], "d date")
    r = df.select(period_name(F.col("d")).alias("p")).select("p", period_start(F.col("p")).alias("s")).first()
    assert r.p == "MAR-26" and r.s == dt.date(2026, 3, 1)
    # yy is always 20yy
    assert spark.range(1).select(period_start(F.lit("JAN-95")).alias("s")).first().s == dt.date(2095, 1, 1)
    # an adjustment period is not a calendar month: NULL, not a failed query
    assert spark.range(1).select(period_start(F.lit("ADJ-25")).alias("s")).first().s is None


def _exact(n: int, d: int, digits: int) -> Decimal | None:
    if d == 0:
        return None
    q = Decimal(n) / Decimal(d)
    return q.quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)


@settings(max_examples=1, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6)), min_size=50, max_size=200))
def test_div_round_is_exact_half_up(spark, pairs):
    """Property: div_round equals exact HALF_UP rounding of the rational quotient."""
    pairs = pairs + [(1, 8), (-1, 8), (5, 2), (-5, 2), (2325, 10000), (1, 0)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", div_round(F.col("n") * 1, F.col("d"), 3, "decimal(15,0)", "decimal(14,0)").alias("q"))
    for r in got.collect():
        with_ctx = _exact(r.n, r.d, 3)
        assert r.q == with_ctx, (r.n, r.d, r.q, with_ctx)


def test_in_millions_rounds_decimal(spark):
    df = spark.createDataFrame([("1250000.00",), ("1249999.99",), ("-1250000.00",)], "v string")
    got = [r.m for r in df.select(in_millions(F.col("v").cast("decimal(18,2)"), 1).alias("m")).collect()]
    assert got == [Decimal("1.3"), Decimal("1.2"), Decimal("-1.3")]


@settings(max_examples=3, deadline=None)
@given(
    st.lists(st.integers(1, 3000), min_size=1, max_size=6, unique=True).map(sorted),
    st.lists(st.one_of(st.none(), st.integers(-100, 4000)), min_size=20, max_size=100),
)
def test_bucket_partition_property(spark, edges, days):
    """Property: each age falls in exactly the bucket its edges imply; NULL in the last one."""
    labels = bucket_labels(edges)
    df = spark.createDataFrame([(d,) for d in days], "d int")
    for r in df.select("d", age_bucket(F.col("d"), edges).alias("b")).collect():
        if r.d is None:
            expected = labels[-1]
        else:
            expected = next((lab for e, lab in zip(edges, labels) if r.d <= e), labels[-1])
        assert r.b == expected


def test_bucket_totals_equal_table_totals(spark):
    from sparesledger.operators import reports
    from sparesledger.plans.model import FIXTURE_AS_OF, Model

    g = Model.from_fixtures(spark, "/root/testdata/sf0.001", as_of=FIXTURE_AS_OF).stores_aging
    b = reports.aging_by_bucket(g).agg(F.sum("stock_lines").alias("n"), F.sum("dead_stock_lines").alias("d")).first()
    t = g.agg(F.count("*").alias("n"), F.count_if(F.col("movement_status") == DEAD_STOCK).alias("d")).first()
    assert (b.n, b.d) == (t.n, t.d)
