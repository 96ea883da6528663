"""Gold ageing semantics on hand-made rows (edge table of SURVEY §7.3, S1-S11)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from sparesledger.functions import ACTIVE, DEAD_STOCK, NON_MOVING, SLOW_MOVING
from sparesledger.operators import aging, checks, reports

AS_OF = dt.date(2026, 6, 30)


def d(days: int) -> dt.date:
    return AS_OF - dt.timedelta(days=days)


ITEM_SCHEMA = ("inventory_item_id long, org_id long, item_number string, item_description string, "
               "category_code string, category_name string, uom string, lead_time_days int, org_code string, "
               "region string, business_line string")
TXN_SCHEMA = "inventory_item_id long, org_id long, txn_type_id int, txn_date date, primary_quantity decimal(18,2), vendor_id long"


def _item(item, org, code="GCI", cat="BEARINGS"):
    return (item, org, f"ITM-{item}", f"part {item}", cat, cat, "EA", 7, code, "NORTH", "Grey Cement")


@pytest.fixture(scope="module")
def frames(spark):
    items = spark.createDataFrame([
        _item(1, 1), _item(2, 1), _item(2, 2, "WCI"), _item(3, 1), _item(4, 1), _item(5, 1),
        _item(6, 1), _item(7, 1), _item(8, 1), _item(9, 1),
    ], ITEM_SCHEMA)
    onhand = spark.createDataFrame([
        (i, o, Decimal(q)) for i, o, q in
        [(1, 1, "10"), (2, 1, "4"), (2, 2, "4"), (3, 1, "5"), (3, 1, "7"), (5, 1, "1"), (6, 1, "3"),
         (7, 1, "2"), (8, 1, "1"), (9, 1, "1")]
    ], "INVENTORY_ITEM_ID long, ORGANIZATION_ID long, PRIMARY_TRANSACTION_QUANTITY decimal(18,2)")
    costs = spark.createDataFrame([
        (i, o, Decimal(a), Decimal(b)) for i, o, a, b in
        [(1, 1, "100.00", "120.00"), (2, 1, "10.00", "10.00"), (2, 2, "10.00", "11.00"), (3, 1, "0.00", "5.00"),
         (4, 1, "1.00", "1.00"), (6, 1, "2.00", "2.00"), (7, 1, "1.00", "1.00"), (8, 1, "1.00", "1.00"),
         (9, 1, "1.00", "1.00")]
    ], "INVENTORY_ITEM_ID long, ORGANIZATION_ID long, ITEM_COST decimal(18,2), LAST_PO_COST decimal(18,2)")
    txn = spark.createDataFrame([
        (1, 1, 18, d(90), Decimal("10"), 101), (1, 1, 18, dt.date(2025, 6, 30), Decimal("5"), 102),
        (1, 1, 33, d(181), Decimal("-6"), None),
        (2, 2, 18, d(91), Decimal("3"), 101), (2, 2, 33, d(366), Decimal("-1"), None),
        (6, 1, 18, AS_OF, Decimal("3"), 101), (6, 1, 18, AS_OF + dt.timedelta(days=10), Decimal("1"), 101),
        (7, 1, 99, d(5), Decimal("9"), 101),
        (8, 1, 18, d(365), Decimal("1"), 101), (8, 1, 33, d(365), Decimal("-1"), None),
        (9, 1, 18, d(731), Decimal("1"), 101), (9, 1, 33, d(180), Decimal("-1"), None),
    ], TXN_SCHEMA)
    return items, onhand, costs, txn


@pytest.fixture(scope="module")
def gold(frames):
    items, onhand, costs, txn = frames
    g = aging.stores_aging(items, onhand, costs, txn, as_of=AS_OF)
    return {(r.item_number, r.org_id): r for r in g.collect()}


def test_grain_and_inner_joins(gold):
    # S8: no on-hand (item 4) or no cost (item 5) -> gone; no transactions (item 2 @ 1) -> stays
    assert set(gold) == {("ITM-1", 1), ("ITM-2", 1), ("ITM-2", 2), ("ITM-3", 1), ("ITM-6", 1), ("ITM-7", 1),
                         ("ITM-8", 1), ("ITM-9", 1)}
    # S9: two on-hand rows are summed into one line
    assert gold[("ITM-3", 1)].onhand_qty == Decimal("12.00")


def test_full_row(gold):
    r = gold[("ITM-1", 1)]
    assert (r.onhand_value_avg_cost, r.onhand_value_last_cost) == (Decimal("1000.00"), Decimal("1200.00"))
    assert r.cost_variance_pct == Decimal("20.00") and r.revaluation_exposure == Decimal("200.00")
    assert r.days_since_receipt == 90 and r.aging_bucket_last_receipt == "1. 0-90 days"
    assert r.days_since_first_receipt == 365 and r.aging_bucket_first_receipt == "3. 181-365 days"
    assert r.days_since_issue == 181 and r.movement_status == SLOW_MOVING
    assert (r.issue_txn_count, r.receipt_txn_count, r.distinct_suppliers) == (1, 2, 2)
    # 12 whole months (both month ends): 6 consumed -> 0.5 a month -> 10 on hand covers 20 months
    assert r.avg_monthly_consumption == Decimal("0.500") and r.months_of_cover == Decimal("20.0")


def test_never_received_is_dead_and_oldest(gold):
    r = gold[("ITM-2", 1)]  # S1, S2
    assert r.days_since_receipt is None and r.aging_bucket_last_receipt == "5. Over 730 days"
    assert r.movement_status == DEAD_STOCK and r.issue_txn_count is None
    # S10/S13: carried in two plants by the master, never issued here -> candidate
    assert r.stocked_in_orgs == 2 and r.stocked_org_list == ["GCI", "WCI"] and r.redistribution_candidate


def test_non_moving_and_edges(gold):
    assert gold[("ITM-2", 2)].movement_status == NON_MOVING  # 366 days
    assert gold[("ITM-2", 2)].aging_bucket_last_receipt == "2. 91-180 days"
    assert gold[("ITM-8", 1)].movement_status == SLOW_MOVING  # exactly 365: not > 365
    assert gold[("ITM-8", 1)].aging_bucket_last_receipt == "3. 181-365 days"
    assert gold[("ITM-9", 1)].movement_status == ACTIVE  # exactly 180
    assert gold[("ITM-9", 1)].aging_bucket_last_receipt == "5. Over 730 days"


def test_zero_cost_gives_null_variance(gold):
    assert gold[("ITM-3", 1)].cost_variance_pct is None  # S6


def test_receipt_on_and_after_as_of(gold):
    r = gold[("ITM-6", 1)]  # S3, S7
    assert r.days_since_receipt == -10 and r.aging_bucket_last_receipt == "1. 0-90 days"
    assert r.days_since_first_receipt == 0
    assert r.avg_monthly_consumption is None and r.months_of_cover is None


def test_other_transaction_types_ignored(gold):
    r = gold[("ITM-7", 1)]  # S5
    assert r.receipt_txn_count == 0 and r.issue_txn_count == 0 and r.last_receipt_date is None
    assert r.movement_status == DEAD_STOCK


def test_cutoff_option_drops_future_transactions(frames):
    items, onhand, costs, txn = frames
    g = aging.stores_aging(items, onhand, costs, txn, as_of=AS_OF, cutoff=True)
    r = g.filter("item_number = 'ITM-6'").first()
    assert r.days_since_receipt == 0 and r.receipt_txn_count == 1


def test_redundancy_basis_onhand(frames):
    items, onhand, costs, txn = frames
    master = {r.item_number: r.stocked_in_orgs for r in aging.redundancy(items).collect()}
    stock = {r.item_number: r.stocked_in_orgs for r in aging.redundancy(items, onhand, "onhand").collect()}
    assert master["ITM-4"] == 1 and "ITM-4" not in stock and stock["ITM-2"] == 2


def test_reports_on_hand_rows(spark, frames):
    items, onhand, costs, txn = frames
    g = aging.stores_aging(items, onhand, costs, txn, as_of=AS_OF)
    buckets = {r.aging_bucket: r for r in reports.aging_by_bucket(g).collect()}
    assert sum(r.stock_lines for r in buckets.values()) == 8  # every row in exactly one bucket
    # never received (ITM-2 here, ITM-3, ITM-7 with only other types) are dead and oldest
    assert buckets["5. Over 730 days"].dead_stock_lines == 3
    # zero-cost item (NULL variance) never passes the threshold
    cats = reports.procurement_list(g, 15).collect()
    assert len(cats) == 1 and cats[0]["items"] == 1 and cats[0].avg_variance_pct == Decimal("20.0")
    # ITM-2 is dead in GCI and Non-Moving in WCI: not "active elsewhere"
    assert reports.redistribution_list(g).count() == 0
    assert checks.check_grain(g).count() == 0


def test_stock_summary_vocabulary(frames):
    items, onhand, costs, txn = frames
    g = aging.stores_aging(items, onhand, costs, txn, as_of=AS_OF)
    # "site" means the plant code; "replacement cost" the last-PO value; "dead stock" the status
    rows = reports.stock_summary(g, by=("site",), where="dead stock", measure="replacement cost",
                                 scale_digits=4).collect()
    assert [r.org_code for r in rows] == ["GCI"]  # only GCI holds dead lines in the hand-made rows
    dead_last_value = sum(r.onhand_value_last_cost for r in g.filter(f"movement_status = '{DEAD_STOCK}'").collect())
    assert rows[0].value_pkr_mn == (dead_last_value / Decimal(1_000_000)).quantize(Decimal("0.0001"))
    assert rows[0].item_lines == 4  # ITM-2, ITM-3, ITM-6 (received, never issued), ITM-7
    with pytest.raises(ValueError):
        reports.stock_summary(g, where="slow-ish")


def test_large_quantities_do_not_overflow(spark):
    """Any DECIMAL(18,2) quantity works: 5e10 on hand, first received 16 years before as-of."""
    items = spark.createDataFrame([_item(1, 1)], ITEM_SCHEMA)
    onhand = spark.createDataFrame([(1, 1, Decimal("50000000000.00"))],
                                   "INVENTORY_ITEM_ID long, ORGANIZATION_ID long, PRIMARY_TRANSACTION_QUANTITY decimal(18,2)")
    costs = spark.createDataFrame([(1, 1, Decimal("1.00"), Decimal("1.10"))],
                                  "INVENTORY_ITEM_ID long, ORGANIZATION_ID long, ITEM_COST decimal(18,2), LAST_PO_COST decimal(18,2)")
    txn = spark.createDataFrame([
        (1, 1, 18, dt.date(2010, 6, 30), Decimal("9000000000000000.00"), 1),
        (1, 1, 33, dt.date(2020, 6, 30), Decimal("-3.00"), None),
    ], TXN_SCHEMA)
    r = aging.stores_aging(items, onhand, costs, txn, as_of=AS_OF).first()
    # 16 whole months-ends apart: 192 months; 3 consumed -> 0.016 a month; cover 5e10 * 192 / 3
    assert r.avg_monthly_consumption == Decimal("0.016")
    assert r.months_of_cover == Decimal("3200000000000.0")
    assert r.cost_variance_pct == Decimal("10.00")


def test_summary_rejects_non_money_measures(frames):
    items, onhand, costs, txn = frames
    g = aging.stores_aging(items, onhand, costs, txn, as_of=AS_OF)
    for bad in ("age", "plant"):
        with pytest.raises(ValueError):
            reports.stock_summary(g, measure=bad)
