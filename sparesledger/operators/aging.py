"""Gold ageing table: one row per item per plant.

Plan shape (``stores_aging(...).explain()``):

* ``txn_profile`` is the only heavy step: one grouped conditional aggregation over the
  transaction fact. Spark's single-distinct plan pre-aggregates map-side on
  (item, plant, vendor), shuffles those partial rows, then merges on (item, plant) -- a hot
  item/plant is reduced map-side before it moves, so skew does not reach one task.
* ``redundancy`` aggregates the item master by item number in one shuffle (map-side
  partial sets, bounded by the number of plants).
* The item master first joins redundancy on item number (the narrow master is what moves),
  then on-hand, cost and the profile on (item, plant); those sort-merge joins share one hash
  partitioning on that key, so the aggregation outputs are joined without another exchange.
  Only sides that stay small in memory too are broadcast (``_merged``); AQE splits skewed partitions.
* The as-of date is a literal, not a one-row relation, so no nested-loop join appears.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from sparesledger.functions.aging import DEFAULT_EDGES, ISSUE_TYPE, RECEIPT_TYPE, age_bucket, movement_status
from sparesledger.functions.bitsets import BitSet
from sparesledger.functions.money import decimal_type, difference_type, product, quotient
from sparesledger.functions.periods import as_of_date

# Fixed value: the reference's reporting date (transaction types live in functions.aging).
REFERENCE_AS_OF = _dt.date(2026, 6, 30)
KEY = ["inventory_item_id", "org_id"]
# Types of the gold measures: values in money of two places (a value that does not fit is an error).
VALUE, PERCENT = DecimalType(20, 2), DecimalType(24, 2)
MONTHS = DecimalType(14, 8)  # months_between rounds to 8 places


def _as_date(d) -> F.Column:
    v = as_of_date(d)
    return v if isinstance(v, F.Column) else F.lit(v)


def txn_profile(
    txn: DataFrame,
    receipt_type: int = RECEIPT_TYPE,
    issue_type: int = ISSUE_TYPE,
    as_of=None,
    cutoff: bool = False,
) -> DataFrame:
    """Per item x plant: first/last receipt, last issue, counts, quantity consumed, suppliers.

    Only the two transaction types count; issues are negative quantities, so consumption is
    their negated sum. With ``cutoff=True`` transactions after ``as_of`` are ignored (the
    reference counts them); the filter then prunes the month-partitioned fact on read.
    """
    t = txn
    if cutoff:
        if as_of is None:
            raise ValueError("cutoff needs as_of")
        ref = _as_date(as_of)
        t = t.filter(F.col("txn_date") <= ref)
        if "txn_year_month" in t.columns:
            # the implied month bound prunes whole partitions of the stored fact
            t = t.filter(F.col("txn_year_month") <= F.date_format(ref, "yyyy-MM"))
    is_rcpt = F.col("txn_type_id") == receipt_type
    is_issue = F.col("txn_type_id") == issue_type
    return t.groupBy(*KEY).agg(
        F.max(F.when(is_rcpt, F.col("txn_date"))).alias("last_receipt_date"),
        F.min(F.when(is_rcpt, F.col("txn_date"))).alias("first_receipt_date"),
        F.max(F.when(is_issue, F.col("txn_date"))).alias("last_issue_date"),
        F.count_if(is_issue).alias("issue_txn_count"),
        F.count_if(is_rcpt).alias("receipt_txn_count"),
        F.sum(F.when(is_issue, -F.col("primary_quantity")).otherwise(F.lit(0))).alias("qty_consumed"),
        F.count_distinct(F.when(is_rcpt, F.col("vendor_id"))).alias("distinct_suppliers"),
    )


def profile_parts(txn: DataFrame, receipt_type: int = RECEIPT_TYPE, issue_type: int = ISSUE_TYPE) -> DataFrame:
    """The profile in parts that merge: one row per item, plant, month and supplier.

    A month's parts come from that month's transactions alone, so after new or corrected
    transactions only their months are made anew; ``merged_profile`` puts any parts together.
    """
    is_rcpt, is_issue = F.col("txn_type_id") == receipt_type, F.col("txn_type_id") == issue_type
    return txn.groupBy(*KEY, "txn_year_month", "vendor_id").agg(
        F.max(F.when(is_rcpt, F.col("txn_date"))).alias("last_receipt_date"),
        F.min(F.when(is_rcpt, F.col("txn_date"))).alias("first_receipt_date"),
        F.max(F.when(is_issue, F.col("txn_date"))).alias("last_issue_date"),
        F.count_if(is_issue).alias("issue_txn_count"),
        F.count_if(is_rcpt).alias("receipt_txn_count"),
        F.sum(F.when(is_issue, -F.col("primary_quantity")).otherwise(F.lit(0))).alias("qty_consumed"),
    )


def merged_profile(parts: DataFrame) -> DataFrame:
    """``txn_profile`` from the parts of all its months."""
    return parts.groupBy(*KEY).agg(
        F.max("last_receipt_date").alias("last_receipt_date"), F.min("first_receipt_date").alias("first_receipt_date"),
        F.max("last_issue_date").alias("last_issue_date"), F.sum("issue_txn_count").alias("issue_txn_count"),
        F.sum("receipt_txn_count").alias("receipt_txn_count"), F.sum("qty_consumed").alias("qty_consumed"),
        F.count_distinct(F.when(F.col("receipt_txn_count") > 0, F.col("vendor_id"))).alias("distinct_suppliers"),
    )


class Plants(NamedTuple):
    """The ids and codes of all plants: a small domain, so sets of plants fit into bit masks."""

    ids: tuple[int, ...]
    codes: tuple[str, ...]


MOST_PLANTS = 1024  # beyond that, sets are gathered as sets


def known_plants(dim_org: DataFrame) -> Plants | None:
    """The plants of the dimension (one row per operating unit, read by the driver); None if there
    are more than ``MOST_PLANTS``."""
    rows = dim_org.select("org_id", "org_code").distinct().limit(MOST_PLANTS + 1).collect()
    if len(rows) > MOST_PLANTS:
        return None
    return Plants(tuple(sorted({r.org_id for r in rows if r.org_id is not None})), tuple(sorted({r.org_code for r in rows if r.org_code is not None})))


def redundancy(dim_item: DataFrame, onhand: DataFrame | None = None, basis: str = "master", plants: Plants | None = None) -> DataFrame:
    """Per item number: how many plants carry it, and which (sorted list).

    ``basis='master'`` counts item-master rows (the reference); ``basis='onhand'`` counts
    only plants that hold stock. With ``plants`` known the sets are bit masks in a hash aggregate;
    without, one set is collected per item number.
    """
    items = dim_item
    if basis == "onhand":
        if onhand is None:
            raise ValueError("basis='onhand' needs the on-hand extract")
        stock = onhand.select(
            F.col("INVENTORY_ITEM_ID").alias("inventory_item_id"), F.col("ORGANIZATION_ID").alias("org_id")
        )
        items = items.join(stock, KEY, "left_semi")
    elif basis != "master":
        raise ValueError(f"unknown basis {basis!r}")
    if plants is not None:
        ids, codes = BitSet("plant_ids", plants.ids), BitSet("plant_codes", plants.codes)
        masks = items.groupBy("item_number").agg(*ids.gather(F.col("org_id")), *codes.gather(F.col("org_code")))
        return masks.select("item_number", ids.size().alias("stocked_in_orgs"), codes.decoded().alias("stocked_org_list"))
    # One set per item number, bounded by the number of plants (the list is wanted anyway); the
    # distinct plant count and the list of codes both come from it, without a second shuffle.
    carried = items.groupBy("item_number").agg(F.collect_set(F.struct("org_id", "org_code")).alias("plants"))
    distinct = lambda field: F.array_distinct(F.array_compact(F.col(f"plants.{field}")))
    return carried.select(
        "item_number",
        F.size(distinct("org_id")).cast("long").alias("stocked_in_orgs"),
        F.sort_array(distinct("org_code")).alias("stocked_org_list"),
    )


def onhand_by_item(onhand: DataFrame) -> DataFrame:
    """On-hand rows summed to the item x plant grain, so several rows never multiply lines."""
    return onhand.groupBy(
        F.col("INVENTORY_ITEM_ID").alias("inventory_item_id"), F.col("ORGANIZATION_ID").alias("org_id")
    ).agg(F.sum("PRIMARY_TRANSACTION_QUANTITY").alias("onhand_qty"))


def item_costs(costs: DataFrame, cost_type: str | None = None, type_col: str = "COST_TYPE_ID") -> DataFrame:
    """Costs per item x plant, as they stand: an extract with several rows per pair multiplies its
    lines (``check_cost_grain`` lists them). ``cost_type`` takes the rows of one type only, from the
    extract's ``type_col``."""
    if cost_type is not None:
        costs = costs.filter(F.col(type_col).cast("string") == cost_type)
    return costs.select(
        F.col("INVENTORY_ITEM_ID").alias("inventory_item_id"),
        F.col("ORGANIZATION_ID").alias("org_id"),
        F.col("ITEM_COST").alias("average_cost"),
        F.col("LAST_PO_COST").alias("last_po_cost"),
    )


PACKED = 16  # rows in memory may take so many times the bytes of their files


def _merged(side: DataFrame) -> DataFrame:
    """``side`` for a merge join, unless ``PACKED`` times its estimated size may be broadcast. The
    estimate goes by file sizes, and files hold rows per item and plant in few bytes, so a planner
    left to itself would broadcast millions of them."""
    size = int(str(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    limit = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return side if PACKED * size <= limit else side.hint("merge")


STORES_AGING_COLUMNS = (
    "item_number", "item_description", "category_name", "org_code", "region", "business_line", "uom",
    "onhand_qty", "average_cost", "last_po_cost", "onhand_value_avg_cost", "onhand_value_last_cost",
    "cost_variance_pct", "revaluation_exposure",
    "first_receipt_date", "last_receipt_date", "days_since_receipt",
    "last_issue_date", "days_since_issue", "issue_txn_count", "receipt_txn_count", "distinct_suppliers",
    "avg_monthly_consumption", "months_of_cover", "days_since_first_receipt",
    "aging_bucket_last_receipt", "aging_bucket_first_receipt", "movement_status",
    "stocked_in_orgs", "stocked_org_list", "redistribution_candidate", "org_id",
)


def stores_aging(
    dim_item: DataFrame,
    onhand: DataFrame,
    costs: DataFrame,
    txn: DataFrame,
    as_of=REFERENCE_AS_OF,
    edges: Sequence[int] = DEFAULT_EDGES,
    unknown_bucket: str | None = None,
    cutoff: bool = False,
    receipt_type: int = RECEIPT_TYPE,
    issue_type: int = ISSUE_TYPE,
    basis: str = "master",
    non_moving_days: int = 365,
    slow_moving_days: int = 180,
    plants: Plants | None = None,
    cost_type: str | None = None,
    profile: DataFrame | None = None,
) -> DataFrame:
    """The 32-column ageing table (one row per item x plant with on-hand and cost rows).

    ``dim_item`` is silver; ``onhand`` and ``costs`` are the bronze extracts; ``txn`` is the
    silver transaction fact. Items without on-hand or cost rows drop out (inner joins);
    items without transactions stay, with NULL dates and counts. ``profile`` is the ``txn_profile`` of
    ``txn`` where it is stored already; it must have been made with the same types and cutoff.
    """
    ref = _as_date(as_of)
    prof = txn_profile(txn, receipt_type, issue_type, as_of, cutoff) if profile is None else profile
    rd = redundancy(dim_item, onhand, basis, plants)
    # Redundancy joins the narrow item master first (item-number shuffle of ~11 columns), so
    # the wide joined rows never move again; the rest meets on one (item, plant) partitioning.
    base = (
        dim_item.join(_merged(rd), "item_number", "left")
        .join(_merged(onhand_by_item(onhand)), KEY)
        .join(_merged(item_costs(costs, cost_type)), KEY)
        .join(_merged(prof), KEY, "left")
    )

    qty, avg_c, last_c, rise = F.col("onhand_qty"), F.col("average_cost"), F.col("last_po_cost"), F.col("last_po_cost") - F.col("average_cost")
    # Products and quotients are sized from the places that the sources declare.
    qty_t, consumed_t = decimal_type(base, "onhand_qty"), decimal_type(base, "qty_consumed")
    avg_t, last_t = decimal_type(base, "average_cost"), decimal_type(base, "last_po_cost")
    rise_t = difference_type(last_t, avg_t)

    def value(price: F.Column, kind: DecimalType) -> F.Column:
        return F.round(product(qty, qty_t, price, kind)[0], 2).cast(VALUE)

    days_rcpt = F.datediff(ref, F.col("last_receipt_date"))
    days_issue = F.datediff(ref, F.col("last_issue_date"))
    days_first = F.datediff(ref, F.col("first_receipt_date"))
    months = F.months_between(ref, F.col("first_receipt_date")).cast(MONTHS)  # since the first receipt
    stock_months, stock_months_t = product(qty, qty_t, months, MONTHS)
    consumed = F.col("qty_consumed")
    issues = F.coalesce(F.col("issue_txn_count"), F.lit(0))
    stocked = F.coalesce(F.col("stocked_in_orgs"), F.lit(1))

    return base.select(
        "item_number", "item_description", "category_name", "org_code", "region", "business_line", "uom",
        qty.alias("onhand_qty"),
        avg_c.alias("average_cost"),
        last_c.alias("last_po_cost"),
        value(avg_c, avg_t).alias("onhand_value_avg_cost"),
        value(last_c, last_t).alias("onhand_value_last_cost"),
        # four places of the ratio are two of the percentage
        (quotient(rise, rise_t, avg_c, avg_t, 4) * 100).cast(PERCENT).alias("cost_variance_pct"),
        value(rise, rise_t).alias("revaluation_exposure"),
        "first_receipt_date",
        "last_receipt_date",
        days_rcpt.alias("days_since_receipt"),
        "last_issue_date",
        days_issue.alias("days_since_issue"),
        "issue_txn_count",
        "receipt_txn_count",
        "distinct_suppliers",
        quotient(consumed, consumed_t, months, MONTHS, 3).cast("decimal(24,3)").alias("avg_monthly_consumption"),
        # stock / (consumed / months) == stock * months / consumed: one exact division
        F.when((consumed > 0) & (months != 0), quotient(stock_months, stock_months_t, consumed, consumed_t, 1))
        .cast("decimal(24,1)").alias("months_of_cover"),
        days_first.alias("days_since_first_receipt"),
        age_bucket(days_rcpt, edges, unknown_bucket).alias("aging_bucket_last_receipt"),
        age_bucket(days_first, edges, unknown_bucket).alias("aging_bucket_first_receipt"),
        movement_status(F.col("issue_txn_count"), days_issue, non_moving_days, slow_moving_days).alias("movement_status"),
        stocked.alias("stocked_in_orgs"),
        "stocked_org_list",
        ((stocked > 1) & (issues == 0)).alias("redistribution_candidate"),
        "org_id",
    )
