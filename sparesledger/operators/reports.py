"""Reports over the gold ageing table: scan -> filter -> aggregate -> sort / top-k.

Each report is one aggregation with map-side partial aggregation; group keys are
low-cardinality (bucket, plant, category, status) except the cross-plant lists, which
group by item number. Top-k uses ``orderBy(...).limit(k)`` (a bounded
``TakeOrderedAndProject``) with a unique tie-break so the chosen rows are deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparesledger.functions.aging import ACTIVE, DEAD_STOCK, NON_MOVING_STATUSES, SLOW_MOVING
from sparesledger.functions.bitsets import BitSet
from sparesledger.functions.money import avg_round, in_millions

VALUE = "onhand_value_avg_cost"


def _dead() -> Column:
    return F.col("movement_status") == DEAD_STOCK


def aging_by_bucket(gold: DataFrame, bucket_col: str = "aging_bucket_last_receipt") -> DataFrame:
    """Per bucket: lines, value (millions, 1 place), dead lines, dead value."""
    return (
        gold.groupBy(F.col(bucket_col).alias("aging_bucket"))
        .agg(
            F.count("*").alias("stock_lines"),
            in_millions(F.sum(VALUE), 1).alias("value_pkr_mn"),
            F.count_if(_dead()).alias("dead_stock_lines"),
            in_millions(F.sum(F.when(_dead(), F.col(VALUE)).otherwise(F.lit(0))), 1).alias("dead_value_pkr_mn"),
        )
        .orderBy("aging_bucket")
    )


CROSS_PLANT_KEYS = ("item_number", "item_description", "category_name")
STATUSES = (ACTIVE, SLOW_MOVING, *NON_MOVING_STATUSES)


def _cross_plant(gold: DataFrame, with_stock_columns: bool, k: int, plants: Sequence[str] | None) -> DataFrame:
    """Items carried in more than one plant, dead in one and Active in another; top k by value.

    Plants and statuses are gathered as bit masks in the same hash aggregate as the sums, over one
    pass of gold, and decoded for the k rows that are left.
    """
    if plants is None:
        return _cross_plant_sets(gold, with_stock_columns, k)
    held, mix = BitSet("held", plants), BitSet("mix", STATUSES)
    sums = [F.sum("onhand_qty").alias("total_onhand")] if with_stock_columns else []
    top = (
        gold.filter(F.col("stocked_in_orgs") > 1).groupBy(*CROSS_PLANT_KEYS)
        .agg(*sums, in_millions(F.sum(VALUE), 2).alias("value_pkr_mn"), *held.gather(F.col("org_code")), *mix.gather(F.col("movement_status")))
        .filter(mix.has(DEAD_STOCK) & mix.has(ACTIVE))
        .orderBy(F.desc("value_pkr_mn"), F.asc("item_number"))
        .limit(k)
    )
    stock, sets = (["total_onhand"], [mix.decoded().alias("status_mix")]) if with_stock_columns else ([], [])
    return top.select(*CROSS_PLANT_KEYS, *stock, "value_pkr_mn", held.decoded().alias("held_in"), *sets)


def _cross_plant_sets(gold: DataFrame, with_stock_columns: bool, k: int) -> DataFrame:
    """The same where the plants are not known: sums and the two HAVING tests are hash aggregates over
    all items, and sets are collected for the k rows that are left in a second pass, joined by
    their keys (the join's strategy is left to the sizes)."""
    multi = gold.filter(F.col("stocked_in_orgs") > 1)
    sums = [F.sum("onhand_qty").alias("total_onhand")] if with_stock_columns else []
    top = (
        multi.groupBy(*CROSS_PLANT_KEYS)
        .agg(*sums, in_millions(F.sum(VALUE), 2).alias("value_pkr_mn"),
             F.bool_or(_dead()).alias("_has_dead"), F.bool_or(F.col("movement_status") == ACTIVE).alias("_has_active"))
        .filter(F.col("_has_dead") & F.col("_has_active"))
        .drop("_has_dead", "_has_active")
        .orderBy(F.desc("value_pkr_mn"), F.asc("item_number"))
        .limit(k)
    )
    sets = [F.sort_array(F.collect_set("org_code")).alias("held_in")]
    if with_stock_columns:
        sets.append(F.sort_array(F.collect_set("movement_status")).alias("status_mix"))
    rows = multi.select(*[F.col(c).alias(f"_{c}") for c in CROSS_PLANT_KEYS], "org_code", "movement_status")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in CROSS_PLANT_KEYS]
    return (
        rows.join(top, same).groupBy(*top.columns).agg(*sets)
        .select(*top.columns, *(["held_in", "status_mix"] if with_stock_columns else ["held_in"]))
        .orderBy(F.desc("value_pkr_mn"), F.asc("item_number"))
    )


def redistribution_list(gold: DataFrame, k: int = 50, plants: Sequence[str] | None = None) -> DataFrame:
    """Redistribution instead of purchase: dead here, Active elsewhere; top 50 by value. ``plants``:
    all plant codes, where they are known (one pass instead of two)."""
    return _cross_plant(gold, True, k, plants)


def dead_here_active_there(gold: DataFrame, k: int = 25, plants: Sequence[str] | None = None) -> DataFrame:
    """The verified-question version: no quantity or status columns, top 25."""
    return _cross_plant(gold, False, k, plants)


def procurement_list(gold: DataFrame, threshold: float = 15) -> DataFrame:
    """Per category where last PO cost runs ``threshold`` % above average: count, mean, exposure.

    Rows with unknown variance (zero average cost) never pass the filter.
    """
    return (
        gold.filter(F.col("cost_variance_pct") > threshold)
        .groupBy("category_name")
        .agg(
            F.count("*").alias("items"),
            avg_round(F.col("cost_variance_pct"), 1).alias("avg_variance_pct"),
            in_millions(F.sum("revaluation_exposure"), 1).alias("exposure_pkr_mn"),
        )
        .orderBy(F.desc("exposure_pkr_mn"), F.asc("category_name"))
    )


def price_rise_by_category(gold: DataFrame, threshold: float = 20) -> DataFrame:
    return procurement_list(gold, threshold)


def cost_variance_by_category(gold: DataFrame) -> DataFrame:
    """Dashboard data set: variance by category over every line (no threshold)."""
    return (
        gold.groupBy("category_name")
        .agg(
            F.count("*").alias("items"),
            avg_round(F.col("cost_variance_pct"), 1).alias("avg_variance_pct"),
            in_millions(F.sum("revaluation_exposure"), 1).alias("exposure_pkr_mn"),
        )
        .orderBy(F.desc("exposure_pkr_mn"), F.asc("category_name"))
    )


def dead_stock_total(gold: DataFrame) -> DataFrame:
    """Total value and lines never issued (one row)."""
    return gold.filter(_dead()).agg(
        in_millions(F.sum(VALUE), 1).alias("dead_stock_value_pkr_mn"),
        F.count("*").alias("item_lines"),
    )


def value_by_plant_bucket(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("org_code", "aging_bucket_last_receipt")
        .agg(in_millions(F.sum(VALUE), 1).alias("value_pkr_mn"))
        .orderBy("org_code", "aging_bucket_last_receipt")
    )


def nonmoving_by_category(gold: DataFrame) -> DataFrame:
    """Capital tied up in non-moving and dead stock, per category."""
    return (
        gold.filter(F.col("movement_status").isin(*NON_MOVING_STATUSES))
        .groupBy("category_name")
        .agg(in_millions(F.sum(VALUE), 1).alias("value_pkr_mn"), F.count("*").alias("item_lines"))
        .orderBy(F.desc("value_pkr_mn"), F.asc("category_name"))
    )


def movement_mix(gold: DataFrame) -> DataFrame:
    """Dashboard data set: lines and value per movement status."""
    return (
        gold.groupBy("movement_status")
        .agg(F.count("*").alias("stock_lines"), in_millions(F.sum(VALUE), 1).alias("value_pkr_mn"))
        .orderBy(F.desc("value_pkr_mn"), F.asc("movement_status"))
    )


def stock_kpis(gold: DataFrame, plants: Sequence[str] | None = None) -> DataFrame:
    """Dashboard KPI tiles (one row): lines, items, plants, value, dead lines and value.

    With the plant codes known, lines are summed per item first, with the plants as a mask, so the
    two distinct counts take two hash aggregates and no Expand of the rows.
    """
    measures = [
        F.count("*").alias("stock_lines"),
        F.sum(VALUE).alias("value"),
        F.count_if(_dead()).alias("dead_stock_lines"),
        F.sum(F.when(_dead(), F.col(VALUE)).otherwise(F.lit(0))).alias("dead_value"),
        F.count_if(F.col("redistribution_candidate")).alias("redistribution_candidates"),
    ]
    if plants is None:
        total = gold.agg(*measures, F.count_distinct("item_number").alias("items"), F.count_distinct("org_code").alias("plants"))
    else:
        held = BitSet("held", plants)
        per_item = gold.groupBy("item_number").agg(*measures, *held.gather(F.col("org_code")))
        counted = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
        total = per_item.agg(counted("stock_lines"), F.sum("value").alias("value"), counted("dead_stock_lines"), F.sum("dead_value").alias("dead_value"),
                             counted("redistribution_candidates"), F.count("item_number").alias("items"), *held.merge())
        total = total.withColumn("plants", held.size())
    return total.select("stock_lines", "items", "plants", in_millions(F.col("value"), 1).alias("value_pkr_mn"), "dead_stock_lines",
                        in_millions(F.col("dead_value"), 1).alias("dead_value_pkr_mn"), "redistribution_candidates")


# Vocabulary of the question space, re-aimed as arguments of ``stock_summary``.
# The synonyms users type and the column each one means.
SYNONYMS = {
    "plant": "org_code", "site": "org_code", "location": "org_code", "unit": "org_code",
    "value": "onhand_value_avg_cost", "worth": "onhand_value_avg_cost", "amount": "onhand_value_avg_cost",
    "replacement cost": "onhand_value_last_cost", "last purchase price": "onhand_value_last_cost",
    "exposure": "revaluation_exposure",
    "age": "days_since_receipt", "original age": "days_since_first_receipt",
    "bucket": "aging_bucket_last_receipt", "original bucket": "aging_bucket_first_receipt",
    "category": "category_name", "status": "movement_status", "item": "item_number",
}
MEASURES = ("onhand_value_avg_cost", "onhand_value_last_cost", "revaluation_exposure")
STATUS_FILTERS = {
    "dead stock": lambda: F.col("movement_status") == DEAD_STOCK,
    "non-moving": lambda: F.col("movement_status").isin(*NON_MOVING_STATUSES),
}


def _resolve(name: str) -> str:
    return SYNONYMS.get(name.lower(), name)


def stock_summary(
    gold: DataFrame,
    by: Sequence[str] = ("plant",),
    where: str | Column | None = None,
    measure: str = "value",
    scale_digits: int = 1,
    descending: bool = True,
) -> DataFrame:
    """Grouped value in millions with the conventions of the question space.

    Synonyms resolve to columns (plant/site/location/unit -> ``org_code``; value/worth/amount
    -> average-cost value; age -> days since last receipt), ``where`` accepts a Column or
    ``'dead stock'`` / ``'non-moving'``, and results sort by value descending by default.
    """
    keys = [_resolve(b) for b in by]
    m = _resolve(measure)
    if m not in MEASURES:
        raise ValueError(f"measure {measure!r} is not a money column; use value, replacement cost or "
                         f"one of {MEASURES}")
    df = gold
    if isinstance(where, str):
        if where.lower() not in STATUS_FILTERS:
            raise ValueError(f"unknown filter {where!r}; use a Column or one of {sorted(STATUS_FILTERS)}")
        df = df.filter(STATUS_FILTERS[where.lower()]())
    elif where is not None:
        df = df.filter(where)
    order = F.desc("value_pkr_mn") if descending else F.asc("value_pkr_mn")
    return (
        df.groupBy(*keys)
        .agg(in_millions(F.sum(m), scale_digits).alias("value_pkr_mn"), F.count("*").alias("item_lines"))
        .orderBy(order, *[F.asc(k) for k in keys])
    )
