"""AP sub-ledger -> SLA bridge -> GL tie-out, period order, drill-through and trend.

Plan shape: the three sides are one tagged union, summed once.

* AP side: distributions joined to their plant (Spark broadcasts the dimension by its size).
* SLA side: bridge x distribution on distribution id -- fact x fact, so the join strategy
  is left to the optimizer/AQE (never forced to broadcast; no shuffle where both are stored in
  buckets).
* GL side: journal lines of one source on one natural account.

One aggregation by (period, side, plant) sums them all: partial sums where the rows are, one row per
task and group over a single exchange. A period's columns are then picked from its few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparesledger.functions.periods import period_start

# Status words, the stores inventory natural account, the journal source.
RECONCILED, INVESTIGATE = "RECONCILED", "INVESTIGATE"
STORES_ACCOUNT = "1310"  # Stores & Spares Inventory
PAYABLES = "Payables"


def ap_side(fact_ap_distribution: DataFrame, dim_org: DataFrame, by_plant: bool = False) -> DataFrame:
    """AP amount per period (per period x plant with ``by_plant``); unknown plants drop out."""
    d = fact_ap_distribution
    if by_plant:
        o = dim_org.select("org_id", "org_code")
        return d.join(o, "org_id").groupBy("period_name", "org_code").agg(
            F.count("*").alias("ap_distribution_count"),
            F.round(F.sum("amount"), 2).alias("ap_amount"),
        )
    known = d.join(dim_org.select("org_id"), "org_id", "left_semi")
    return known.groupBy("period_name").agg(
        F.count("*").alias("ap_distribution_count"),
        F.round(F.sum("amount"), 2).alias("ap_amount"),
    )


def _bridged(bridge: DataFrame, fact_ap_distribution: DataFrame) -> DataFrame:
    """A row per link: the accounting event's period and the distribution's amount."""
    d = fact_ap_distribution.select("invoice_distribution_id", "amount")
    return bridge.select("invoice_distribution_id", "period_name").join(d, "invoice_distribution_id")


def sla_side(bridge: DataFrame, fact_ap_distribution: DataFrame) -> DataFrame:
    """Bridged amount per period of the accounting event (not of the distribution)."""
    return (
        _bridged(bridge, fact_ap_distribution)
        .groupBy("period_name")
        .agg(F.count("*").alias("sla_link_count"), F.round(F.sum("amount"), 2).alias("sla_amount"))
    )


def _posted(fact_gl_line: DataFrame, dim_account: DataFrame, source: str, account: str) -> DataFrame:
    """Journal lines of one source on one natural account. Lines on accounts missing from
    ``dim_account`` (disabled accounts) drop out."""
    l = fact_gl_line.filter(F.col("je_source") == source)
    a = dim_account.filter(F.col("natural_account") == account).select("code_combination_id")
    return l.join(a, "code_combination_id", "left_semi")


def gl_side(fact_gl_line: DataFrame, dim_account: DataFrame, source: str = PAYABLES,
            account: str = STORES_ACCOUNT) -> DataFrame:
    """GL debit and credit per period for one journal source on one natural account."""
    return (
        _posted(fact_gl_line, dim_account, source, account)
        .groupBy("period_name")
        .agg(
            F.round(F.sum("accounted_dr"), 2).alias("gl_debit"),
            F.round(F.sum("accounted_cr"), 2).alias("gl_credit"),
        )
    )


def recon_ap_to_gl(
    fact_ap_distribution: DataFrame,
    dim_org: DataFrame,
    bridge: DataFrame,
    fact_gl_line: DataFrame,
    dim_account: DataFrame,
    account: str = STORES_ACCOUNT,
    source: str = PAYABLES,
    tolerance: float = 1.0,
    detail: bool = False,
) -> DataFrame:
    """One row per period: AP total, bridged total, GL debit, variance and status.

    * status compares with missing sides as zero: a one-sided period under the tolerance
      is RECONCILED, while ``variance`` stays NULL there;
    * the account filter applies to GL only; AP takes every account and is the sum of its plants'
      totals, each rounded to two places;
    * NULL periods never match across sides but collapse into one NULL group.

    ``detail=True`` adds the counts and credits the reference computes but does not show
    (distributions, links, GL credit), the bridge gap (AP - SLA) and the period's first day.
    """
    none = F.lit(None).cast("string")
    plant = dim_org.select("org_id", "org_code")
    ap = fact_ap_distribution.join(plant, "org_id").select(
        "period_name", F.lit("ap").alias("side"), "org_code", F.col("amount").alias("total"), F.lit(None).cast("decimal(1,0)").alias("credit"))
    sla = _bridged(bridge, fact_ap_distribution).filter(F.col("period_name").isNotNull()).select(
        "period_name", F.lit("sla").alias("side"), none.alias("org_code"), F.col("amount").alias("total"), F.lit(None).cast("decimal(1,0)").alias("credit"))
    gl = _posted(fact_gl_line, dim_account, source, account).select(
        "period_name", F.lit("gl").alias("side"), none.alias("org_code"), F.col("accounted_dr").alias("total"), F.col("accounted_cr").alias("credit"))
    summed = ap.unionByName(sla).unionByName(gl).groupBy("period_name", "side", "org_code").agg(
        F.round(F.sum("total"), 2).alias("total"), F.round(F.sum("credit"), 2).alias("credit"), F.count("*").alias("rows"))
    of = lambda side, column: F.when(F.col("side") == side, F.col(column))
    joined = (
        summed.groupBy("period_name")
        .agg(
            F.sum(of("ap", "total")).alias("ap_total"),  # of each plant's total, rounded as it is
            F.max(of("sla", "total")).alias("sla_total"),
            F.max(of("gl", "total")).alias("gl_total"),
            F.sum(of("ap", "rows")).alias("ap_count"),
            F.max(of("sla", "rows")).alias("sla_count"),
            F.max(of("gl", "credit")).alias("gl_credit_total"),
            F.bool_or(F.col("side") != "sla").alias("_shown"),
        )
        .filter("_shown")  # a period of links only has neither side
    )
    ap_t, gl_t = F.col("ap_total"), F.col("gl_total")
    gap = F.abs(F.coalesce(ap_t, F.lit(0)) - F.coalesce(gl_t, F.lit(0)))
    cols = [
        "period_name",
        ap_t.alias("ap_subledger_total"),
        F.col("sla_total").alias("sla_bridged_total"),
        gl_t.alias("gl_posted_total"),
        F.round(ap_t - gl_t, 2).alias("variance"),
        F.when(gap < tolerance, RECONCILED).otherwise(INVESTIGATE).alias("status"),
    ]
    if detail:
        cols += [
            period_start(F.col("period_name")).alias("period_start"),
            F.col("ap_count").alias("ap_distribution_count"),
            F.col("sla_count").alias("sla_link_count"),
            F.col("gl_credit_total").alias("gl_credit_total"),
            F.round(ap_t - F.col("sla_total"), 2).alias("bridge_gap"),
        ]
    return joined.select(cols)


def recon_report(recon: DataFrame) -> DataFrame:
    """The tie-out in calendar order (``MMM-yy`` parsed; ``yy`` reads as 20yy)."""
    return recon.orderBy(period_start(F.col("period_name")).asc_nulls_last(), "period_name")


def variance_trend(recon: DataFrame) -> DataFrame:
    """Dashboard data set: period, its first day, variance and status in calendar order."""
    return recon.select(
        "period_name", period_start(F.col("period_name")).alias("period_start"), "variance", "status"
    ).orderBy(F.col("period_start").asc_nulls_last(), "period_name")


def gl_drill_through(
    fact_ap_distribution: DataFrame,
    bridge: DataFrame,
    dim_account: DataFrame,
    period: str,
    account: str = STORES_ACCOUNT,
    k: int = 25,
) -> DataFrame:
    """One GL balance back to its invoices: period + account -> top ``k`` by amount."""
    d = fact_ap_distribution.filter(F.col("period_name") == period).select(
        "invoice_distribution_id", "invoice_num", "vendor_name", "invoice_date", "amount", "code_combination_id"
    )
    b = bridge.select("invoice_distribution_id", "je_header_id", "gl_sl_link_id")
    a = dim_account.filter(F.col("natural_account") == account).select(
        "code_combination_id", "concatenated_segments", "account_name"
    )
    return (
        d.join(b, "invoice_distribution_id")
        .join(a, "code_combination_id")
        .select("invoice_num", "vendor_name", "invoice_date", "amount", "concatenated_segments",
                "account_name", "je_header_id", "gl_sl_link_id")
        .orderBy(F.desc("amount"), F.asc("gl_sl_link_id"))
        .limit(k)
    )
