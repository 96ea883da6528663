"""Silver layer: conformed dimensions, facts and the sub-ledger bridge.

Inputs are bronze extracts (source column names); outputs use business names. Joins are left to
the optimizer and AQE: the plant dimension is broadcast because it is small, fact joins are
sort-merge at scale, and hot keys are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Account type decode and business-line prefixes.
ACCOUNT_TYPES = {"A": "Asset", "L": "Liability", "E": "Expense"}
OTHER_ACCOUNT_TYPE = "Other"
BUSINESS_LINES = (("W", "White Cement"), ("G", "Grey Cement"))
CORPORATE = "Corporate"


def dim_account(gl_code_combinations: DataFrame) -> DataFrame:
    """Enabled accounts with named segments and a decoded account type."""
    c = gl_code_combinations
    acct_type = None
    for code, label in ACCOUNT_TYPES.items():
        cond = F.col("ACCOUNT_TYPE") == code
        acct_type = F.when(cond, label) if acct_type is None else acct_type.when(cond, label)
    return c.filter(F.col("ENABLED_FLAG") == "Y").select(
        F.col("CODE_COMBINATION_ID").alias("code_combination_id"),
        F.col("SEGMENT1").alias("company_code"),
        F.col("SEGMENT2").alias("cost_centre_code"),
        F.col("COST_CENTRE_DESC").alias("cost_centre_name"),
        F.col("SEGMENT3").alias("natural_account"),
        F.col("ACCOUNT_DESC").alias("account_name"),
        acct_type.otherwise(OTHER_ACCOUNT_TYPE).alias("account_type"),
        F.col("SEGMENT4").alias("plant_code"),
        F.col("SEGMENT5").alias("intercompany_code"),
        F.col("CONCATENATED_SEGMENTS").alias("concatenated_segments"),
    )


def business_line(org_code) -> F.Column:
    expr = None
    for prefix, label in BUSINESS_LINES:
        cond = org_code.startswith(prefix)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(CORPORATE)


def dim_organization(hr_operating_units: DataFrame) -> DataFrame:
    """Plants with their business line (W… White Cement, G… Grey Cement, else Corporate)."""
    o = hr_operating_units
    return o.select(
        F.col("ORG_ID").alias("org_id"),
        F.col("ORG_CODE").alias("org_code"),
        F.col("ORG_NAME").alias("org_name"),
        F.col("LEDGER_ID").alias("ledger_id"),
        F.col("PLANT_SEGMENT").alias("plant_code"),
        F.col("REGION").alias("region"),
        business_line(F.col("ORG_CODE")).alias("business_line"),
    )


def dim_item(mtl_system_items_b: DataFrame, dim_org: DataFrame) -> DataFrame:
    """Item x plant with plant attributes; items of unknown plants drop out (inner join)."""
    i = mtl_system_items_b
    o = dim_org.select("org_id", "org_code", "region", "business_line")
    return i.join(o, i.ORGANIZATION_ID == o.org_id).select(
        F.col("INVENTORY_ITEM_ID").alias("inventory_item_id"),
        o.org_id,
        F.col("SEGMENT1").alias("item_number"),
        F.col("DESCRIPTION").alias("item_description"),
        F.col("CATEGORY_CODE").alias("category_code"),
        F.col("CATEGORY_NAME").alias("category_name"),
        F.col("PRIMARY_UOM_CODE").alias("uom"),
        F.col("FULL_LEAD_TIME").alias("lead_time_days"),
        "org_code", "region", "business_line",
    )


def fact_material_txn(mtl_material_transactions: DataFrame) -> DataFrame:
    """Typed receipts and issues with a ``yyyy-MM`` month key (the partition column on write)."""
    t = mtl_material_transactions
    return t.select(
        F.col("TRANSACTION_ID").alias("transaction_id"),
        F.col("INVENTORY_ITEM_ID").alias("inventory_item_id"),
        F.col("ORGANIZATION_ID").alias("org_id"),
        F.col("TRANSACTION_TYPE_ID").alias("txn_type_id"),
        F.col("TRANSACTION_TYPE_NAME").alias("txn_type_name"),
        F.col("TRANSACTION_DATE").cast("date").alias("txn_date"),
        F.col("PRIMARY_QUANTITY").alias("primary_quantity"),
        F.col("ACTUAL_COST").alias("actual_cost"),
        F.col("TRANSACTION_COST_TOTAL").alias("txn_value"),
        F.col("VENDOR_ID").alias("vendor_id"),
        F.col("PO_NUMBER").alias("po_number"),
        F.date_format(F.col("TRANSACTION_DATE"), "yyyy-MM").alias("txn_year_month"),
    )


def fact_ap_distribution(
    ap_invoice_distributions_all: DataFrame, ap_invoices_all: DataFrame, ap_suppliers: DataFrame
) -> DataFrame:
    """Distribution + invoice header + supplier (inner joins, as the reference)."""
    d, h, s = ap_invoice_distributions_all, ap_invoices_all, ap_suppliers
    h = h.select(
        F.col("INVOICE_ID").alias("h_invoice_id"), F.col("VENDOR_ID").alias("h_vendor_id"),
        "INVOICE_NUM", "INVOICE_DATE", "DUE_DATE", "PAYMENT_STATUS_PAID_FLAG",
    )
    s = s.select(F.col("VENDOR_ID").alias("s_vendor_id"), "VENDOR_NAME", "TERMS_NAME")
    return (
        d.join(h, d.INVOICE_ID == h.h_invoice_id)
        .join(s, F.col("h_vendor_id") == s.s_vendor_id)
        .select(
            F.col("INVOICE_DISTRIBUTION_ID").alias("invoice_distribution_id"),
            F.col("INVOICE_ID").alias("invoice_id"),
            F.col("INVOICE_LINE_ID").alias("invoice_line_id"),
            F.col("ORG_ID").alias("org_id"),
            F.col("AMOUNT").alias("amount"),
            F.col("DIST_CODE_COMBINATION_ID").alias("code_combination_id"),
            F.col("PERIOD_NAME").alias("period_name"),
            F.col("ACCOUNTING_DATE").cast("date").alias("accounting_date"),
            F.col("INVOICE_NUM").alias("invoice_num"),
            F.col("INVOICE_DATE").cast("date").alias("invoice_date"),
            F.col("DUE_DATE").cast("date").alias("due_date"),
            F.col("PAYMENT_STATUS_PAID_FLAG").alias("paid_flag"),
            F.col("VENDOR_NAME").alias("vendor_name"),
            F.col("TERMS_NAME").alias("payment_terms"),
        )
    )


def fact_gl_line(gl_je_lines: DataFrame, gl_je_headers: DataFrame) -> DataFrame:
    """Journal line + header (source, category, name)."""
    l, h = gl_je_lines, gl_je_headers
    h = h.select(F.col("JE_HEADER_ID").alias("h_je_header_id"), "JE_SOURCE", "JE_CATEGORY", "NAME")
    return l.join(h, l.JE_HEADER_ID == h.h_je_header_id).select(
        F.col("JE_HEADER_ID").alias("je_header_id"),
        F.col("JE_LINE_NUM").alias("je_line_num"),
        F.col("CODE_COMBINATION_ID").alias("code_combination_id"),
        F.col("LEDGER_ID").alias("ledger_id"),
        F.col("PERIOD_NAME").alias("period_name"),
        F.col("ACCOUNTED_DR").alias("accounted_dr"),
        F.col("ACCOUNTED_CR").alias("accounted_cr"),
        F.col("EFFECTIVE_DATE").cast("date").alias("effective_date"),
        F.col("JE_SOURCE").alias("je_source"),
        F.col("JE_CATEGORY").alias("je_category"),
        F.col("NAME").alias("je_name"),
    )


def bridge_sla_gl(xla_distribution_links: DataFrame, xla_ae_headers: DataFrame) -> DataFrame:
    """Sub-ledger distribution -> journal link with its accounting-event header."""
    dl, ah = xla_distribution_links, xla_ae_headers
    ah = ah.select(F.col("AE_HEADER_ID").alias("ah_id"), "APPLICATION_NAME", "PERIOD_NAME", "ACCOUNTING_DATE")
    return dl.join(ah, dl.AE_HEADER_ID == ah.ah_id).select(
        F.col("GL_SL_LINK_ID").alias("gl_sl_link_id"),
        F.col("SOURCE_DISTRIBUTION_ID_NUM_1").alias("invoice_distribution_id"),
        F.col("SOURCE_DISTRIBUTION_TYPE").alias("source_type"),
        F.col("JE_HEADER_ID").alias("je_header_id"),
        F.col("ah_id").alias("ae_header_id"),
        F.col("APPLICATION_NAME").alias("sub_ledger"),
        F.col("PERIOD_NAME").alias("period_name"),
        F.col("ACCOUNTING_DATE").cast("date").alias("accounting_date"),
    )


SILVER_TABLES = (
    "dim_account", "dim_organization", "dim_item", "fact_material_txn",
    "fact_ap_distribution", "fact_gl_line", "bridge_sla_gl",
)
