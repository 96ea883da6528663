"""Explicit schemas of the ERP extracts.

Schemas are declared, never inferred: inference turns account segments such as ``'01'`` and
``'000'`` into integers and loses the leading zeros. Money and quantities are decimals, so
sums are exact; silver and gold keep the places their source declares.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

#: Ledger money as the test tables hold it.
MONEY = DecimalType(18, 2)
#: Default precision of the extracts: five places, as an ERP keeps unit costs and quantities.
#: ``read_extract(..., types=)`` declares another one for a column.
AMOUNT = QUANTITY = UNIT_COST = DecimalType(18, 5)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, I, D = StringType(), LongType(), IntegerType(), DateType()
M, Q, C = AMOUNT, QUANTITY, UNIT_COST

SOURCE_SCHEMAS: dict[str, StructType] = {
    "hr_operating_units": _schema(
        ("ORG_ID", L), ("ORG_CODE", S), ("ORG_NAME", S), ("LEDGER_ID", L),
        ("PLANT_SEGMENT", S), ("REGION", S),
    ),
    "gl_code_combinations": _schema(
        ("CODE_COMBINATION_ID", L), ("SEGMENT1", S), ("SEGMENT2", S), ("SEGMENT3", S),
        ("SEGMENT4", S), ("SEGMENT5", S), ("COST_CENTRE_DESC", S), ("ACCOUNT_DESC", S),
        ("ACCOUNT_TYPE", S), ("CONCATENATED_SEGMENTS", S), ("ENABLED_FLAG", S),
    ),
    "gl_je_headers": _schema(
        ("JE_HEADER_ID", L), ("JE_SOURCE", S), ("JE_CATEGORY", S), ("NAME", S),
    ),
    "gl_je_lines": _schema(
        ("JE_HEADER_ID", L), ("JE_LINE_NUM", L), ("CODE_COMBINATION_ID", L), ("LEDGER_ID", L),
        ("PERIOD_NAME", S), ("ACCOUNTED_DR", M), ("ACCOUNTED_CR", M), ("EFFECTIVE_DATE", D),
    ),
    "xla_ae_headers": _schema(
        ("AE_HEADER_ID", L), ("APPLICATION_NAME", S), ("PERIOD_NAME", S), ("ACCOUNTING_DATE", D),
    ),
    "xla_distribution_links": _schema(
        ("GL_SL_LINK_ID", L), ("SOURCE_DISTRIBUTION_ID_NUM_1", L), ("SOURCE_DISTRIBUTION_TYPE", S),
        ("JE_HEADER_ID", L), ("AE_HEADER_ID", L),
    ),
    "ap_suppliers": _schema(("VENDOR_ID", L), ("VENDOR_NAME", S), ("TERMS_NAME", S)),
    "ap_invoices_all": _schema(
        ("INVOICE_ID", L), ("VENDOR_ID", L), ("INVOICE_NUM", S), ("INVOICE_DATE", D),
        ("DUE_DATE", D), ("PAYMENT_STATUS_PAID_FLAG", S),
    ),
    "ap_invoice_distributions_all": _schema(
        ("INVOICE_DISTRIBUTION_ID", L), ("INVOICE_ID", L), ("INVOICE_LINE_ID", L), ("ORG_ID", L),
        ("AMOUNT", M), ("DIST_CODE_COMBINATION_ID", L), ("PERIOD_NAME", S), ("ACCOUNTING_DATE", D),
    ),
    "mtl_system_items_b": _schema(
        ("INVENTORY_ITEM_ID", L), ("ORGANIZATION_ID", L), ("SEGMENT1", S), ("DESCRIPTION", S),
        ("CATEGORY_CODE", S), ("CATEGORY_NAME", S), ("PRIMARY_UOM_CODE", S), ("FULL_LEAD_TIME", I),
    ),
    "mtl_material_transactions": _schema(
        ("TRANSACTION_ID", L), ("INVENTORY_ITEM_ID", L), ("ORGANIZATION_ID", L),
        ("TRANSACTION_TYPE_ID", I), ("TRANSACTION_TYPE_NAME", S), ("TRANSACTION_DATE", D),
        ("PRIMARY_QUANTITY", Q), ("ACTUAL_COST", C), ("TRANSACTION_COST_TOTAL", M),
        ("VENDOR_ID", L), ("PO_NUMBER", S),
    ),
    "mtl_onhand_quantities_detail": _schema(
        ("INVENTORY_ITEM_ID", L), ("ORGANIZATION_ID", L), ("PRIMARY_TRANSACTION_QUANTITY", Q),
    ),
    "cst_item_costs": _schema(
        ("INVENTORY_ITEM_ID", L), ("ORGANIZATION_ID", L), ("ITEM_COST", C), ("LAST_PO_COST", C),
    ),
    "org_security_map": _schema(("USER_NAME", S), ("ORG_CODE", S)),
}

SOURCE_TABLES: tuple[str, ...] = tuple(SOURCE_SCHEMAS)
# Extracts that are landed but that no later layer reads. Their columns are not declared: they
# land as text under the names in their header.
LANDED_ONLY: tuple[str, ...] = ("gl_ledgers", "gl_periods", "gl_import_references", "ap_invoice_lines_all")
# What the landing zone is expected to hold.
LANDING_TABLES: tuple[str, ...] = SOURCE_TABLES + LANDED_ONLY

# What tells the rows of an extract apart (on-hand details and grants have no key of their own).
SOURCE_KEYS: dict[str, tuple[str, ...]] = {
    "hr_operating_units": ("ORG_ID",),
    "gl_code_combinations": ("CODE_COMBINATION_ID",),
    "gl_je_headers": ("JE_HEADER_ID",),
    "gl_je_lines": ("JE_HEADER_ID", "JE_LINE_NUM"),
    "xla_ae_headers": ("AE_HEADER_ID",),
    "xla_distribution_links": ("GL_SL_LINK_ID",),
    "ap_suppliers": ("VENDOR_ID",),
    "ap_invoices_all": ("INVOICE_ID",),
    "ap_invoice_distributions_all": ("INVOICE_DISTRIBUTION_ID",),
    "mtl_system_items_b": ("INVENTORY_ITEM_ID", "ORGANIZATION_ID"),
    "mtl_material_transactions": ("TRANSACTION_ID",),
    "cst_item_costs": ("INVENTORY_ITEM_ID", "ORGANIZATION_ID"),
}

# Columns the bronze layer adds to every extract.
AUDIT_COLUMNS = ("_ingest_ts", "_source_system")
