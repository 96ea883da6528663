"""Data dictionary of the gold ageing table: comments as column metadata plus fill counts.

Comments travel with the DataFrame as ``StructField`` metadata (``comment``), which
``saveAsTable`` writes to the catalog. ``data_dictionary`` reports (column, type, comment,
non-null rows, rows) with one aggregation pass over the table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The table comment and the column comments of the gold ageing table.
TABLE_COMMENT = (
    "Stores and spares inventory aging for Cement plants. One row per item per plant. Contains current "
    "stock position, age since receipt, movement status, cost variance, and cross-plant redundancy flags. "
    "Values are Pakistani Rupees. Synthetic demo data."
)
COLUMN_COMMENTS: dict[str, str] = {
    "item_number": "Item code from the stores catalogue. The same item number can be stocked at more than one plant.",
    "item_description": "Plain-language description of the spare part.",
    "category_name": "Spare part category, for example refractory, bearings, conveyor, electrical.",
    "org_code": "Plant code. GCI = Grey Cement Iskanderabad, WCI = White Cement Iskanderabad, GCM = Grey Cement "
                "Mianwali. Users often say plant, site, or location to mean this.",
    "business_line": "Grey Cement or White Cement.",
    "region": "Geographic region of the plant.",
    "onhand_qty": "Current quantity physically in the stores.",
    "onhand_value_avg_cost": "DEFAULT MEASURE OF VALUE. Stock value in Rupees at moving average cost. When a user "
                             "says value, worth, or amount without qualification, use this column.",
    "onhand_value_last_cost": "Stock value at the most recent purchase price. Use only when the user explicitly "
                              "asks about last purchase price or replacement cost.",
    "average_cost": "Moving average unit cost.",
    "last_po_cost": "Unit price on the most recent purchase order.",
    "cost_variance_pct": "Percentage by which the last purchase price exceeds moving average cost. A high positive "
                         "value means prices are rising and the item is a procurement negotiation candidate.",
    "revaluation_exposure": "Rupee impact if all stock were revalued from average to last purchase cost.",
    "last_receipt_date": "Date the item was most recently received into stores.",
    "first_receipt_date": "Date the item was first ever received.",
    "days_since_receipt": "Days between the most recent goods receipt and the reporting date.",
    "last_issue_date": "Date the item was last issued out of stores for use.",
    "days_since_issue": "Days since the item was last consumed. Null means it has never been issued.",
    "issue_txn_count": "Number of times the item has been issued. Zero means never consumed.",
    "avg_monthly_consumption": "Average quantity consumed per month since first receipt.",
    "months_of_cover": "How many months current stock would last at average consumption. High values indicate "
                       "overstocking.",
    "aging_bucket_last_receipt": "DEFAULT AGING BUCKET. Age band measured from the most recent receipt: 0-90, "
                                 "91-180, 181-365, 366-730, over 730 days.",
    "aging_bucket_first_receipt": "Alternative age band measured from the original receipt. Use only if the user "
                                  "asks about original or first receipt.",
    "movement_status": "One of: Active, Slow Moving - 6m+, Non-Moving - 12m+, Dead Stock - Never Issued. Dead stock "
                       "means received but never once consumed.",
    "stocked_in_orgs": "Number of plants holding this item number. Greater than one indicates cross-plant "
                       "duplication.",
    "redistribution_candidate": "True when the item is dead stock at this plant and also stocked elsewhere, making "
                                "internal transfer possible instead of new purchase.",
}


def with_comments(df: DataFrame, comments: Mapping[str, str] = COLUMN_COMMENTS) -> DataFrame:
    """Attach ``comment`` metadata to the columns that have one (no data is touched)."""
    for name, text in comments.items():
        if name in df.columns:
            df = df.withMetadata(name, {"comment": text})
    return df


def data_dictionary(gold: DataFrame, comments: Mapping[str, str] = COLUMN_COMMENTS) -> DataFrame:
    """(column_name, ordinal, data_type, comment, non_null_rows, total_rows) for every column.

    One aggregation computes every column's fill count; ``stack`` turns the single wide row
    into one row per column, and the comments join as a literal map lookup.
    """
    cols = gold.columns
    counts = gold.agg(F.count("*").alias("__rows"), *[F.count(F.col(c)).alias(f"__nn{i}") for i, c in enumerate(cols)])
    stack_args = ", ".join(f"{i + 1}, '{c}', '{gold.schema[c].dataType.simpleString()}', __nn{i}"
                           for i, c in enumerate(cols))
    long = counts.selectExpr(
        f"stack({len(cols)}, {stack_args}) AS (ordinal, column_name, data_type, non_null_rows)", "__rows AS total_rows"
    )
    lookup = F.create_map(*[x for k, v in comments.items() for x in (F.lit(k), F.lit(v))])
    return long.select(
        "column_name",
        F.col("ordinal").cast("int").alias("ordinal"),
        "data_type",
        F.element_at(lookup, F.col("column_name")).alias("comment"),
        F.col("non_null_rows").cast("long").alias("non_null_rows"),
        F.col("total_rows").cast("long").alias("total_rows"),
    )


def stored_dictionary(manifest: DataFrame, table: str = "agg_stores_aging") -> DataFrame:
    """The same report of a published table from its run's manifest: types, comments and fill counts
    were taken while it was written, so no data is read."""
    one = manifest.filter(F.col("table_name") == table).select("row_count", F.posexplode("columns").alias("at", "c"))
    return one.select(F.col("c.name").alias("column_name"), (F.col("at") + 1).alias("ordinal"), F.col("c.type").alias("data_type"),
                      F.col("c.comment").alias("comment"), F.col("c.filled").alias("non_null_rows"), F.col("row_count").alias("total_rows"))
