"""Named queries: each ``(spark, sf_dir) -> DataFrame`` over the fixture tables at ``sf_dir``.

Outputs pass through ``comparable`` so the same values read the same in any engine:
decimals become DOUBLE (after exact decimal rounding), integer columns that can be NULL
DOUBLE, dates ISO text, and collected sets sorted comma-joined text. The library functions
themselves keep native types.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparesledger.functions.aging import age_bucket, movement_status
from sparesledger.operators import aging, checks, dictionary, recon, reports, security
from sparesledger.operators.silver import SILVER_TABLES
from sparesledger.plans.model import FIXTURE_AS_OF, Model
from sparesledger.plans.pipeline import LAYERS, land, read_bronze, run_pipeline
from sparesledger.plans.publish import manifest, read_layer
from sparesledger.session import remove_folder, stored, work_folder
from sparesledger.sources.bronze import add_audit_columns, write_extracts
from sparesledger.sources.schemas import SOURCE_TABLES

DRILL_PERIOD = "MAR-25"  # the reference drills MAR-26, a period the fixture does not have
CUSTOM_EDGES = (30, 60, 90, 180, 365)
NEVER_RECEIVED = "0. Never received"
SUMMARY_BY, SUMMARY_WHERE = ("site", "category"), "non-moving"


# Integer columns that can be NULL (left-joined profile values, one-sided periods). They are
# returned as DOUBLE: integer NULLs read differently across clients (NaN in a float column on
# one side, a nullable-integer NA on the other), a double NULL reads the same everywhere.
NULLABLE_INT_COLUMNS = frozenset({
    "days_since_receipt", "days_since_issue", "days_since_first_receipt",
    "issue_txn_count", "receipt_txn_count", "distinct_suppliers",
    "ap_distribution_count", "sla_link_count",
})


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType) or (isinstance(t, T.IntegralType) and f.name in NULLABLE_INT_COLUMNS):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.sort_array(c), ",")
        cols.append(c.alias(f.name))
    return df.select(cols)


_MODELS: dict[tuple[int, str, str], Model] = {}


def model(spark: SparkSession, sf_dir: str) -> Model:
    """One lazy model per (session, folder): queries share DataFrame objects, not results."""
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = Model.from_fixtures(spark, sf_dir, as_of=FIXTURE_AS_OF)
    return _MODELS[key]


def _q(build: Callable[[Model], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(model(spark, sf_dir)))

    run.__doc__ = build.__doc__
    return run


def _age_bucket(m: Model) -> DataFrame:
    g = m.stores_aging
    return g.select(
        "item_number", "org_id", "days_since_receipt",
        age_bucket(F.col("days_since_receipt"), CUSTOM_EDGES, NEVER_RECEIVED).alias("aging_bucket"),
    )


def _movement_status(m: Model) -> DataFrame:
    g = m.stores_aging
    return g.select(
        "item_number", "org_id", "issue_txn_count", "days_since_issue",
        movement_status(F.col("issue_txn_count"), F.col("days_since_issue"), 270, 90).alias("movement_status"),
    )


def _gold(m: Model) -> DataFrame:
    return m.stores_aging


def _fresh(m: Model, name: str) -> str:
    """A new folder for a query that writes, in the shared folder (its retention policy clears it)."""
    spark = m.source("hr_operating_units").sparkSession
    return f"{work_folder(spark).rstrip('/')}/sparesledger-queries/{name}-{uuid.uuid4().hex}"


def _csv_round_trip(m: Model) -> DataFrame:
    """The ageing table of extracts with four-place costs and three-place quantities that went
    through CSV files (columns in another order), the landing, silver and gold as they are stored. The files
    are compressed, and go when they are landed, as no later step reads them; tables are written one after the
    other, and the profile is stored before it is joined, so that few shuffle files are there at once."""
    item = F.col("INVENTORY_ITEM_ID")
    folder = _fresh(m, "csv")
    sources = m.stored(f"{folder}/made").sources(SOURCE_TABLES)
    costs, onhand, txn = (sources[t] for t in ("cst_item_costs", "mtl_onhand_quantities_detail", "mtl_material_transactions"))
    finer = {
        "cst_item_costs": costs.withColumns({
            "ITEM_COST": F.when(F.col("ITEM_COST") == 0, F.col("ITEM_COST")).otherwise(F.col("ITEM_COST") + (item % 9973) / F.lit(10_000)),
            "LAST_PO_COST": F.col("LAST_PO_COST") + (item * 7 % 9973) / F.lit(10_000)}),
        "mtl_onhand_quantities_detail": onhand.withColumn(
            "PRIMARY_TRANSACTION_QUANTITY", F.col("PRIMARY_TRANSACTION_QUANTITY") + (item % 997) / F.lit(1_000)),
        "mtl_material_transactions": txn.withColumn("PRIMARY_QUANTITY", F.col("PRIMARY_QUANTITY") * F.lit(1125) / F.lit(1_000)),
    }
    text = {t: df.select([F.col(c).cast("decimal(18,4)").alias(c) if c in ("ITEM_COST", "LAST_PO_COST") else
                          F.col(c).cast("decimal(18,3)").alias(c) if c.endswith("QUANTITY") else F.col(c) for c in reversed(df.columns)])
            for t, df in (sources | finer).items()}
    write_extracts(text, f"{folder}/landing", compression="gzip")
    spark, root, how = costs.sparkSession, f"{folder}/root", {"as_of": m.as_of, "edges": m.edges}
    remove_folder(spark, f"{folder}/made")
    land(spark, f"{folder}/landing", root)
    remove_folder(spark, f"{folder}/landing")
    bronze = read_bronze(spark, root)
    run_pipeline(spark, Model(bronze, **how), root, layers=("silver",), parallelism=1)
    silver = read_layer(spark, root, "silver")
    profile = stored(aging.txn_profile(silver["fact_material_txn"]), f"{folder}/profile")
    run_pipeline(spark, Model(bronze, silver_tables=silver, profile=profile, **how), root, layers=("gold",), parallelism=1)
    remove_folder(spark, f"{folder}/profile")
    return read_layer(spark, root, "gold", ["agg_stores_aging"])["agg_stores_aging"]


def _bronze_audit_counts(m: Model) -> DataFrame:
    """Rows of every extract, those with a load time and those of the source system, in one pass each."""
    parts = [add_audit_columns(df).agg(F.lit(t).alias("table_name"), F.count("*").alias("row_count"), F.count("_ingest_ts").alias("timed"),
                                       F.count_if(F.col("_source_system") == "EBS_R12").alias("tagged"))
             for t, df in m.sources(SOURCE_TABLES).items()]
    return reduce(DataFrame.unionByName, parts)


def _layer_manifest(m: Model) -> DataFrame:
    """Rows of every table of the three layers and the sum of each money or quantity column, from
    the manifests of a run that wrote them."""
    spark, folder = m.source("hr_operating_units").sparkSession, _fresh(m, "layers")
    root = run_pipeline(spark, m.stored(folder), folder, LAYERS)
    lines = [manifest(spark, root, layer) for layer in LAYERS]
    all_lines = lines[0].unionByName(lines[1]).unionByName(lines[2])
    return all_lines.select("layer", "table_name", "row_count", F.explode_outer("sums").alias("column_name", "total")).withColumn(
        "total", F.col("total").cast("decimal(38,5)"))


QUERY_BUILDERS: dict[str, Callable[[Model], DataFrame]] = {
    # sources and bronze
    "bronze_audit": lambda m: add_audit_columns(m.source("mtl_system_items_b")).drop("_ingest_ts"),
    "bronze_audit_counts": _bronze_audit_counts,
    "csv_round_trip": _csv_round_trip,
    "layer_manifest": _layer_manifest,
    "data_dictionary": lambda m: dictionary.data_dictionary(m.stores_aging),
    # functions shown on their own
    "age_bucket": _age_bucket,
    "movement_status": _movement_status,
    # silver
    "dim_account": lambda m: m.dim_account,
    "dim_organization": lambda m: m.dim_organization,
    "dim_item": lambda m: m.dim_item,
    "fact_material_txn": lambda m: m.fact_material_txn.drop("transaction_id"),
    "fact_ap_distribution": lambda m: m.fact_ap_distribution,
    "fact_gl_line": lambda m: m.fact_gl_line,
    "bridge_sla_gl": lambda m: m.bridge_sla_gl,
    # gold
    "txn_profile": lambda m: aging.txn_profile(m.fact_material_txn),
    "txn_profile_merged": lambda m: aging.merged_profile(aging.profile_parts(m.fact_material_txn)),
    "redundancy": lambda m: aging.redundancy(m.dim_item, plants=m.plants),
    "stores_aging": _gold,
    "stores_aging_cutoff": lambda m: aging.stores_aging(
        m.dim_item, m.source("mtl_onhand_quantities_detail"), m.source("cst_item_costs"), m.fact_material_txn,
        as_of=_dt.date(2024, 12, 31), cutoff=True, basis="onhand", plants=m.plants),
    # ageing reports
    "aging_by_bucket": lambda m: reports.aging_by_bucket(_gold(m)),
    "redistribution_list": lambda m: reports.redistribution_list(_gold(m), plants=m.plant_codes),
    "procurement_list": lambda m: reports.procurement_list(_gold(m)),
    "dead_stock_total": lambda m: reports.dead_stock_total(_gold(m)),
    "value_by_plant_bucket": lambda m: reports.value_by_plant_bucket(_gold(m)),
    "dead_here_active_there": lambda m: reports.dead_here_active_there(_gold(m), plants=m.plant_codes),
    "price_rise_by_category": lambda m: reports.price_rise_by_category(_gold(m)),
    "nonmoving_by_category": lambda m: reports.nonmoving_by_category(_gold(m)),
    "stock_summary": lambda m: reports.stock_summary(_gold(m), by=SUMMARY_BY, where=SUMMARY_WHERE),
    "movement_mix": lambda m: reports.movement_mix(_gold(m)),
    "stock_kpis": lambda m: reports.stock_kpis(_gold(m), plants=m.plant_codes),
    "cost_variance_by_category": lambda m: reports.cost_variance_by_category(_gold(m)),
    # reconciliation
    "recon_ap_to_gl": lambda m: m.recon_ap_to_gl,
    "recon_report": lambda m: recon.recon_report(m.recon_ap_to_gl),
    "recon_detail": lambda m: recon.recon_ap_to_gl(
        m.fact_ap_distribution, m.dim_organization, m.bridge_sla_gl, m.fact_gl_line, m.dim_account, detail=True),
    "ap_by_period_plant": lambda m: recon.ap_side(m.fact_ap_distribution, m.dim_organization, by_plant=True),
    "gl_drill_through": lambda m: recon.gl_drill_through(
        m.fact_ap_distribution, m.bridge_sla_gl, m.dim_account, DRILL_PERIOD),
    "variance_trend": lambda m: recon.variance_trend(m.recon_ap_to_gl),
    # security
    "secured_view": lambda m: security.secured_view(_gold(m), "GCI"),
    "visibility_check_board": lambda m: security.visibility_check(_gold(m), "BOARD"),
    "visibility_check_gci": lambda m: security.visibility_check(_gold(m), "GCI"),
    "visibility_check_unknown": lambda m: security.visibility_check(_gold(m), "AUDITOR"),
    "row_filter_by_map": lambda m: security.row_filter_by_map(_gold(m), m.source("org_security_map"), "dual_user"),
    # checks
    "check_landing": lambda m: checks.check_landing(m.sources(SOURCE_TABLES), SOURCE_TABLES),
    "check_layer_tables": lambda m: checks.check_layer_tables(m.silver_tables(), SILVER_TABLES),
    "check_journal_balance": lambda m: checks.check_journal_balance(m.fact_gl_line),
    "check_bridge_coverage": lambda m: checks.check_bridge_coverage(m.fact_ap_distribution, m.bridge_sla_gl),
    "check_recon": lambda m: checks.check_recon(m.recon_ap_to_gl),
    "check_bucket_spread": lambda m: checks.check_bucket_spread(reports.aging_by_bucket(_gold(m))),
    "check_findings": lambda m: checks.check_findings(_gold(m)),
    "check_grain": lambda m: checks.check_grain(_gold(m)),
    "check_cost_grain": lambda m: checks.check_cost_grain(m.source("cst_item_costs")),
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _q(v) for k, v in QUERY_BUILDERS.items()}
