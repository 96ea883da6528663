"""The batch job as a ``spark-submit`` application.

    spark-submit --py-files sparesledger.zip scripts/run_job.py \\
        --landing s3://bucket/landing --root s3://bucket/warehouse --as-of 2026-06-30 --reports

Lands every extract from ``--landing`` (declared schemas, CSV by default; ``--format jdbc`` with
``--option url=...`` reads them from a database), publishes bronze/silver/gold under ``--root``
(default: under ``spark.checkpoint.dir``), and with ``--reports`` writes the report and dashboard
data sets under ``{root}/reports``. The landing and layer checks, from the manifests, go to
``{root}/checks``. Rows that do not fit go to ``rejected_rows``; with more of
them than ``--max-reject-share`` the job fails and the previous run stays current. The session
comes from the cluster (``getOrCreate``); the job sets no cluster configuration.
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from sparesledger.operators import checks, recon, reports, security
from sparesledger.operators.dictionary import TABLE_COMMENT
from sparesledger.operators.silver import SILVER_TABLES
from sparesledger.plans.model import Model
from sparesledger.plans.pipeline import default_root, land, read_bronze, register_layer, run_pipeline
from sparesledger.plans.publish import manifest
from sparesledger.plans.views import register_sql
from sparesledger.sources.schemas import LANDING_TABLES

REPORTS: dict[str, Callable[[Model], DataFrame]] = {
    "aging_by_bucket": lambda m: reports.aging_by_bucket(m.stores_aging),
    "redistribution_list": lambda m: reports.redistribution_list(m.stores_aging, plants=m.plant_codes),
    "procurement_list": lambda m: reports.procurement_list(m.stores_aging),
    "nonmoving_by_category": lambda m: reports.nonmoving_by_category(m.stores_aging),
    "value_by_plant_bucket": lambda m: reports.value_by_plant_bucket(m.stores_aging),
    "movement_mix": lambda m: reports.movement_mix(m.stores_aging),
    "stock_kpis": lambda m: reports.stock_kpis(m.stores_aging, plants=m.plant_codes),
    "cost_variance_by_category": lambda m: reports.cost_variance_by_category(m.stores_aging),
    "recon_report": lambda m: recon.recon_report(m.recon_ap_to_gl),
    "variance_trend": lambda m: recon.variance_trend(m.recon_ap_to_gl),
    "visibility_board": lambda m: security.visibility_check(m.stores_aging, security.BOARD),
    "check_recon": lambda m: checks.check_recon(m.recon_ap_to_gl),
    "check_findings": lambda m: checks.check_findings(m.stores_aging),
    "check_grain": lambda m: checks.check_grain(m.stores_aging),
}


def parse_args(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="sparesledger-job", description=__doc__.split("\n\n")[0])
    p.add_argument("--landing", default=None, help="folder holding {table}.{format} extracts (not for jdbc)")
    p.add_argument("--format", default="csv", help="extract format (csv, json, parquet, jdbc, ...)")
    p.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="reader option, such as the JDBC url")
    p.add_argument("--table-option", action="append", default=[], metavar="TABLE.KEY=VALUE",
                   help="reader option of one extract, such as its dbtable or partitionColumn")
    p.add_argument("--type", action="append", default=[], metavar="TABLE.COLUMN=TYPE",
                   help="type of a column instead of the declared one, such as cst_item_costs.ITEM_COST=decimal(20,8)")
    p.add_argument("--max-reject-share", type=float, default=0.0, help="share of an extract's rows that may not fit")
    p.add_argument("--root", default=None,
                   help="warehouse root (default: {spark.checkpoint.dir}/sparesledger-warehouse/as_of=<date>)")
    p.add_argument("--as-of", default=None, help="reporting date YYYY-MM-DD (default: today)")
    p.add_argument("--catalog-prefix", default=None, help="also register layers as databases {prefix}bronze ...")
    p.add_argument("--table-comment", default=TABLE_COMMENT, help="comment of the ageing table in the catalog")
    p.add_argument("--bridge-buckets", type=int, default=None, help="store distributions and links in so many buckets by distribution id")
    p.add_argument("--cost-type", default=None, help="take the costs of this COST_TYPE_ID only")
    p.add_argument("--reports", action="store_true", help="write report and dashboard data sets")
    p.add_argument("--parallelism", type=int, default=4, help="concurrent table writes within a layer")
    args = p.parse_args(argv)
    if args.format != "jdbc" and not args.landing:
        p.error("--landing is needed unless --format is jdbc")
    return args


def _pairs(texts: Sequence[str]) -> dict[str, str]:
    out = {}
    for t in texts:
        key, sign, value = t.partition("=")
        if not sign or not key:
            raise ValueError(f"not KEY=VALUE: {t!r}")
        out[key] = value
    return out


def _by_table(texts: Sequence[str]) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = {}
    for key, value in _pairs(texts).items():
        table, dot, rest = key.partition(".")
        if not dot or not rest:
            raise ValueError(f"not TABLE.KEY=VALUE: {key!r}")
        out.setdefault(table, {})[rest] = value
    return out


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else dt.date.today()
    root = (args.root or default_root(spark, as_of)).rstrip("/")  # one root per as-of date
    land(spark, args.landing, root, fmt=args.format, options=_pairs(args.option), table_options=_by_table(args.table_option),
         types=_by_table(args.type), max_reject_share=args.max_reject_share, parallelism=args.parallelism)
    if args.catalog_prefix is not None:
        register_layer(spark, root, "bronze", args.catalog_prefix)
    run_pipeline(spark, Model(read_bronze(spark, root), as_of=as_of, cost_type=args.cost_type), root, layers=("silver", "gold"),
                 parallelism=args.parallelism, catalog_prefix=args.catalog_prefix, bridge_buckets=args.bridge_buckets,
                 table_comment=args.table_comment)
    if args.catalog_prefix is not None:
        register_sql(spark, args.catalog_prefix)
    for name, layer, expected in (("check_landing", "bronze", LANDING_TABLES), ("check_layer_tables", "silver", SILVER_TABLES)):
        found = checks.check_manifest(manifest(spark, root, layer), expected)  # what the run counted: no table is read
        found.write.mode("overwrite").parquet(f"{root}/checks/{name}")
    if args.reports:
        stored = Model.from_warehouse(spark, root, as_of=as_of)
        # most reports scan the gold table: keep it for the batch (a lost executor re-reads
        # its blocks from the stored parquet), release it afterwards
        gold = stored.stores_aging.persist(StorageLevel.MEMORY_AND_DISK)
        stored._gold["agg_stores_aging"] = gold
        try:
            for name, build in REPORTS.items():
                build(stored).write.mode("overwrite").parquet(f"{root}/reports/{name}")
        finally:
            gold.unpersist()
    return root


def main(argv: Sequence[str] | None = None) -> None:
    args = parse_args(argv)
    spark = SparkSession.builder.appName("sparesledger-job").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")  # dates of timestamps hang on it
    print(run(spark, args))


if __name__ == "__main__":
    main()
