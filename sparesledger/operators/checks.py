"""Data checks as Spark jobs; each returns a DataFrame (empty or all-passing when healthy)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparesledger.functions.aging import DEAD_STOCK
from sparesledger.functions.money import div_round
from sparesledger.operators.recon import RECONCILED


def _counts(tables: Mapping[str, DataFrame], expected: Sequence[str], label: str) -> DataFrame:
    """Row count per expected table, unioned; tables missing from ``tables`` report ``present = false``."""
    parts = []
    spark = None
    for name in expected:
        df = tables.get(name)
        if df is None:
            continue
        spark = df.sparkSession
        parts.append(df.agg(F.lit(name).alias(label), F.count("*").alias("row_count")))
    missing = [n for n in expected if n not in tables]
    if spark is None:
        raise ValueError("none of the expected tables is available")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if missing:  # one row per missing name (bounded by the expected list)
        out = out.unionByName(
            spark.createDataFrame([(n, None) for n in missing], f"{label} string, row_count bigint")
        )
    return out.withColumn("present", F.coalesce(F.col("row_count") > 0, F.lit(False)))


def check_landing(sources: Mapping[str, DataFrame], expected: Sequence[str]) -> DataFrame:
    """Every expected extract landed, with its row count."""
    return _counts(sources, expected, "table_name")


def check_landing_files(spark, landing_dir: str, expected: Sequence[str], ext: str = "csv") -> DataFrame:
    """Files per expected extract in the landing folder (a listing, no file is read).

    Accepts ``{table}.{ext}`` files and ``{table}.{ext}/`` folders of part files. The listing
    is a ``binaryFile`` scan with only path and length selected, so contents are pruned; the
    expected list (one row per extract) is outer-joined so missing extracts show up.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*.{ext}").load(landing_dir).select("path", "length")
    )
    in_folder = F.regexp_extract("path", rf"/([^/]+)\.{ext}/[^/]+$", 1)
    as_file = F.regexp_extract("path", rf"/([^/]+)\.{ext}$", 1)
    table = F.when(in_folder != "", in_folder).otherwise(as_file)
    found = listing.groupBy(table.alias("table_name")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"))
    want = spark.createDataFrame([(t,) for t in expected], "table_name string")
    return (
        want.join(found, "table_name", "left")
        .select("table_name", F.coalesce("files", F.lit(0)).alias("files"),
                F.coalesce("bytes", F.lit(0)).alias("bytes"), (F.coalesce("files", F.lit(0)) > 0).alias("present"))
    )


def check_layer_tables(silver: Mapping[str, DataFrame], expected: Sequence[str]) -> DataFrame:
    """The silver layer holds its tables (seven in the reference), with row counts."""
    return _counts(silver, expected, "table_name")


def check_manifest(manifest: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Every expected table of a published layer with its rows, rejected rows and bytes, from the
    manifest its run wrote (no table is read); a table that is not in it has ``present = false``."""
    want = manifest.sparkSession.createDataFrame([(t,) for t in expected], "table_name string")
    have = manifest.select("table_name", "row_count", "rejected", "bytes")
    return want.join(have, "table_name", "left").withColumn("present", F.coalesce(F.col("row_count") > 0, F.lit(False)))


def check_journal_balance(fact_gl_line: DataFrame) -> DataFrame:
    """Journals whose debits and credits differ (a balanced ledger returns no rows)."""
    dr = F.coalesce(F.sum("accounted_dr"), F.lit(0))
    cr = F.coalesce(F.sum("accounted_cr"), F.lit(0))
    return (
        fact_gl_line.groupBy("je_header_id", "period_name", "je_source")
        .agg(dr.alias("total_dr"), cr.alias("total_cr"))
        .withColumn("imbalance", F.col("total_dr") - F.col("total_cr"))
        .filter(F.col("imbalance") != 0)
    )


def check_bridge_coverage(fact_ap_distribution: DataFrame, bridge: DataFrame) -> DataFrame:
    """Distributions without a link (UNLINKED), ids linked more than once (DUPLICATE) and links
    without a distribution (ORPHAN), with the id's link count.

    Both sides are tagged and counted per id in one shuffle. A NULL id matches nothing: NULL
    distributions are UNLINKED and NULL links ORPHAN, one row each.
    """
    tagged = fact_ap_distribution.select("invoice_distribution_id", F.lit(1).alias("_d"), F.lit(0).alias("_b")).unionByName(
        bridge.select("invoice_distribution_id", F.lit(0).alias("_d"), F.lit(1).alias("_b")))
    seen = tagged.groupBy("invoice_distribution_id").agg(F.sum("_d").alias("_d"), F.sum("_b").alias("_b"))
    unknown = F.col("invoice_distribution_id").isNull()
    none, links = F.lit(0).cast("long"), F.col("_b")
    issue = lambda when, name, n: F.when(when, F.struct(F.lit(name).alias("issue"), n.alias("link_count")))
    found = F.array_compact(F.array(
        issue((F.col("_d") > 0) & ((links == 0) | unknown), "UNLINKED", none),
        issue((links > 1) & ~unknown, "DUPLICATE", links),
        issue((links > 0) & ((F.col("_d") == 0) | unknown), "ORPHAN", links),
    ))
    return seen.select("invoice_distribution_id", F.explode(found).alias("found")).select(
        "invoice_distribution_id", "found.issue", "found.link_count")


def check_recon(recon: DataFrame) -> DataFrame:
    """Periods that do not reconcile (the reference expects none)."""
    return recon.filter(F.col("status") != RECONCILED)


def check_bucket_spread(by_bucket: DataFrame, uniform_spread: float = 0.05) -> DataFrame:
    """Share of lines per bucket and whether the buckets look uniform (a sign of a partial load).

    The window runs over the bucket summary -- one row per bucket -- not over the data.
    """
    w = Window.partitionBy()
    share = div_round(F.col("stock_lines"), F.sum("stock_lines").over(w), 4, "decimal(18,0)", "decimal(18,0)").cast("decimal(10,4)")
    return (
        by_bucket.select("aging_bucket", "stock_lines", share.alias("line_share"))
        .withColumn(
            "looks_uniform",
            (F.max("line_share").over(w) - F.min("line_share").over(w)) < uniform_spread,
        )
    )


def check_findings(gold: DataFrame, variance_threshold: float = 15) -> DataFrame:
    """The three planted findings are present: dead stock, shared items, price rises."""
    shared_items = F.count_distinct(F.when(F.col("stocked_in_orgs") > 1, F.col("item_number")))
    dead = F.count_if(F.col("movement_status") == DEAD_STOCK)
    rises = F.count_if(F.col("cost_variance_pct") > variance_threshold)
    return gold.agg(
        dead.alias("dead_stock_lines"),
        shared_items.alias("multi_plant_items"),
        rises.alias("variance_findings"),
    ).select(
        "*",
        ((F.col("dead_stock_lines") > 0) & (F.col("multi_plant_items") > 0) & (F.col("variance_findings") > 0))
        .alias("all_present"),
    )


def check_grain(gold: DataFrame, keys: Sequence[str] = ("item_number", "org_id")) -> DataFrame:
    """Keys that occur more than once in the gold table (one row per item x plant expected)."""
    return gold.groupBy(*keys).agg(F.count("*").alias("row_count")).filter(F.col("row_count") > 1)


def check_cost_grain(costs: DataFrame) -> DataFrame:
    """Item x plant pairs with several cost rows; each of them would make a line of its own in gold."""
    return costs.groupBy(F.col("INVENTORY_ITEM_ID").alias("inventory_item_id"), F.col("ORGANIZATION_ID").alias("org_id")).agg(
        F.count("*").alias("row_count")).filter(F.col("row_count") > 1)
