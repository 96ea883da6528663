"""The batch job: sources -> bronze -> silver -> gold, written as parquet under one root.

Each layer of a run is written as a new version and published at once (``plans.publish``), so
readers see whole layers of one run, and a failed run changes nothing. The root must be shared
storage on a cluster; by default it is a folder under the session's ``spark.checkpoint.dir``.
Writing the layers also cuts lineage: reports built with ``Model.from_warehouse`` plan from the
stored tables, not from the sources.

The material transaction fact is written partitioned by ``txn_year_month`` and the gold
ageing table by ``org_code``, each behind a ``rebalance`` hint on that key: AQE sizes the
write tasks (a hot month or plant is split, small ones are merged), so there is neither a
small-file storm nor one task per key. Month filters and persona filters then prune
partitions on read.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparesledger.functions.periods import as_of_date
from sparesledger.operators.dictionary import TABLE_COMMENT, with_comments
from sparesledger.operators.silver import SILVER_TABLES
from sparesledger.plans.model import Model
from sparesledger.plans.publish import Buckets, Written, current, manifest, new_version, publish, read_layer, version_path, write_table
from sparesledger.session import ensure_checkpoint_dir, hadoop_path, shuffles_removed
from sparesledger.sources.bronze import (
    Types, add_audit_columns, extract_options, extract_path, good_rows, rejects, split_extract,
)
from sparesledger.sources.conform import PROBLEMS
from sparesledger.sources.ranges import LARGE, planned_ranges
from sparesledger.sources.schemas import AUDIT_COLUMNS, LANDING_TABLES, SOURCE_KEYS, SOURCE_TABLES

LAYERS = ("bronze", "silver", "gold")
GOLD_TABLES = ("agg_stores_aging", "recon_ap_to_gl")
# Partition columns: the transaction fact by month (lookback/cutoff filters prune months);
# the gold ageing table by plant (persona views and per-plant reports read one plant's files).
PARTITIONED = {"fact_material_txn": "txn_year_month", "agg_stores_aging": "org_code"}
#: Joined on the distribution id; ``bridge_buckets`` stores them bucketed by it.
BRIDGED, BRIDGE_KEY = ("fact_ap_distribution", "bridge_sla_gl"), "invoice_distribution_id"
#: The table of rows that did not fit, in a bronze version that has any.
REJECTED = "rejected_rows"


def default_root(spark: SparkSession, as_of=None) -> str:
    """``{spark.checkpoint.dir}/sparesledger-warehouse[/as_of=<date>]``; raises when unset.

    Runs for different as-of dates (a backfill beside the daily run) get separate roots.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/") + "/sparesledger-warehouse"
    day = _as_of_day(as_of)
    return f"{root}/as_of={day.isoformat()}" if day else root


def _as_of_day(as_of) -> _dt.date | None:
    """The as-of date of a run for its folder name; an expression has none, so it is refused."""
    if as_of is None:
        return None
    day = as_of_date(as_of)
    if isinstance(day, Column):
        raise ValueError("as_of is an expression: pass an explicit root for this run")
    return day


def publish_tables(spark: SparkSession, root: str, layer: str, tables: Mapping[str, DataFrame], parallelism: int = 4,
                   buckets: Mapping[str, Buckets] | None = None) -> str:
    """Write the independent tables of a layer concurrently (one Spark job each) into a new version
    and publish it; a failed write raises and nothing is published.

    Small dimension writes would otherwise leave the cluster idle between jobs; the big fact
    writes still spread over every executor. A table's shuffle files go when it is written.
    """
    version = new_version()
    path = version_path(root, layer, version)
    with shuffles_removed(spark), ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        jobs = [pool.submit(write_table, df, f"{path}/{t}", PARTITIONED.get(t), buckets=(buckets or {}).get(t), fills=layer == "gold") for t, df in tables.items()]
        written = [j.result() for j in jobs]
    publish(spark, root, layer, version, written)
    return version


class RejectedRows(ValueError):
    """More rows of an extract did not fit than the load allows."""


def land(spark: SparkSession, landing: str | None, root: str, tables: Sequence[str] = LANDING_TABLES,
         optional: Iterable[str] | None = None, fmt: str = "csv", options: Mapping[str, str] | None = None,
         table_options: Mapping[str, Mapping[str, str]] | None = None, types: Types | None = None,
         max_reject_share: float = 0.0, parallelism: int = 4) -> str:
    """Load the extracts of a landing zone into a new bronze version under ``root``; its name.

    ``{landing}/{table}.{fmt}`` must be there for every table but the ``optional`` ones (default:
    those that no later layer reads); absent ones raise ``FileNotFoundError`` before anything is
    read. Rows with a value that does not fit its type, and malformed lines, go to the table
    ``rejected_rows`` (extract, file, problems, source row); all others are loaded. If more than
    ``max_reject_share`` of an extract's rows are bad, the load raises ``RejectedRows`` and the
    previous version stays current; the rejected rows can be read in the unpublished folder that
    the error names. Bad rows are counted while the good ones are written; only an extract that
    has some is read again for them.

    With ``fmt='jdbc'``, ``options`` holds the connection and ``table_options`` what belongs to one
    extract (its ``dbtable`` or ``query``; optional extracts are read if they are named here). The
    extracts that grow with the business (``ranges.LARGE``) are read by ranges of their key, which
    ``planned_ranges`` cuts, unless their options state a partitioning; a ``query`` of one without
    is refused.
    """
    tables = list(tables)
    optional = set(LANDING_TABLES) - set(SOURCE_TABLES) if optional is None else set(optional)
    if fmt == "jdbc":
        there = [t for t in tables if t not in optional or t in (table_options or {})]
        if len(there) > 1 and {k.lower() for k in (options or {})} & {"dbtable", "query"}:
            raise ValueError("dbtable/query name one extract: give them per table in table_options")
    else:
        fs, _ = hadoop_path(spark, landing)
        there = [t for t in tables if fs.exists(hadoop_path(spark, extract_path(landing, t, fmt))[1])]
        missing = [t for t in tables if t not in there and t not in optional]
        if missing:
            raise FileNotFoundError(f"{landing} lacks the extracts {', '.join(missing)}")
    ranges = _key_ranges(spark, root, there, options, table_options) if fmt == "jdbc" else {}
    version = new_version()
    path = version_path(root, "bronze", version)

    def load(t: str) -> tuple[Written, DataFrame]:
        opts = extract_options(t, fmt, options, table_options)
        by_range = {"predicates": ranges[t]} if t in ranges else {}
        split = split_extract(spark, t, extract_path(landing, t, fmt), fmt, opts, (types or {}).get(t), **by_range)
        seen = Observation()
        counted = split.observe(seen, F.count_if(F.size(PROBLEMS) > 0).alias("bad"))
        return write_table(add_audit_columns(good_rows(counted)), f"{path}/{t}", rejected=seen), split

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        loaded = list(pool.map(load, there))
    bad = [(w, split) for w, split in loaded if w.rejected]
    written = [w for w, _ in loaded]
    if bad:
        rows = reduce(DataFrame.unionByName, [rejects(split, w.table_name) for w, split in bad])
        written.append(write_table(rows, f"{path}/{REJECTED}"))
    over = [w for w, _ in bad if w.rejected > max_reject_share * (w.row_count + w.rejected)]
    if over:
        told = ", ".join(f"{w.table_name} {w.rejected} of {w.row_count + w.rejected}" for w in over)
        raise RejectedRows(f"rows that do not fit: {told} (allowed share {max_reject_share:g}); see {path}/{REJECTED}")
    publish(spark, root, "bronze", version, written)
    return version


def _key_ranges(spark: SparkSession, root: str, tables: Iterable[str], options: Mapping[str, str] | None,
                table_options: Mapping[str, Mapping[str, str]] | None) -> dict[str, list[str]]:
    """The range predicates of the large extracts that state no partitioning of their own."""
    out = {}
    last = {r.table_name: r.row_count for r in manifest(spark, root, "bronze").select("table_name", "row_count").collect()} if current(spark, root, "bronze") else {}
    for t in set(tables) & set(LARGE):
        opts = extract_options(t, "jdbc", options, table_options)
        keys = {k.lower() for k in opts}
        if "partitioncolumn" in keys:
            continue
        if "query" in keys:
            raise ValueError(f"{t} would be read by one task: give its query a partitionColumn, or a dbtable")
        stored = read_bronze(spark, root, [t])[t] if t in last else None
        out[t] = planned_ranges(spark, t, SOURCE_KEYS[t][0], opts, stored, last.get(t))
    return out


def run_pipeline(spark: SparkSession, model: Model, root: str | None = None, layers=LAYERS,
                 parallelism: int = 4, catalog_prefix: str | None = None, bridge_buckets: int | None = None,
                 table_comment: str = TABLE_COMMENT) -> str:
    """Materialise the layers of ``model`` under ``root`` (full refresh); return the root.

    Layers run in order (silver reads the stored bronze, gold the stored silver), each published
    as one version when all its tables are written. The default root is
    ``default_root(spark, model.as_of)``. With ``catalog_prefix`` (``''`` for plain
    ``bronze``/``silver``/``gold``) each table of a published layer is also registered as an
    external table (``{prefix}{layer}.{table}``) at its version's path: the catalog names point
    at the latest run, dropping them leaves the files, and a fresh catalog re-registers them on
    the next run.

    ``bridge_buckets`` stores the distributions and their links in that many buckets by distribution
    id (about one per 256 MB of the larger table): read through the catalog
    (``Model.from_catalog``), the tie-out and the drill-through join them without a shuffle. A join
    of buckets cannot be split, so leave it off where one id may hold a large share of the links.
    """
    bucketed = {t: Buckets(BRIDGE_KEY, bridge_buckets) for t in BRIDGED} if bridge_buckets else {}
    root = (root or default_root(spark, model.as_of)).rstrip("/")

    def write(layer: str, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        version = publish_tables(spark, root, layer, tables, parallelism, bucketed)
        if catalog_prefix is not None:
            register_layer(spark, root, layer, catalog_prefix, version, table_comment)
        return read_layer(spark, root, layer, version=version)

    if "bronze" in layers:
        landed = write("bronze", {t: add_audit_columns(df) for t, df in model.sources(SOURCE_TABLES).items()})
        # later layers read the bronze this run wrote (never another run's tables, nor the
        # silver or gold of the version before)
        if "silver" in layers:
            model = Model({t: df.drop(*AUDIT_COLUMNS) for t, df in landed.items()}, as_of=model.as_of, edges=model.edges,
                          **model.aging_options)
    if "silver" in layers:
        silver = write("silver", {t: getattr(model, t) for t in SILVER_TABLES})
        model = Model(model._sources, as_of=model.as_of, edges=model.edges, silver_tables=silver, **model.aging_options)
    if "gold" in layers:
        write("gold", {"agg_stores_aging": with_comments(model.stores_aging), "recon_ap_to_gl": model.recon_ap_to_gl})
    return root


def register_layer(spark: SparkSession, root: str, layer: str, prefix: str = "", version: str | None = None,
                   table_comment: str = TABLE_COMMENT) -> None:
    """Point the catalog names ``{prefix}{layer}.{table}`` at a published version (default: the
    current one), as external tables with their column comments; the ageing table gets ``table_comment``.

    A name whose schema did not change is moved in one step; others, and partitioned tables, are
    dropped and created anew, which readers of that name may notice. Readers by path
    (``Model.from_warehouse``) always see whole layers.
    """
    database = f"{prefix}{layer}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root}/{layer}'")
    version = version or current(spark, root, layer)
    stored_in = {r.table_name: (r.bucket_column, r.bucket_count) for r in manifest(spark, root, layer, version).collect() if r.bucket_column}
    for t, df in read_layer(spark, root, layer, version=version).items():
        name, path, part = f"{database}.{t}", f"{version_path(root, layer, version)}/{t}", PARTITIONED.get(t)
        if not part and t not in stored_in and spark.catalog.tableExists(name) and spark.table(name).schema == df.schema:
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
            continue
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{_quoted(f.metadata['comment'])}'" if "comment" in f.metadata else "")
                            for f in df.schema.fields)
        parted = f" PARTITIONED BY (`{part}`)" if part else ""
        if t in stored_in:
            column, count = stored_in[t]
            parted += f" CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {count} BUCKETS"
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{parted} LOCATION '{path}'")
        if part:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        if t == "agg_stores_aging":
            spark.sql(f"COMMENT ON TABLE {name} IS '{_quoted(table_comment)}'")


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def read_bronze(spark: SparkSession, root: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    """The current bronze extracts (all, or ``names``) without their audit columns."""
    tables = read_layer(spark, root.rstrip("/"), "bronze", names)
    return {t: df.drop(*AUDIT_COLUMNS) for t, df in tables.items() if t != REJECTED}


def read_layers(spark: SparkSession, root: str, read_gold: bool = True):
    """Bronze, silver and gold tables of the current versions; ``FileNotFoundError`` if no layer was
    ever published under ``root``."""
    root = root.rstrip("/")
    bronze, silver = read_bronze(spark, root), read_layer(spark, root, "silver")
    gold = read_layer(spark, root, "gold") if read_gold else {}
    if not (bronze or silver or gold):
        raise FileNotFoundError(f"no published layer under {root}")
    return bronze, silver, gold


def month_slice(fact: DataFrame, first_month: str, last_month: str) -> DataFrame:
    """Transactions between two ``yyyy-MM`` months; on the stored fact this prunes partitions."""
    return fact.filter(F.col("txn_year_month").between(first_month, last_month))
