"""Bronze round trip (CSV with explicit schema), the layered pipeline job, streaming landing."""

from __future__ import annotations

import pytest

import os
import re
from decimal import Decimal

from pyspark.sql import functions as F

from sparesledger.operators.silver import SILVER_TABLES
from sparesledger.plans.model import FIXTURE_AS_OF, Model
from sparesledger.plans.pipeline import month_slice, run_pipeline
from sparesledger.plans.publish import layer_path
from sparesledger.plans.registry import comparable
from sparesledger.sources.bronze import land_bronze, read_extract, write_extracts
from sparesledger.sources.fixtures import Fixtures
from sparesledger.streaming import land_incrementally

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in comparable(df).collect())


def test_csv_round_trip_keeps_leading_zeros(spark, scratch):
    fx = Fixtures(spark, SF_SMALL)
    write_extracts({"gl_code_combinations": fx.gl_code_combinations}, scratch)
    back = read_extract(spark, "gl_code_combinations", f"{scratch}/gl_code_combinations.csv")
    segs = {r.SEGMENT1 for r in back.select("SEGMENT1").collect()} | {r.SEGMENT4 for r in back.collect()}
    assert "01" in segs and "000" in segs  # declared strings: no integer inference
    assert _rows(back) == _rows(fx.gl_code_combinations)


def test_land_bronze_adds_audit_columns(spark, scratch):
    fx = Fixtures(spark, SF_SMALL)
    src, dst = f"{scratch}/landing", f"{scratch}/bronze"
    write_extracts({"hr_operating_units": fx.hr_operating_units, "ap_suppliers": fx.ap_suppliers}, src)
    land_bronze(spark, src, dst, ["hr_operating_units", "ap_suppliers"])
    b = spark.read.parquet(f"{dst}/ap_suppliers")
    assert {"_ingest_ts", "_source_system"} <= set(b.columns)
    assert b.count() == fx.ap_suppliers.count()
    assert {r[0] for r in b.select("_source_system").distinct().collect()} == {"EBS_R12"}


def test_pipeline_matches_lazy_model(spark, scratch):
    lazy = Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF)
    root = run_pipeline(spark, lazy, f"{scratch}/wh")
    for layer in ("bronze", "silver", "gold"):
        assert os.path.isdir(layer_path(spark, root, layer))
    silver = layer_path(spark, root, "silver")
    assert sorted(os.listdir(silver)) == sorted(SILVER_TABLES)
    # the transaction fact is month-partitioned
    assert any(p.startswith("txn_year_month=") for p in os.listdir(f"{silver}/fact_material_txn"))
    stored = Model.from_warehouse(spark, root, as_of=FIXTURE_AS_OF)
    assert _rows(stored.stores_aging) == _rows(lazy.stores_aging)
    assert _rows(stored.recon_ap_to_gl) == _rows(lazy.recon_ap_to_gl)
    # column comments travel with the stored gold table
    field = stored.stores_aging.schema["onhand_value_avg_cost"]
    assert field.metadata.get("comment", "").startswith("DEFAULT MEASURE OF VALUE")
    # a month filter on the stored fact prunes partitions
    sliced = month_slice(stored.fact_material_txn, "2024-01", "2024-03")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "txn_year_month" in plan
    assert sliced.select(F.min("txn_year_month")).first()[0] >= "2024-01"


def test_streaming_landing_is_incremental(spark, scratch):
    fx = Fixtures(spark, SF_SMALL)
    items = fx.mtl_system_items_b
    src, dst, ckpt = f"{scratch}/drop", f"{scratch}/bronze_items", f"{scratch}/ckpt"
    first = items.filter("ORGANIZATION_ID = 0")
    second = items.filter("ORGANIZATION_ID <> 0")
    first.write.option("header", "true").csv(f"{src}/batch1")
    q = land_incrementally(spark, "mtl_system_items_b", f"{src}/*", dst, ckpt)
    q.awaitTermination()
    assert spark.read.parquet(dst).count() == first.count()
    second.write.option("header", "true").csv(f"{src}/batch2")
    q = land_incrementally(spark, "mtl_system_items_b", f"{src}/*", dst, ckpt)
    q.awaitTermination()
    landed = spark.read.parquet(dst)
    assert landed.count() == items.count()  # each file exactly once across restarts
    assert _rows(landed.drop("_ingest_ts", "_source_system")) == _rows(items)


def test_reference_sql_runs_on_views(spark):
    """The reference's report SQL runs unchanged (unqualified names) on the registered views."""
    from sparesledger.plans.views import register_views

    m = Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF)
    register_views(spark, m, persona="GCI")
    by_sql = spark.sql("""
        SELECT aging_bucket_last_receipt AS aging_bucket, COUNT(*) AS stock_lines,
               COUNT_IF(movement_status = 'Dead Stock - Never Issued') AS dead_stock_lines
        FROM agg_stores_aging GROUP BY aging_bucket_last_receipt ORDER BY aging_bucket_last_receipt""").collect()
    assert [r.stock_lines for r in by_sql] == [23, 58, 108, 130, 226]
    vis = spark.sql("SELECT COUNT(DISTINCT org_code) AS orgs_visible, COUNT(*) AS rows_visible "
                    "FROM vw_stores_aging_secured").first()
    assert vis.orgs_visible == 1 and vis.rows_visible == m.stores_aging.filter("org_code = 'GCI'").count()
    # the gold query's own inputs are there too: bronze on-hand joined to silver items
    n = spark.sql("""SELECT COUNT(*) AS n FROM dim_item i JOIN mtl_onhand_quantities_detail oh
                     ON oh.INVENTORY_ITEM_ID = i.inventory_item_id AND oh.ORGANIZATION_ID = i.org_id""").first().n
    assert n == m.stores_aging.count()
    recon_rows = spark.sql("SELECT * FROM recon_ap_to_gl ORDER BY to_date(period_name, 'MMM-yy')").collect()
    assert recon_rows[0].period_name == "JAN-19" and recon_rows[-1].period_name == "DEC-25"


def test_filters_reach_the_scan_of_stored_layers(spark, scratch):
    """Over stored tables, the persona and drill filters are pushed into the parquet scan."""
    from sparesledger.operators import recon, security

    root = run_pipeline(spark, Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF), f"{scratch}/wh")
    stored = Model.from_warehouse(spark, root, as_of=FIXTURE_AS_OF)
    view = security.secured_view(stored.stores_aging, "GCI")
    plan = view._jdf.queryExecution().executedPlan().toString()
    # gold is partitioned by plant: the persona reads one plant's partition only
    assert re.search(r"PartitionFilters: \[isnotnull\(org_code#\d+\), \(org_code#\d+ = GCI\)\]", plan), plan
    assert {r.org_code for r in view.select("org_code").distinct().collect()} == {"GCI"}
    drill = recon.gl_drill_through(stored.fact_ap_distribution, stored.bridge_sla_gl, stored.dim_account, "MAR-25")
    plan = drill._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(period_name,MAR-25)" in plan and "EqualTo(natural_account,1310)" in plan
    assert drill.count() == 25


def test_pipeline_as_catalog_tables(spark, scratch):
    """Layers as databases, tables replaced on each run, comments in the catalog."""
    lazy = Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF)
    root = f"{scratch}/cat"
    run_pipeline(spark, lazy, root, catalog_prefix="ssl_")
    # a new application starts with an empty session catalog: forget the tables (external, so
    # the files stay) and run again -- the run re-registers and replaces them
    for layer in ("bronze", "silver", "gold"):
        for r in spark.sql(f"SHOW TABLES IN ssl_{layer}").collect():
            if not r.isTemporary:
                spark.sql(f"DROP TABLE ssl_{layer}.{r.tableName}")
    run_pipeline(spark, lazy, root, catalog_prefix="ssl_")
    names = {r.tableName for r in spark.sql("SHOW TABLES IN ssl_silver").collect() if not r.isTemporary}
    assert names == set(SILVER_TABLES)
    assert spark.table("ssl_gold.agg_stores_aging").count() == 545
    desc = {r.col_name: r.comment for r in spark.sql("DESCRIBE TABLE ssl_gold.agg_stores_aging").collect()}
    assert desc["movement_status"].startswith("One of: Active")
    ext = spark.sql("DESCRIBE TABLE EXTENDED ssl_gold.agg_stores_aging").collect()
    assert any(r.col_name == "Comment" and "One row per item per plant" in r.data_type for r in ext)
    # the files are where the path-based reader expects them
    assert _rows(Model.from_warehouse(spark, root, as_of=FIXTURE_AS_OF).recon_ap_to_gl) == _rows(lazy.recon_ap_to_gl)


def test_parquet_extracts_and_cluster_sizing(spark, scratch):
    """A3: the source format is a parameter; and cluster sizing stays within bounds."""
    from sparesledger.session import cluster_conf

    fx = Fixtures(spark, SF_SMALL)
    write_extracts({"cst_item_costs": fx.cst_item_costs}, scratch, fmt="parquet")
    back = read_extract(spark, "cst_item_costs", f"{scratch}/cst_item_costs.parquet", fmt="parquet")
    assert _rows(back) == _rows(fx.cst_item_costs)
    assert cluster_conf(100 * 2**40, 8000)["spark.sql.shuffle.partitions"] == "409600"
    assert cluster_conf(10 * 2**30, 64)["spark.sql.shuffle.partitions"] == "128"
    assert int(cluster_conf(2**40, 1000)["spark.sql.shuffle.partitions"]) == 4096


def test_cutoff_prunes_month_partitions(spark, scratch):
    import datetime as dt

    from sparesledger.operators import aging

    root = run_pipeline(spark, Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF), f"{scratch}/wh",
                        layers=("bronze", "silver"))
    fact = Model.from_warehouse(spark, root, as_of=FIXTURE_AS_OF).fact_material_txn
    prof = aging.txn_profile(fact, as_of=dt.date(2021, 6, 30), cutoff=True)
    plan = prof._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*txn_year_month.*<= 2021-06", plan), plan
    lazy = aging.txn_profile(Model.from_fixtures(spark, SF_SMALL).fact_material_txn,
                             as_of=dt.date(2021, 6, 30), cutoff=True)
    assert _rows(prof) == _rows(lazy)


def test_check_landing_files(spark, scratch):
    from sparesledger.operators.checks import check_landing_files

    fx = Fixtures(spark, SF_SMALL)
    write_extracts({"ap_suppliers": fx.ap_suppliers, "hr_operating_units": fx.hr_operating_units}, scratch)
    with open(f"{scratch}/gl_ledgers.csv", "w") as fh:  # a plain single-file extract
        fh.write("LEDGER_ID,NAME\n1,Primary\n")
    rows = {r.table_name: r for r in check_landing_files(
        spark, scratch, ["ap_suppliers", "hr_operating_units", "gl_ledgers", "gl_periods"]).collect()}
    assert rows["ap_suppliers"].present and rows["hr_operating_units"].files >= 1
    assert rows["gl_ledgers"].files == 1 and rows["gl_ledgers"].bytes > 0
    assert not rows["gl_periods"].present and rows["gl_periods"].files == 0


def test_batch_job_from_csv_landing(spark, scratch):
    """The spark-submit job: CSV landing -> layers -> report data sets, equal to the lazy model."""
    from sparesledger.plans.job import REPORTS, parse_args, run

    fx = Fixtures(spark, SF_SMALL)
    write_extracts(fx.tables(), f"{scratch}/landing")
    args = parse_args(["--landing", f"{scratch}/landing", "--root", f"{scratch}/wh", "--as-of", "2025-12-31",
                       "--reports"])
    root = run(spark, args)
    assert sorted(os.listdir(f"{root}/reports")) == sorted(REPORTS)
    got = spark.read.parquet(f"{root}/reports/aging_by_bucket")
    from sparesledger.operators import reports

    want = reports.aging_by_bucket(Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF).stores_aging)
    assert _rows(got) == _rows(want)
    assert spark.read.parquet(f"{root}/reports/check_grain").count() == 0


def test_checkpoint_folder_precedence(spark):
    """The folder the cluster names wins over Spark's per-application subfolder; unset raises."""
    import pytest as _pytest

    from sparesledger.session import checkpoint_dir, ensure_checkpoint_dir

    class _Conf(dict):
        def get(self, k, default=None):
            return super().get(k, default)

    class _SC:
        def __init__(self, conf, ckpt):
            self._conf, self._ckpt = _Conf(conf), ckpt

        def getConf(self):
            return self._conf

        def getCheckpointDir(self):
            return self._ckpt

        def setCheckpointDir(self, d):
            self._ckpt = f"{d}/uuid"

    class _Spark:
        def __init__(self, conf, ckpt=None):
            self.sparkContext = _SC(conf, ckpt)

    assert checkpoint_dir(_Spark({"spark.checkpoint.dir": "hdfs:///shared"}, "hdfs:///shared/uuid")) == "hdfs:///shared"
    assert checkpoint_dir(_Spark({}, "/local/uuid")) == "/local/uuid"
    with _pytest.raises(ValueError):
        ensure_checkpoint_dir(_Spark({}))
    # the stable base is returned, never Spark's per-application subfolder below it
    fresh = _Spark({})
    assert ensure_checkpoint_dir(fresh, "/tmp/x") == "/tmp/x"
    assert fresh.sparkContext.getCheckpointDir() == "/tmp/x/uuid"
    # later calls agree with the folder chosen for this session
    from sparesledger.plans.pipeline import default_root

    assert ensure_checkpoint_dir(fresh, "/tmp/other") == "/tmp/x"
    assert default_root(fresh) == "/tmp/x/sparesledger-warehouse"
    assert default_root(fresh, "2026-06-30") == "/tmp/x/sparesledger-warehouse/as_of=2026-06-30"
    import datetime as dt

    assert default_root(fresh, dt.datetime(2026, 6, 30, 13, 5)) == default_root(fresh, dt.date(2026, 6, 30))
    # an expression as-of has no date of its own: the caller must name the root
    from pyspark.sql import functions as F

    with _pytest.raises(ValueError):
        default_root(fresh, F.current_date())
    # a programmatic checkpoint folder has no known base: refuse a silent local fallback
    with _pytest.raises(ValueError):
        ensure_checkpoint_dir(_Spark({}, "hdfs:///ckpt/uuid"), "/tmp/y")

    class _SessionConf:
        def get(self, k, default=None):
            return "s3://shared" if k == "spark.checkpoint.dir" else default

    in_session = _Spark({})
    in_session.conf = _SessionConf()  # set on the session only (builder.config on a running context)
    assert checkpoint_dir(in_session) == "s3://shared"


def test_recompute_gold_with_another_as_of(spark, scratch):
    import datetime as dt

    root = run_pipeline(spark, Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF), f"{scratch}/wh")
    stored = Model.from_warehouse(spark, root, as_of=dt.date(2026, 6, 30))
    fresh = Model.from_warehouse(spark, root, read_gold=False, as_of=dt.date(2026, 6, 30))
    d_stored = stored.stores_aging.agg(F.max("days_since_first_receipt")).first()[0]
    d_fresh = fresh.stores_aging.agg(F.max("days_since_first_receipt")).first()[0]
    assert d_fresh - d_stored == (dt.date(2026, 6, 30) - FIXTURE_AS_OF).days


def test_stream_checkpoint_key_follows_the_target(spark, scratch):
    """Respelled target paths map to one stream identity (the sink's commit log stays paired)."""
    from sparesledger.streaming.landing import _qualified

    a = _qualified(spark, f"{scratch}/bronze_items")
    assert a == _qualified(spark, f"{scratch}//bronze_items/") == _qualified(spark, f"file:{scratch}/bronze_items")
    assert a != _qualified(spark, f"{scratch}/bronze_other")


def test_streaming_default_checkpoint_resumes(spark, scratch):
    """Without a checkpoint_location the stream checkpoints under the shared folder, keyed by the
    target, so a second start (a new run) resumes instead of re-landing."""
    fx = Fixtures(spark, SF_SMALL)
    items = fx.mtl_system_items_b
    src, dst = f"{scratch}/drop", f"{scratch}/bronze_default_ckpt"
    items.filter("ORGANIZATION_ID = 0").write.option("header", "true").csv(f"{src}/b1")
    land_incrementally(spark, "mtl_system_items_b", f"{src}/*", dst).awaitTermination()
    items.filter("ORGANIZATION_ID <> 0").write.option("header", "true").csv(f"{src}/b2")
    land_incrementally(spark, "mtl_system_items_b", f"{src}/*", dst + "/").awaitTermination()  # respelled
    assert spark.read.parquet(dst).count() == items.count()


def test_second_session_sees_the_local_fallback():
    from sparesledger.session import _LOCAL_FALLBACK, ensure_checkpoint_dir, shared_folder

    class _Ctx:
        def __init__(self):
            self.ckpt = None

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return self.ckpt

        def setCheckpointDir(self, d):
            self.ckpt = f"{d}/uuid"

    class _S:
        def __init__(self, ctx):
            self.sparkContext = ctx

    ctx = _Ctx()
    first, second = _S(ctx), _S(ctx)
    assert ensure_checkpoint_dir(first, "/tmp/fb") == "/tmp/fb"
    assert shared_folder(second) == "/tmp/fb" and ensure_checkpoint_dir(second, "/tmp/other") == "/tmp/fb"
    assert ctx in _LOCAL_FALLBACK


def test_streaming_refuses_a_fresh_checkpoint_over_a_used_target(spark, scratch):
    import pytest as _pytest

    fx = Fixtures(spark, SF_SMALL)
    items = fx.mtl_system_items_b
    items.filter("ORGANIZATION_ID = 0").write.option("header", "true").csv(f"{scratch}/src1/b1")
    land_incrementally(spark, "mtl_system_items_b", f"{scratch}/src1/*", f"{scratch}/dst",
                       f"{scratch}/ck1").awaitTermination()
    items.filter("ORGANIZATION_ID <> 0").write.option("header", "true").csv(f"{scratch}/src2/b1")
    with _pytest.raises(ValueError):
        land_incrementally(spark, "mtl_system_items_b", f"{scratch}/src2/*", f"{scratch}/dst", f"{scratch}/ck2")
    # into a new target the second source lands in full
    land_incrementally(spark, "mtl_system_items_b", f"{scratch}/src2/*", f"{scratch}/dst2",
                       f"{scratch}/ck2").awaitTermination()
    assert spark.read.parquet(f"{scratch}/dst2").count() == items.filter("ORGANIZATION_ID <> 0").count()


COSTS = "INVENTORY_ITEM_ID,ORGANIZATION_ID,ITEM_COST,LAST_PO_COST"


def _csv(scratch, name, text):
    with open(f"{scratch}/{name}.csv", "w") as f:
        f.write(text)
    return f"{scratch}/{name}.csv"


def test_csv_columns_go_by_header_name(spark, scratch):
    path = _csv(scratch, "swapped", "COST_TYPE_ID,LAST_PO_COST,ITEM_COST,ORGANIZATION_ID,INVENTORY_ITEM_ID\n7,12.50,10.25,2,1\n")
    df = read_extract(spark, "cst_item_costs", path)
    assert df.columns == [*COSTS.split(","), "COST_TYPE_ID"]
    assert list(df.first()) == [1, 2, Decimal("10.25"), Decimal("12.50"), "7"]


def test_csv_missing_column_raises(spark, scratch):
    path = _csv(scratch, "missing", "INVENTORY_ITEM_ID,ORGANIZATION_ID,ITEM_COST\n1,2,3\n")
    with pytest.raises(ValueError, match="LAST_PO_COST"):
        read_extract(spark, "cst_item_costs", path)


def test_csv_dates_with_time_and_leading_zeros(spark, scratch):
    head = "AE_HEADER_ID,APPLICATION_NAME,PERIOD_NAME,ACCOUNTING_DATE"
    path = _csv(scratch, "dates", head + "\n1,007,MAR-26,2026-03-05 10:11:12\n2,,,2026-03-06\n3,,,\n")
    rows = read_extract(spark, "xla_ae_headers", path).orderBy("AE_HEADER_ID").collect()
    assert [str(r.ACCOUNTING_DATE) for r in rows] == ["2026-03-05", "2026-03-06", "None"]
    assert rows[0].APPLICATION_NAME == "007"


def test_csv_number_that_would_be_rounded_fails(spark, scratch):
    path = _csv(scratch, "fine", COSTS + "\n1,2,0.0000049,1.00\n")
    with pytest.raises(Exception, match="ITEM_COST does not fit"):
        read_extract(spark, "cst_item_costs", path).collect()


def test_work_folder_of_queries_that_write():
    from sparesledger.session import work_folder

    class _Ctx:
        def __init__(self, master, conf=None, ckpt=None):
            self.master, self.conf, self.ckpt = master, conf or {}, ckpt

        def getConf(self):
            return self.conf

        def getCheckpointDir(self):
            return self.ckpt

        def setCheckpointDir(self, d):
            self.ckpt = f"{d}/uuid"

    class _S:
        def __init__(self, *args, **kw):
            self.sparkContext = _Ctx(*args, **kw)

    assert work_folder(_S("yarn", {"spark.checkpoint.dir": "hdfs:///shared"})) == "hdfs:///shared"
    assert work_folder(_S("local[4]", ckpt="/set/uuid")) == "/set/uuid"
    local = _S("local[4]")
    assert os.path.isdir(work_folder(local)) and work_folder(local) == work_folder(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(_S("spark://host:7077"))
