"""Masks, the mergeable profile and the bucketed bridge: the same answers from better plans."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from sparesledger.functions.bitsets import BitSet
from sparesledger.operators import aging, recon, reports
from sparesledger.plans.model import FIXTURE_AS_OF, Model
from sparesledger.plans.pipeline import run_pipeline
from sparesledger.plans.registry import comparable

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in comparable(df).collect())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def model(spark):
    return Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF)


@pytest.mark.parametrize("n", [0, 1, 5, 63, 64, 200])
def test_bitsets_against_sets(spark, n):
    rnd = random.Random(n)
    members = [f"P{i:03}" for i in range(n)]
    rows = [(g, rnd.choice(members) if members and rnd.random() < .9 else None) for g in range(9) for _ in range(rnd.choice([1, 3, 200]))]
    df = spark.createDataFrame(rows, "g int, v string").repartition(4)
    own = BitSet("m", members)
    got = df.groupBy("g").agg(*own.gather(F.col("v"))).select("g", own.size().alias("n"), own.decoded().alias("s"), *own.columns)
    want = {g: sorted({v for h, v in rows if h == g and v}) for g, _ in rows}
    found = got.collect()
    assert {r.g: (r.n, list(r.s)) for r in found} == {g: (len(s), s) for g, s in want.items()}
    every = got.agg(*own.merge()).select(own.decoded().alias("s")).first().s
    assert list(every) == sorted({v for _, v in rows if v})


def test_bitsets_refuse_strangers(spark):
    df = spark.createDataFrame([("a",), ("x",)], "v string")
    with pytest.raises(Exception, match="not in the set's domain: x"):
        df.agg(*BitSet("m", ["a", "b"]).gather(F.col("v"))).collect()


def test_masks_give_what_sets_give(model):
    plain = aging.redundancy(model.dim_item)
    masked = aging.redundancy(model.dim_item, plants=model.plants)
    assert _rows(plain) == _rows(masked)
    assert "ObjectHashAggregate" in _plan(plain) and "ObjectHashAggregate" not in _plan(masked)
    gold, codes = model.stores_aging, model.plant_codes
    for report, k in ((reports.redistribution_list, 50), (reports.dead_here_active_there, 7)):
        one, two = report(gold, k), report(gold, k, plants=codes)
        assert [tuple(map(str, r)) for r in one.collect()] == [tuple(map(str, r)) for r in two.collect()] and one.columns == two.columns
    assert _rows(reports.stock_kpis(gold)) == _rows(reports.stock_kpis(gold, plants=codes))


def test_lists_and_kpis_take_one_pass(spark, model, scratch):
    stored = Model.from_warehouse(spark, run_pipeline(spark, model, scratch), as_of=FIXTURE_AS_OF)
    for df in (reports.redistribution_list(stored.stores_aging, plants=stored.plant_codes), reports.stock_kpis(stored.stores_aging, plants=stored.plant_codes)):
        plan = _plan(df)
        assert plan.count("FileScan parquet") == 1 and "Expand" not in plan and "ObjectHashAggregate" not in plan, plan


def test_empty_gold(model):
    none = model.stores_aging.filter("org_code IS NULL")
    assert _rows(reports.stock_kpis(none)) == _rows(reports.stock_kpis(none, plants=model.plant_codes))
    assert reports.redistribution_list(none, plants=model.plant_codes).count() == 0


def test_profile_from_parts(spark, model, scratch):
    """Parts of single months merge to the profile; a month made anew replaces its parts only."""
    txn = model.fact_material_txn
    whole = aging.txn_profile(txn)
    aging.profile_parts(txn).write.partitionBy("txn_year_month").parquet(f"{scratch}/parts")
    stored = spark.read.parquet(f"{scratch}/parts")
    assert _rows(aging.merged_profile(stored).select(whole.columns)) == _rows(whole)
    month = txn.agg(F.max("txn_year_month")).first()[0]
    corrected = txn.withColumn("primary_quantity", F.when(F.col("txn_year_month") == month, F.col("primary_quantity") * 2).otherwise(F.col("primary_quantity")))
    again = aging.profile_parts(corrected.filter(F.col("txn_year_month") == month))
    merged = aging.merged_profile(stored.filter(F.col("txn_year_month") != month).unionByName(again))
    assert _rows(merged.select(whole.columns)) == _rows(aging.txn_profile(corrected))


def test_bridge_buckets_join_without_a_shuffle(spark, model, scratch):
    run_pipeline(spark, model, scratch, catalog_prefix="bkt_", bridge_buckets=4)
    stored = Model.from_catalog(spark, "bkt_", read_gold=False, as_of=FIXTURE_AS_OF)
    side = recon.sla_side(stored.bridge_sla_gl, stored.fact_ap_distribution)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(side)
        assert "SortMergeJoin" in plan and "hashpartitioning(invoice_distribution_id" not in plan and "Bucketed: true" in plan, plan
        drill = recon.gl_drill_through(stored.fact_ap_distribution, stored.bridge_sla_gl, stored.dim_account, "MAR-25")
        assert "hashpartitioning(invoice_distribution_id" not in _plan(drill), _plan(drill)
        assert _rows(drill) == _rows(recon.gl_drill_through(model.fact_ap_distribution, model.bridge_sla_gl, model.dim_account, "MAR-25"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert _rows(stored.recon_ap_to_gl) == _rows(model.recon_ap_to_gl)
    assert _rows(Model.from_warehouse(spark, scratch, as_of=FIXTURE_AS_OF).bridge_sla_gl) == _rows(model.bridge_sla_gl)
    run_pipeline(spark, model, scratch, catalog_prefix="bkt_", bridge_buckets=4)  # a second run takes the names over
    assert not [t.name for t in spark.catalog.listTables("default") if t.name.startswith("sparesledger_writing")]
    assert Model.from_catalog(spark, "bkt_", as_of=FIXTURE_AS_OF).bridge_sla_gl.count() == model.bridge_sla_gl.count()


def test_costs_of_one_type(spark, model):
    from sparesledger.operators import checks

    costs = model.source("cst_item_costs").withColumn("COST_TYPE_ID", F.lit("2"))
    several = costs.unionByName(costs.withColumn("ITEM_COST", F.col("ITEM_COST") + 1).withColumn("COST_TYPE_ID", F.lit("1")))
    assert checks.check_cost_grain(costs).count() == 0 and checks.check_cost_grain(several).count() == costs.count()
    gold = lambda c, **more: aging.stores_aging(model.dim_item, model.source("mtl_onhand_quantities_detail"), c, model.fact_material_txn,
                                                as_of=FIXTURE_AS_OF, **more)
    assert _rows(gold(several, cost_type="2")) == _rows(gold(costs))
    assert gold(several).count() == 2 * gold(costs).count()
