"""The fixture mapping rules of FIXTURES.md §3, checked one by one on the smallest tables."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sparesledger.operators.aging import _merged
from sparesledger.sources.fixtures import Fixtures
from sparesledger.sources.schemas import SOURCE_SCHEMAS

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def fx(spark):
    return Fixtures(spark, SF_SMALL)


def test_every_extract_has_its_declared_schema(fx):
    for name, schema in SOURCE_SCHEMAS.items():
        assert fx.table(name).schema.simpleString() == schema.simpleString(), name


def test_plants(fx):
    rows = {r.ORG_ID: r for r in fx.hr_operating_units.collect()}
    assert [rows[k].ORG_CODE for k in range(5)] == ["GCI", "WCI", "GCM", "WCM", "HOC"]
    assert rows[2].PLANT_SEGMENT == "002" and rows[2].REGION == rows[2].ORG_NAME


def test_items_sit_in_one_to_five_plants(fx):
    items = fx.mtl_system_items_b
    assert items.filter(F.col("INVENTORY_ITEM_ID") % 5 < F.col("ORGANIZATION_ID")).count() == 0
    per_item = items.groupBy("INVENTORY_ITEM_ID").count()
    bad = per_item.filter(F.col("count") != F.col("INVENTORY_ITEM_ID") % 5 + 1)
    assert bad.count() == 0


def test_onhand_and_costs(fx):
    oh = fx.mtl_onhand_quantities_detail
    assert oh.filter((F.col("INVENTORY_ITEM_ID") + F.col("ORGANIZATION_ID")) % 11 == 0).count() == 0
    missing = fx.mtl_system_items_b.join(
        oh, ["INVENTORY_ITEM_ID", "ORGANIZATION_ID"], "left_anti")
    assert missing.filter((F.col("INVENTORY_ITEM_ID") + F.col("ORGANIZATION_ID")) % 11 != 0).count() == 0
    c = fx.cst_item_costs
    assert c.filter((F.col("INVENTORY_ITEM_ID") % 97 == 0) & (F.col("ITEM_COST") != 0)).count() == 0
    assert c.count() == fx.mtl_system_items_b.count()


def test_transactions_one_per_line(spark, fx):
    t = fx.mtl_material_transactions
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert t.count() == li.count()
    issues = li.filter("l_returnflag = 'R'").count()
    assert t.filter("TRANSACTION_TYPE_ID = 33").count() == issues
    assert t.filter("TRANSACTION_TYPE_ID = 33 AND PRIMARY_QUANTITY >= 0").count() == 0
    years = t.agg(F.min(F.year("TRANSACTION_DATE")), F.max(F.year("TRANSACTION_DATE"))).first()
    assert (years[0], years[1]) == (2019, 2025)
    assert t.select("TRANSACTION_ID").distinct().count() == t.count()  # hash of the full row


def test_distributions_and_links(fx):
    d = fx.ap_invoice_distributions_all
    assert d.select("INVOICE_DISTRIBUTION_ID").distinct().count() == d.count()
    assert d.filter(F.col("DIST_CODE_COMBINATION_ID") != F.col("ORG_ID") * 10 + 1).count() == 0
    links = fx.xla_distribution_links
    unlinked = d.join(links, d.INVOICE_DISTRIBUTION_ID == links.SOURCE_DISTRIBUTION_ID_NUM_1, "left_anti")
    assert unlinked.filter(F.col("INVOICE_DISTRIBUTION_ID") % 1000 != 17).count() == 0
    assert links.count() + unlinked.count() == d.count()


def test_journals(fx):
    lines = fx.gl_je_lines.join(fx.gl_je_headers, "JE_HEADER_ID")
    periods = {r[0] for r in lines.select("PERIOD_NAME").distinct().collect()}
    assert "JAN-19" not in periods and "DEC-25" in periods
    june = lines.filter("PERIOD_NAME = 'JUN-24' AND JE_SOURCE = 'Payables' AND JE_LINE_NUM = 3").collect()
    assert [r.ACCOUNTED_DR for r in june] == [Decimal("250.00")]
    dec = lines.filter("PERIOD_NAME = 'DEC-24' AND CODE_COMBINATION_ID = 9").collect()
    assert [r.ACCOUNTED_DR for r in dec] == [Decimal("999.00")]
    inv = lines.filter("JE_SOURCE = 'Inventory'")
    assert inv.filter("ACCOUNTED_DR <> 777.00").count() == 0 and inv.count() > 0
    only = lines.filter("PERIOD_NAME = 'DEC-25'").collect()
    assert sorted((r.JE_LINE_NUM, r.ACCOUNTED_DR, r.ACCOUNTED_CR) for r in only) == [
        (1, Decimal("1234.50"), None), (2, None, Decimal("1234.50"))]


def test_security_map(fx):
    grants = {(r.USER_NAME, r.ORG_CODE) for r in fx.org_security_map.collect()}
    assert {c for u, c in grants if u == "board"} == {"GCI", "WCI", "GCM", "WCM", "HOC"}
    assert {c for u, c in grants if u == "dual_user"} == {"GCI", "WCI"}


def test_a_run_that_writes_all_extracts_makes_the_distributions_once(spark, scratch):
    plain, stored = Fixtures(spark, SF_SMALL), Fixtures(spark, SF_SMALL).stored(scratch)
    for t in ("ap_invoice_distributions_all", "ap_invoices_all", "gl_je_lines", "gl_je_headers", "xla_ae_headers", "xla_distribution_links"):
        assert not [f for f in stored.table(t).inputFiles() if "lineitem" in f], t
        assert sorted(map(str, stored.table(t).collect())) == sorted(map(str, plain.table(t).collect())), t


def test_parts_are_dealt_out_before_their_pairs_are_made(spark):
    plan = Fixtures(spark, SF_SMALL).mtl_system_items_b._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning(p_partkey")


def test_gold_broadcasts_a_side_only_if_it_is_far_below_the_limit(spark):
    side, before = spark.range(1000), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, join in (("10000", "SortMergeJoin"), ("1000000", "BroadcastHashJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            plan = spark.range(10**7).join(_merged(side), "id", "left")._jdf.queryExecution().executedPlan().toString()
            assert join in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
