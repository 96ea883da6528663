"""Two-part names and table functions over a published catalog."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sparesledger.operators import reports, security
from sparesledger.plans.model import FIXTURE_AS_OF, Model
from sparesledger.plans.pipeline import run_pipeline
from sparesledger.plans.registry import comparable
from sparesledger.plans.views import register_sql

from .conftest import SF_SMALL


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in comparable(df).collect())


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    model = Model.from_fixtures(spark, SF_SMALL, as_of=FIXTURE_AS_OF)
    run_pipeline(spark, model, str(tmp_path_factory.mktemp("wh")), catalog_prefix="tvf_")
    names = register_sql(spark, "tvf_", persona="GCI")
    assert names[0] == "tvf_gold.vw_stores_aging_secured"
    return model


def test_secured_view_by_two_part_name(spark, stored):
    """The reference's two queries on its view, and its persona test, by the names they use."""
    got = spark.sql("SELECT COUNT(DISTINCT org_code) AS orgs_visible, COUNT(*) AS rows_visible FROM tvf_gold.vw_stores_aging_secured").first()
    assert (got.orgs_visible, got.rows_visible) == (1, stored.stores_aging.filter("org_code = 'GCI'").count())
    by_bucket = spark.sql("SELECT aging_bucket_last_receipt AS b, COUNT(*) AS n FROM tvf_gold.vw_stores_aging_secured GROUP BY 1")
    want = security.secured_view(stored.stores_aging, "GCI").groupBy(F.col("aging_bucket_last_receipt").alias("b")).agg(F.count("*").alias("n"))
    assert _rows(by_bucket) == _rows(want)


@pytest.mark.parametrize("persona", ["BOARD", "GCI", "WCM", "o'hara", ""])
def test_persona_is_an_argument(spark, stored, persona):
    got = spark.sql("SELECT * FROM tvf_stores_aging_secured(:who)", args={"who": persona})
    want = security.secured_view(stored.stores_aging, persona)
    assert _rows(got.select(want.columns)) == _rows(want)
    seen = spark.sql("SELECT * FROM tvf_visibility_check(:who)", args={"who": persona})
    assert _rows(seen) == _rows(security.visibility_check(stored.stores_aging, persona))


def test_the_plant_filter_reaches_the_scan(spark, stored):
    plan = spark.sql("SELECT * FROM tvf_stores_aging_secured('GCI')")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(org_code" in plan and "= GCI)]" in plan, plan
    assert "LocalTableScan <empty>" in spark.sql("SELECT * FROM tvf_stores_aging_secured('AUDITOR')")._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("dimension, measure, status", [("plant", "value", "all"), ("Site", "worth", "dead stock"), ("category", "exposure", "non-moving"),
                                                       ("movement_status", "replacement cost", "all")])
def test_stock_summary(spark, stored, dimension, measure, status):
    got = spark.sql("SELECT * FROM tvf_stock_summary(:d, :m, :s)", args={"d": dimension, "m": measure, "s": status})
    where = None if status == "all" else status
    want = reports.stock_summary(stored.stores_aging, (dimension,), where, measure)
    key = reports.SYNONYMS.get(dimension.lower(), dimension)
    assert _rows(got.select("dimension", "value_pkr_mn", "item_lines")) == _rows(want.select(F.col(key).alias("dimension"), "value_pkr_mn", "item_lines"))
    assert spark.sql("SELECT * FROM tvf_stock_summary()").count() == 5


def test_unknown_words_are_errors(spark, stored):
    for args in ("'colour'", "'plant', 'weight'", "'plant', 'value', 'some'"):
        with pytest.raises(Exception, match="unknown"):
            spark.sql(f"SELECT * FROM tvf_stock_summary({args})").collect()
    with pytest.raises(ValueError, match="prefix"):
        register_sql(spark, "a; DROP")
