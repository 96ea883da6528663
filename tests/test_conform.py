"""One typing for every way in, exact arithmetic at the source's precision, rejected rows."""

from __future__ import annotations

import datetime as dt
import json
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparesledger.functions.money import decimal_type, product, quotient
from sparesledger.sources.bronze import good_rows, read_extract, rejects, split_extract
from sparesledger.sources.conform import _doubtful, typed
from sparesledger.streaming import current_rows, land_incrementally

COSTS = ["INVENTORY_ITEM_ID", "ORGANIZATION_ID", "ITEM_COST", "LAST_PO_COST"]
D = Decimal


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def _file(scratch, fmt, header, rows, spark):
    """An extract file of one format from text cells, columns in the header's order."""
    path = f"{scratch}/costs.{fmt}"
    if fmt == "csv":
        return _write(path, "\n".join([",".join(header), *(",".join(r) for r in rows)]) + "\n")
    if fmt == "json":
        return _write(path, "\n".join("{" + ", ".join(f'"{h}": {c}' for h, c in zip(header, r)) + "}" for r in rows) + "\n")
    kinds = {"parquet": "decimal(30,8)", "orc": "decimal(25,5)"}
    cells = [tuple(int(c) if h.endswith("_ID") else D(c) for h, c in zip(header, r)) for r in rows]
    spark.createDataFrame(cells, ", ".join(f"{h} {'long' if h.endswith('_ID') else kinds[fmt]}" for h in header)).write.format(fmt).save(path)
    return path


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_swapped_columns_and_four_places_in_every_format(spark, scratch, fmt):
    header = ["LAST_PO_COST", "ORGANIZATION_ID", "ITEM_COST", "INVENTORY_ITEM_ID"]
    path = _file(scratch, fmt, header, [("12.3456", "2", "0.0049", "1"), ("7", "3", "1234567890123.45678", "2")], spark)
    df = read_extract(spark, "cst_item_costs", path, fmt)
    assert df.columns == COSTS and decimal_type(df, "ITEM_COST") == T.DecimalType(18, 5)
    assert sorted(map(tuple, df.collect())) == [(1, 2, D("0.0049"), D("12.3456")), (2, 3, D("1234567890123.45678"), D(7))]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_more_places_than_declared_fail_unless_declared(spark, scratch, fmt):
    path = _file(scratch, fmt, COSTS, [("1", "2", "0.0000004", "1")], spark)
    with pytest.raises(Exception, match="ITEM_COST does not fit"):
        read_extract(spark, "cst_item_costs", path, fmt).collect()
    df = read_extract(spark, "cst_item_costs", path, fmt, types={"item_cost": "decimal(20,8)"})
    assert df.first().ITEM_COST == D("0.0000004")
    with pytest.raises(ValueError, match="no declared column"):
        read_extract(spark, "cst_item_costs", path, fmt, types={"NOPE": "int"})


@pytest.mark.parametrize("fmt", ["csv", "json"])
def test_streaming_types_as_batch_does(spark, scratch, fmt):
    header = ["LAST_PO_COST", "ORGANIZATION_ID", "ITEM_COST", "INVENTORY_ITEM_ID"]
    import os

    os.makedirs(f"{scratch}/drop")
    _file(f"{scratch}/drop", fmt, header, [("12.3456", "2", "0.0049", "1")], spark)
    land_incrementally(spark, "cst_item_costs", f"{scratch}/drop", f"{scratch}/out", f"{scratch}/ck", fmt).awaitTermination()
    landed = spark.read.parquet(f"{scratch}/out")
    assert [tuple(r) for r in landed.select(*COSTS).collect()] == [(1, 2, D("0.0049"), D("12.3456"))]


def test_streaming_stops_at_a_file_of_another_header(spark, scratch):
    import os

    os.makedirs(f"{scratch}/drop")
    _write(f"{scratch}/drop/a.csv", "INVENTORY_ITEM_ID,ORGANIZATION_ID,ITEM_COST,LAST_PO_COST\n1,2,1.5,2.5\n")
    land_incrementally(spark, "cst_item_costs", f"{scratch}/drop", f"{scratch}/out", f"{scratch}/ck").awaitTermination()
    _write(f"{scratch}/drop/b.csv", "INVENTORY_ITEM_ID,ORGANIZATION_ID,LAST_PO_COST,ITEM_COST\n2,2,1.5,2.5\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        land_incrementally(spark, "cst_item_costs", f"{scratch}/drop", f"{scratch}/out", f"{scratch}/ck").awaitTermination()
    assert spark.read.parquet(f"{scratch}/out").count() == 1


def test_a_full_extract_sent_again_leaves_one_row_a_key(spark, scratch):
    import os

    os.makedirs(f"{scratch}/drop")
    for name, cost in (("a", "1.5"), ("b", "9.25")):
        _write(f"{scratch}/drop/{name}.csv", ",".join(COSTS) + f"\n1,2,{cost},2.5\n3,4,{cost},2.5\n")
        land_incrementally(spark, "cst_item_costs", f"{scratch}/drop", f"{scratch}/out", f"{scratch}/ck").awaitTermination()
    landed = spark.read.parquet(f"{scratch}/out")
    assert landed.count() == 4
    now = current_rows(landed, "cst_item_costs")
    assert now.columns == COSTS and sorted(map(tuple, now.collect())) == [(1, 2, D("9.25"), D("2.5")), (3, 4, D("9.25"), D("2.5"))]
    with pytest.raises(ValueError, match="no key"):
        current_rows(landed, "mtl_onhand_quantities_detail")


TEXTS = {"1.50000": D("1.5"), "12.345670": D("12.34567"), "1e2": D(100), "1.25E1": D("12.5"), "-3e-5": D("-0.00003"), " 7 ": D(7), "+0.5": D("0.5"), ".5": D("0.5"),
         "1.000000000000000000000000001": None, "1.0000000000004": None, "0.000001": None, "1e-6": None, "12345678901234": None, "abc": None, "1,5": None, "": None,
         "1.234567e1": D("12.34567"), "1.2345678e1": None, "NaN": None}


def test_number_text_is_taken_exactly_or_not_at_all(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    value, lost = typed(F.col("t"), T.StringType(), T.DecimalType(18, 5))
    for r in df.select("t", value.alias("v"), lost.alias("bad")).collect():
        assert (r.bad, None if r.bad else r.v) == (TEXTS[r.t] is None, TEXTS[r.t]), r


def test_only_doubtful_text_is_looked_at_closely(spark):
    want = T.DecimalType(18, 5)
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    value, lost = typed(F.col("t"), T.StringType(), want)
    rows = df.select("t", lost.alias("bad"), F.coalesce(_doubtful(F.col("t"), value, T.StringType(), want), F.lit(False)).alias("doubt")).collect()
    assert [r for r in rows if r.bad and not r.doubt] == []
    assert {r.t for r in rows if not r.doubt} == {"1.50000", " 7 ", "+0.5", ".5", None}


def test_other_types_are_taken_exactly_or_not_at_all(spark):
    df = spark.createDataFrame([("12", 0.1, "2026-03-05 10:11:12"), ("12.5", 0.000001, "05/03/2026"), ("x", 1e30, "2026-02-30"), (None, None, None)],
                               "i string, d double, t string")
    cells = [typed(F.col(c), df.schema[c].dataType, k) for c, k in (("i", T.LongType()), ("d", T.DecimalType(18, 5)), ("t", T.DateType()))]
    got = df.select(*(F.when(lost, F.lit("bad")).otherwise(v.cast("string")) for v, lost in cells)).collect()
    assert [tuple(r) for r in got] == [("12", "0.10000", "2026-03-05"), ("bad",) * 3, ("bad",) * 3, (None,) * 3]


def test_bad_rows_are_listed_once_with_their_reasons(spark, scratch):
    import os

    os.makedirs(f"{scratch}/c.csv")
    _write(f"{scratch}/c.csv/a.csv", ",".join(COSTS) + "\n1,2,1.5,2.5\n1,x,abc,2.5\n2,2,0.0000001,1\n")
    _write(f"{scratch}/c.csv/b.csv", ",".join(COSTS) + "\n5,2\n6,2,3,4,5\n7,2,,\n")
    split = split_extract(spark, "cst_item_costs", f"{scratch}/c.csv")
    assert sorted(r.INVENTORY_ITEM_ID for r in good_rows(split).collect()) == [1, 7]
    assert good_rows(split).columns == COSTS
    bad = sorted((r.source_file.rpartition("/")[2], json.loads(r.source_row)["INVENTORY_ITEM_ID"], len(r.problems), r.problems[0][:20]) for r in rejects(split, "costs").collect())
    assert bad == [("a.csv", "1", 2, "ORGANIZATION_ID does"), ("a.csv", "2", 1, "ITEM_COST does not f"),
                   ("b.csv", "5", 1, "malformed line: 5,2"), ("b.csv", "6", 1, "malformed line: 6,2,")]


def test_malformed_json_lines_are_rejected(spark, scratch):
    path = _write(f"{scratch}/c.json", '{"INVENTORY_ITEM_ID": 1, "ORGANIZATION_ID": 2, "ITEM_COST": 1.5, "LAST_PO_COST": 2}\n{"INVENTORY_ITEM_ID": oops\n')
    split = split_extract(spark, "cst_item_costs", path, "json")
    assert good_rows(split).count() == 1 and [r.problems[0][:14] for r in rejects(split, "c").collect()] == ["malformed line"]


def _half_up(x: Decimal, digits: int) -> Decimal:
    return x.quantize(D(1).scaleb(-digits), rounding=ROUND_HALF_UP)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**17, 10**17), st.integers(-10**12, 10**12), st.integers(0, 3)), min_size=30, max_size=60))
def test_quotients_are_half_up_of_the_true_quotient(spark, rows):
    """Also where the quotient stands a hair beside a tie, whatever the places of the operands."""
    rows = rows + [(1, 8, 0), (-1, 8, 0), (5, 2, 0), (-5, -2, 0), (1, 0, 0), (99999999999999999, 200000000000000000, 0), (50000000000000001, 100000000000000000, 0),
                   (49999999999999999, 100000000000000000, 0), (1, 3, 0)]
    for ns, ds, digits in ((5, 5, 2), (2, 8, 3), (0, 5, 1), (5, 0, 4)):
        nt, t = T.DecimalType(18, ns), T.DecimalType(18, ds)
        cells = [(D(n).scaleb(-ns), D(d).scaleb(-ds)) for n, d, _ in rows]
        df = spark.createDataFrame(cells, T.StructType([T.StructField("n", nt), T.StructField("d", t)]))
        for r in df.select("n", "d", quotient(F.col("n"), nt, F.col("d"), t, digits).alias("q")).collect():
            with localcontext() as ctx:
                ctx.prec = 80
                want = _half_up(r.n / r.d, digits) if r.d else None
            assert r.q == want, (r, digits)


def test_products_keep_all_places_or_raise(spark):
    a, b = T.DecimalType(28, 5), T.DecimalType(18, 5)
    df = spark.createDataFrame([(D("12345678.12345"), D("0.00005"))], T.StructType([T.StructField("a", a), T.StructField("b", b)]))
    c, kind = product(F.col("a"), a, F.col("b"), b)
    got = df.select(c.alias("c"))
    assert got.first().c == D("12345678.12345") * D("0.00005") and got.schema["c"].dataType == kind
    wide = spark.createDataFrame([(D("99999999999999999999999.0"), D(1))], df.schema)
    with pytest.raises(Exception, match="digits before the point"):
        wide.select(c).collect()


def test_float_amounts_are_refused(spark):
    with pytest.raises(TypeError, match="exact numbers"):
        decimal_type(spark.createDataFrame([(1.5,)], "x double"), "x")


def test_gold_at_source_precision(spark):
    """Four-place costs and three-place quantities through the ageing table, against Python's decimals."""
    from sparesledger.operators import aging

    items = spark.createDataFrame([(1, 1, "I-1", "d", "cc", "cat", "EA", 1, "GCI", "R", "Grey Cement")],
                                  "inventory_item_id long, org_id long, item_number string, item_description string, category_code string, category_name string, "
                                  "uom string, lead_time_days int, org_code string, region string, business_line string")
    onhand = spark.createDataFrame([(1, 1, D("10.125")), (1, 1, D("0.250"))], "INVENTORY_ITEM_ID long, ORGANIZATION_ID long, PRIMARY_TRANSACTION_QUANTITY decimal(18,3)")
    costs = spark.createDataFrame([(1, 1, D("3.3333"), D("4.4449"))], "INVENTORY_ITEM_ID long, ORGANIZATION_ID long, ITEM_COST decimal(18,4), LAST_PO_COST decimal(18,4)")
    txn = spark.createDataFrame([(1, 1, 18, dt.date(2026, 1, 1), D("5.000"), 7), (1, 1, 33, dt.date(2026, 2, 1), D("-1.375"), None)],
                                "inventory_item_id long, org_id long, txn_type_id int, txn_date date, primary_quantity decimal(18,3), vendor_id long")
    g = aging.stores_aging(items, onhand, costs, txn, as_of=dt.date(2026, 6, 1)).first()
    qty, avg, last = D("10.375"), D("3.3333"), D("4.4449")
    assert (g.onhand_qty, g.average_cost, g.last_po_cost) == (qty, avg, last)
    assert g.onhand_value_avg_cost == _half_up(qty * avg, 2) and g.onhand_value_last_cost == _half_up(qty * last, 2)
    assert g.revaluation_exposure == _half_up(qty * (last - avg), 2) and g.cost_variance_pct == _half_up((last - avg) * 100 / avg, 2)
    assert g.avg_monthly_consumption == _half_up(D("1.375") / 5, 3) and g.months_of_cover == _half_up(qty * 5 / D("1.375"), 1)
