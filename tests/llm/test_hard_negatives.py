"""Hard negatives against all scores of all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparesledger.llm import hard_negatives
from sparesledger.plans.compare import compare, duckdb_connection

SCHEMA = "vec_id long, embedding array<float>, label int, id int, block int, score double"


def brute(rows, anchors, positives=5, negatives=3, least=50, most=95):
    items = {(i, tuple(math.floor(256 * x) for x in v), lab) for i, v, lab in rows
             if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for a in items:
        if not anchors(a[0]):
            continue
        score = lambda r: sum(x * y for x, y in zip(a[1], r[1]))
        ranked = sorted(((-score(r), r[0], r[2]) for r in items if r[0] != a[0]))
        for s, i, _ in [r for r in ranked if r[2] == a[2]][:positives]:
            fits = [r for r in ranked if r[2] != a[2] and 50 * -s <= 100 * -r[0] <= 95 * -s]
            out += [(a[0], i, k, j, -s, -n) for k, (n, j, _) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, anchors, **more):
    df = spark.createDataFrame([(*r, 1, 2, 0.5) for r in rows], SCHEMA).repartition(3)
    found = hard_negatives.mine(df, anchors(F.col("vec_id")), 5, 3, 50, 95, **more)
    return sorted(tuple(r) for r in found.collect())


def vectors(n, width=24, seed=1):
    rnd = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rnd.normal(0, .2, width)], int(rnd.integers(0, 4))) for i in range(n)]


def test_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 24 * 90)  # several blocks of either side
    rows = vectors(700)
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(200)]  # one vector in many rows: ties by id
    rows += [(2000 + i, [x * 30 for x in rows[5][1]], 9) for i in range(3)]  # long vectors, few of their label
    every = lambda i: i % 7 == 0
    assert mined(spark, rows, every) == brute(rows, every)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 2.0, 0.5], 1), (2, [1.0, nan], 1), (3, [inf, 1.0], 1), (4, None, 1), (5, [1.0, None], 1),
            (6, [0.9, 1.5], None), (None, [1.0, 2.0], 2), (7, [0.9, 1.5], 2), (7, [0.9, 1.5], 2), (7, [0.7, 1.5], 2), (8, [], 2), (8, [-1.0, -1.0], 3),
            (9, [0.0, 0.0], 4), (10, [0.0], 4), (0, [0.5, 1.0], 2), (0, [0.5, 1.0], 1)]
    every = lambda i: (i >= 0) if isinstance(i, int) else (i >= 0)
    assert mined(spark, rows, every) == brute(rows, every)
    assert mined(spark, [], every) == []


def test_scores_beyond_doubles(spark):
    rows = [(i, [1e6 * (1 + i % 11), 3e6 - i * 7, float(i)], i % 2) for i in range(30)]
    every = lambda i: i % 3 == 0
    got = mined(spark, rows, every)
    assert got == brute(rows, every) and max(r[4] for r in got) > 2**53


@pytest.mark.parametrize("low", [-np.inf, -50.0, 0.0, 40.0, 5000.0])
def test_candidates_are_exactly_those_at_the_threshold(low):
    rnd = np.random.default_rng(4)
    for scale in (10, 3000, 10**8):
        a, r = (np.floor(rnd.normal(0, scale, (n, 40)) * (rnd.random((n, 40)) < .5)) for n in (30, 200))
        least = np.full(30, low * scale * scale) if np.isfinite(low) else np.full(30, low)
        whole = np.vectorize(int, otypes=[object])
        exact = whole(a) @ whole(r).T
        got = {(i, j): s for i, j, s in zip(*(x.tolist() for x in hard_negatives.candidates(a, r, least)))}
        assert got == {(i, j): int(exact[i, j]) for i in range(30) for j in range(200) if exact[i, j] >= least[i]}


def test_query_matches_its_sql(spark):
    from sparesledger.llm import queries

    sf = "/root/testdata/sf0.001"
    r = compare(spark, "op12", queries.op12_hard_negatives, queries.ORACLE_SQL["op12_hard_negatives"], sf, duckdb_connection(sf))
    assert r.ok, r.detail
