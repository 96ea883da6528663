"""The manifest against a plain tree over all rows, and its multiproofs for any set of leaves."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sparesledger.llm import merkle
from sparesledger.plans.compare import compare, duckdb_connection

H = lambda text: hashlib.sha256(text.encode()).hexdigest()
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, position int, block int, tree string"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + 3])) for i in range(0, len(levels[-1]), 3)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        start = i // 3 * 3
        out += [x for j, x in enumerate(level[start:start + 3], start) if j != i]
        i //= 3
    return out


def brute(rows):
    """(id, leaf) -> list of (position, n, subroot, root, proof), one per row."""
    leaf = lambda r: H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r[:5]))
    groups = {}
    for r in rows:
        groups.setdefault((r[1] is not None, (r[1] or "").encode()), []).append(((r[0] is not None, r[0] or 0), leaf(r), r[0]))
    trees = [(tree([x[1] for x in sorted(g, key=lambda x: x[:2])]), sorted(g, key=lambda x: x[:2])) for _, g in sorted(groups.items())]
    top = tree([t[-1][0] for t, _ in trees])
    out = {}
    for rank, (t, g) in enumerate(trees):
        for i, (_, digest, doc) in enumerate(g):
            out.setdefault((doc, digest), []).append((i, len(g), t[-1][0], top[-1][0], "".join(proof(t, i) + proof(top, rank))))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "t") for r in rows], SCHEMA).repartition(3)
    got = {}
    for r in merkle.prove(docs, "doc_id", "source", FIELDS).collect():
        assert r.claimed == r.leaf
        places = ((r.position, r.n), (r.group_rank, r.n_groups))
        assert merkle.folded(bytes(r.leaf), bytes(r.proof), places) == bytes(r.root)
        got.setdefault((r.doc_id, r.leaf.hex()), []).append((r.position, r.n, r.subroot.hex(), r.root.hex(), r.proof.hex()))
    want = brute(rows)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_manifest(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice([None, "", "a", "é", "é", "z", "é"]), rnd.choice([None, "en"]), rnd.choice([None, 5]), rnd.choice([None, "", "a\nb", "ü" * 2000]))
            for i in range(400)]
    rows += [(900 + i, f"s{i}", "en", 1, "t") for i in range(40)]  # groups of a lone leaf
    rows += [(None, "a", "en", 1, "x"), (None, "a", "en", 1, "y"), (3, "a", None, None, "again")] + [(5, "z", "en", 1, "same")] * 30
    check(spark, rows)


def test_one_group_deeper_than_a_pass(spark):
    check(spark, [(i, "hot" if i else "cold", None, i, None) for i in range(2200)])


def test_one_row_and_none(spark):
    check(spark, [(7, None, None, None, None)])
    assert merkle.prove(spark.createDataFrame([], SCHEMA), "doc_id", "source", FIELDS).count() == 0


def test_claimed_leaf_that_differs_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, f"t\n{i}") for i in range(20)], SCHEMA[:SCHEMA.index(", leaf")])
    other = F.when(F.col("doc_id") % 2 == 0, merkle.leaf_digest([F.lit("x")]))
    proved = merkle.prove(docs, "doc_id", "source", FIELDS, other)
    folded = merkle.folded_root(*(F.col(c) for c in ("claimed", "proof", "position", "n", "group_rank", "n_groups")))
    for r in proved.withColumn("folded", folded).collect():
        assert (r.folded == r.root) == (r.doc_id % 2 == 1)
    short = merkle.folded_root(F.col("leaf"), F.unhex(F.lit("00")), *(F.col(c) for c in ("position", "n", "group_rank", "n_groups")))
    assert proved.select(short.alias("x")).filter("x IS NOT NULL").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 10, 27, 28, 100])
def test_multiproof_is_enough_and_no_more(n):
    rnd = random.Random(n)
    levels = tree([H(str(i)) for i in range(n)])
    for _ in range(20):
        own = rnd.sample(range(n), rnd.randint(1, n))
        asked = merkle.missing(own, n)
        nodes = {(lv, i): bytes.fromhex(levels[lv][i]) for lv, i in asked}
        root, known = merkle.derive({i: bytes.fromhex(levels[0][i]) for i in own}, n, nodes)
        assert root.hex() == levels[-1][0]
        assert {i: p.hex() for i, p in merkle.single_proofs(own, known).items()} == {i: "".join(proof(levels, i)) for i in own}
        for lv, i in asked:  # none of them stands above a leaf of its own
            assert not any(j // 3 ** lv == i for j in own)
        assert len(asked) == len(set(asked))


def test_query_matches_its_sql(spark):
    from sparesledger.llm import queries

    sf = "/root/testdata/sf0.001"
    r = compare(spark, "op11", queries.op11_merkle_manifest, queries.ORACLE_SQL["op11_merkle_manifest"], sf, duckdb_connection(sf))
    assert r.ok, r.detail
