"""Merkle manifest of a dataset, with octopus multiproofs.

Rows are leaves of one tree per group, ordered by id; the groups' roots, ordered by group, are
the leaves of a top tree whose root stands for the dataset. A node is the SHA-256 of up to three
children, written as hex text and concatenated. Positions come from one range sort: a group that
holds a third of all rows spreads over as many sorted blocks as its rows need, and only the
(group, block) counts are summed up. Interior nodes are made six levels at a time, from chunks of
729 nodes, so no task sees more of a tree than that.

Proofs are made by leaf partition (sorted block), not by leaf: from its runs of positions each
block works out the fewest nodes that it can't derive from its own leaves, all blocks' requests
meet the node table in one join, and the block then derives the shared interiors once and cuts
each leaf's proof from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from .common import stored

ARITY = 3
LEVELS = 6  # made in one pass
PER_BLOCK = 32768
TOP = "^"  # the top tree; a group's tree is '-' (null group) or '=' and the group


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 (hex) of the fields, each '-' if null, else its UTF-8 byte count, ':' and its text."""
    def framed(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(framed, fields)), 256)


def _parent(children: Iterable[bytes]) -> bytes:
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def _up(n: int) -> int:
    return -(-n // ARITY)


def missing(own: Iterable[int], n: int) -> list[tuple[int, int]]:
    """The fewest (level, index) nodes that derive the root together with the leaves ``own`` of ``n``."""
    out, level, known = [], 0, set(own)
    while n > 1 and known:
        runs = {i // ARITY for i in known}
        out += [(level, i) for r in sorted(runs) for i in range(ARITY * r, min(ARITY * r + ARITY, n)) if i not in known]
        known, n, level = runs, _up(n), level + 1
    return out


def derive(own: Mapping[int, bytes], n: int, fetched: Mapping[tuple[int, int], bytes]) -> tuple[bytes, list[dict[int, bytes]]]:
    """The root over ``own`` leaves and ``fetched`` nodes, and per level all nodes known there."""
    levels, known = [], dict(own)
    while n > 1:
        level, runs = len(levels), sorted({i // ARITY for i in known})
        full = {i: known[i] if i in known else fetched[level, i]
                for r in runs for i in range(ARITY * r, min(ARITY * r + ARITY, n))}
        levels.append(full)
        known = {r: _parent(full[i] for i in range(ARITY * r, min(ARITY * r + ARITY, n))) for r in runs}
        n = _up(n)
    return known[0], levels


def single_proofs(own: Iterable[int], levels: Sequence[Mapping[int, bytes]], above: bytes = b"") -> dict[int, bytes]:
    """Each leaf's own proof: the siblings of its path from the bottom, then ``above``."""
    paths = [set(own)]
    for _ in levels:
        paths.append({i // ARITY for i in paths[-1]})
    proofs = {0: above}
    for path, full in zip(reversed(paths[:-1]), reversed(levels)):
        proofs = {i: b"".join(full[j] for j in range(i // ARITY * ARITY, i // ARITY * ARITY + ARITY) if j != i and j in full)
                  + proofs[i // ARITY] for i in path}
    return proofs


def folded(leaf: bytes, proof: bytes, places: Sequence[tuple[int, int]]) -> bytes | None:
    """The root that a leaf and its siblings give; ``places``: (index, count) in each tree.
    None if the proof has another length than the places ask for."""
    at = 0
    for i, n in places:
        while n > 1:
            own, width = i % ARITY, min(ARITY, n - i // ARITY * ARITY)
            end = at + 32 * (width - 1)
            leaf = _parent((proof[at:at + 32 * own], leaf, proof[at + 32 * own:end]))
            at, i, n = end, i // ARITY, _up(n)
    return leaf if at == len(proof) else None


def _sorted_blocks(rows: DataFrame, order: Sequence[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` (stored) in global order with their ``block`` and ``row`` in it, and the runs:
    per tree and block its first row, the tree's rows before it (``start``), here and at all."""
    spark = rows.sparkSession
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // PER_BLOCK))
    at = rows.repartitionByRange(blocks, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    at = stored(at, f"{name}-sorted")
    at = at.select("*", F.shiftright("at", 33).alias("block"), F.col("at").bitwiseAND((1 << 33) - 1).alias("row")).drop("at")
    runs = at.groupBy("tree", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("here"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("*", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("start"), F.sum("here").over(tree).alias("n"))
    return at, stored(runs, f"{name}-runs")


def _positions(rows: DataFrame, runs: DataFrame) -> DataFrame:
    return rows.join(runs, ["tree", "block"]).withColumn("idx", F.col("start") + F.col("row") - F.col("first"))


def _interior(leaves: DataFrame, most: int, name: str) -> list[DataFrame]:
    """All nodes over ``leaves`` (tree, n, idx, node as hex), the largest tree having ``most``:
    tables of (tree, n, level, idx, node), n being the count of nodes of that tree and level."""
    def up(nodes: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
        return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(nodes, r * ARITY + 1, ARITY), ""), 256))

    def named(j: int, level: int) -> Column:
        return F.transform(F.coalesce(F.col(f"l{j}"), F.array().cast("array<string>")),
                           lambda x, i: F.struct(F.col(f"n{j}").alias("n"), F.lit(level).alias("level"),
                                                 (F.col("part") * ARITY ** (LEVELS - j) + i).alias("idx"), x.alias("node")))

    out, base, wide = [], 0, ARITY ** LEVELS
    level = leaves.filter("n > 1").select("tree", "n", "idx", "node")
    while most > 1:
        part = F.floor(F.col("idx") / wide).alias("part")
        made = level.groupBy("tree", "n", part).agg(F.sort_array(F.collect_list(F.struct("idx", "node"))).alias("l0"))
        made = made.select("tree", "part", F.col("n").alias("n0"), F.col("l0.node").alias("l0"))
        for j in range(LEVELS):
            n = F.col(f"n{j}")
            made = made.select("*", F.when(n > 1, up(F.col(f"l{j}"))).alias(f"l{j + 1}"),
                               F.when(n > 1, F.ceil(n / ARITY)).alias(f"n{j + 1}"))
        made = made.select("tree", F.explode(F.flatten(F.array(*(named(j, base + j) for j in range(1, LEVELS + 1))))).alias("x"))
        rows = stored(made.select("tree", "x.*"), f"{name}-nodes")
        out.append(rows)
        base, most = base + LEVELS, -(-most // wide)
        level = rows.filter((F.col("level") == base) & (F.col("n") > 1)).select("tree", "n", "idx", "node")
    return out


def _requests(runs: pd.DataFrame) -> pd.DataFrame:
    """What one block must fetch: nodes of its groups' trees, and of the top tree."""
    out = [(t, level, i) for t, start, here, n in zip(runs["tree"], runs["start"], runs["here"], runs["n"])
           for level, i in missing(range(start, start + here), n)]
    out += [(TOP, level, i) for level, i in missing(runs["rank"].tolist(), int(runs["n_top"].iloc[0]))]
    made = pd.DataFrame(out, columns=["tree", "level", "idx"])
    made.insert(0, "block", runs["block"].iloc[0])
    return made


def _prove(key: tuple, left: pa.Table, right: pa.Table, schema: pa.Schema) -> pa.Table:
    """The rows of one block (``left``) with their proofs; ``right`` has its runs and fetched nodes."""
    trees: dict[str, dict] = {}
    runs = []
    for r in right.to_pylist():
        if r["node"] is None:
            runs.append(r)
        else:
            trees.setdefault(r["tree"], {})[r["level"], r["idx"]] = r["node"]
    left = left.sort_by("row")
    leaves = left.column("leaf").to_pylist()
    done = []
    for r in runs:
        own = {r["start"] + i: leaves[r["first"] + i] for i in range(r["here"])}
        done.append((r, own, *derive(own, r["n"], trees.get(r["tree"], {}))))
    tops = {r["rank"]: subroot for r, _, subroot, _ in done}
    root, levels = derive(tops, runs[0]["n_top"], trees.get(TOP, {}))
    above = single_proofs(tops, levels)
    cells: list[tuple] = [()] * left.num_rows
    for r, own, subroot, levels in done:
        proofs = single_proofs(own, levels, above[r["rank"]])
        for i in range(r["here"]):
            at = r["start"] + i
            cells[r["first"] + i] = (at, r["n"], r["rank"], r["n_top"], subroot, root, proofs[at])
    new = list(zip(*cells)) if cells else [()] * 7
    return pa.Table.from_arrays([left.column(n) for n in ("id", "leaf", "claimed")] + [pa.array(c, f.type) for c, f in zip(new, list(schema)[3:])],
                                schema=schema)


def prove(docs: DataFrame, id_col: str, group_col: str, fields: Sequence[str], claimed: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, claimed, position, n, group_rank, n_groups, subroot,
    root, proof.

    ``leaf`` is the digest of ``fields``; ``claimed`` another leaf digest (hex) to be checked in its
    place, the leaf where it is null. ``position`` of ``n`` is the row's place in its group,
    ``group_rank`` of ``n_groups`` the group's in the top tree; digests are 32 bytes, ``proof`` the
    siblings' bytes from the bottom to the root.

    A null group is a group of its own before all others, a null id comes before all others of its
    group. Rows that repeat an id are leaves of their own, ordered by their digest; equal rows too.
    An empty table gives an empty result (it has no root).
    """
    group, own = F.col(f"`{group_col}`").cast("string"), leaf_digest([F.col(f"`{f}`") for f in fields])
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("tree"),
                       F.unhex(own).alias("leaf"), F.unhex(claimed if claimed is not None else F.lit(None).cast("string")).alias("claimed"),
                       F.monotonically_increasing_id().alias("tie"))
    rows = rows.withColumn("claimed", F.coalesce("claimed", "leaf"))
    rows, runs = _sorted_blocks(stored(rows, "merkle-leaves"), ["tree", "id", "leaf", "tie"], "merkle")
    hexed = lambda c: F.lower(F.hex(c)).alias("node")
    bottom = _positions(rows, runs).select("tree", "n", F.lit(0).alias("level"), "idx", hexed("leaf"))
    inside = _interior(bottom, runs.agg(F.max("n")).first()[0] or 0, "merkle")
    both = lambda tables: reduce(DataFrame.unionByName, tables)
    tops = stored(both([bottom, *inside]).filter("n = 1").select(F.lit(TOP).alias("tree"), F.col("tree").alias("group"), "node"), "merkle-roots")
    tops, top_runs = _sorted_blocks(tops, ["group"], "merkle-top")
    tops = stored(_positions(tops, top_runs).select("tree", "n", F.lit(0).alias("level"), "idx", "node", "group"), "merkle-top")
    over = _interior(tops, top_runs.agg(F.max("n")).first()[0] or 0, "merkle-top")
    ranks = tops.select(F.col("group").alias("tree"), F.col("idx").alias("rank"), F.col("n").alias("n_top"))
    runs = stored(runs.join(ranks, "tree"), "merkle-ranked-runs")
    asked = runs.groupBy("block").applyInPandas(_requests, "block long, tree string, level int, idx long")
    nodes = both([x.select("tree", "level", "idx", "node") for x in (bottom, *inside, tops, *over)])
    fetched = asked.join(nodes, ["tree", "level", "idx"]).withColumn("node", F.unhex("node"))
    right = fetched.unionByName(runs.drop("level"), allowMissingColumns=True)
    kind = docs.schema[id_col].dataType.simpleString()
    spec = (f"id {kind}, leaf binary, claimed binary, position long, n long, group_rank long, n_groups long, "
            "subroot binary, root binary, proof binary")
    schema = to_arrow_schema(StructType.fromDDL(spec))
    proved = (rows.select("block", "row", "id", "leaf", "claimed").groupBy("block").cogroup(right.groupBy("block"))
              .applyInArrow(lambda key, a, b: _prove(key, a, b, schema), spec))
    return proved.withColumnRenamed("id", id_col)


def folded_root(leaf: Column, proof: Column, position: Column, n: Column, group_rank: Column, n_groups: Column) -> Column:
    """The root (32 bytes) recomputed from a leaf and its proof; null where the proof does not fit."""
    def fold(*cells: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in cells))
        return pa.array([folded(leaf, proof, ((i, n), (g, m))) for leaf, proof, i, n, g, m in rows], pa.binary())

    return F.arrow_udf(fold, "binary")(leaf, proof, position, n, group_rank, n_groups)
