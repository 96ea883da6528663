"""Hard negatives by threshold joins over an inverted index (after L2AP, Anastasiu and Karypis, 2014).

Each round joins the open anchors, in blocks, with all rows, in blocks, and asks for scores of at
least a threshold per anchor; anchors whose windows are filled are done, the others go on with a
lower threshold, the last one being below every score. In a block pair the rows are indexed by
dimension. A row's leading dimensions stay out of the index as long as the norm of that prefix,
times the anchor's, is below the threshold: a pair that shares no indexed dimension can't reach
it. Partial scores are accumulated from the last dimensions on; after every few dimensions the
pairs that can't reach the threshold with the remaining norms are pruned, and what is left is
scored exactly.

A block pair returns the best few rows of each window only, so what meets in the merge is bounded
by blocks, not by how many rows are alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

BLOCK = 1 << 19  # numbers of a block of rows, on average; a block of anchors has half as many
BATCH = 256  # anchors scored at once
STEP = 16  # dimensions accumulated between two prunings
HIGH = (0.5, 0.25, 0.125)  # thresholds of the positives, in the highest possible score; then none
SLABS = (0.85, 0.7)  # thresholds of the negatives, in the positive's score; then the window's end
LOWEST, HIGHEST = -2**63, 2**63 - 1
_FOUND = "anchor struct<id:long,label:int,tie:long>, slot int, id long, score long"


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of whole numbers as doubles, filled with zeros up to ``width``."""
    sizes = np.array([len(v) for v in vectors], np.int64)
    out = np.zeros((len(sizes), width))
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in vectors.chunks]
    out[np.arange(width) < sizes[:, None]] = np.concatenate(flat) if flat else 0
    return out


def _norms_before(m: np.ndarray) -> np.ndarray:
    """[i, d]: the norm of row i's first d dimensions, rounded up."""
    squares = np.concatenate([np.zeros((len(m), 1)), np.cumsum(m * m, axis=1)], axis=1)
    return np.sqrt(squares) * (1 + 1e-9)


def candidates(anchors: np.ndarray, rows: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose score is at least the anchor's ``least``, exactly.

    Scores are whole numbers; those that may pass 2**53 are computed in Python's integers (and
    held to 64 bits).
    """
    none = np.zeros(0, np.int64)
    if not len(anchors) or not len(rows):
        return none, none, none
    order = np.argsort((rows * rows).sum(axis=0), kind="stable")  # the weakest dimensions lead
    anchors, rows = anchors[:, order], rows[:, order]
    a_norm, r_norm = _norms_before(anchors), _norms_before(rows)
    highest = float(a_norm[:, -1].max() * r_norm[:, -1].max())
    if highest >= 2.0 ** 53:
        whole = [np.array([[int(x) for x in v] for v in m], object) for m in (anchors, rows)]
        exact = whole[0] @ whole[1].T
        a, r = np.nonzero(exact >= least[:, None])
        return a, r, np.array([min(max(int(x), LOWEST), HIGHEST) for x in exact[a, r]], np.int64)
    kind = np.float32 if highest < 2.0 ** 24 else np.float64  # either holds every partial sum
    norms = np.maximum(a_norm[:, -1], 1e-300)
    share = max(0.0, float((least / norms).min()))  # a prefix of a smaller norm reaches no threshold
    cut = (r_norm[:, 1:] < share).sum(axis=1)  # dimensions before it are not in the index
    index = np.where(np.arange(rows.shape[1]) >= cut[:, None], rows, 0).astype(kind)
    weights = anchors.astype(kind)
    live = np.flatnonzero((cut < rows.shape[1]) | (share == 0))
    partial = np.zeros((len(anchors), len(live)), kind)
    for end in range(rows.shape[1], 0, -STEP):
        start = max(0, end - STEP)
        partial += weights[:, start:end] @ index[live, start:end].T
        done = np.maximum(start, cut[live])  # everything from here on is accumulated
        some = (partial + a_norm[:, done] * r_norm[live, done] >= least[:, None]).any(axis=0)
        live, partial = live[some], partial[:, some]
    done = cut[live]
    a, at = np.nonzero(partial + a_norm[:, done] * r_norm[live, done] >= least[:, None])
    r = live[at]
    score = np.zeros(len(a), np.int64)
    for i in range(0, len(a), 1 << 16):  # what was not indexed is added, some pairs at a time
        s = slice(i, i + (1 << 16))
        score[s] = np.einsum("ij,ij->i", anchors[a[s]], rows[r[s]])
    enough = score >= least[a]
    return a[enough], r[enough], score[enough]


def _block_pair(anchors: pa.Table, rows: pa.Table, same: bool, k: int) -> pa.Table:
    """The ``k`` best rows of each window that this block of rows has."""
    width = max((len(v) for t in (anchors, rows) for v in t.column("v")), default=0) or 1
    matrix, ids = _matrix(rows.column("v"), width), rows.column("id").to_numpy()
    labels, out = rows.column("label").to_numpy(), []
    for i in range(0, anchors.num_rows if rows.num_rows else 0, BATCH):
        part = anchors.slice(i, BATCH)
        names, windows = part.column("anchor").to_pylist(), part.column("windows").to_pylist()
        least = np.array([min(w["low"] for w in ws) for ws in windows], np.float64)
        a, r, score = candidates(_matrix(part.column("v"), width), matrix, least)
        own_label, own_id = (np.array([n[f] for n in names]) for f in ("label", "id"))
        fits = ((labels[r] == own_label[a]) == same) & (ids[r] != own_id[a])
        a, r, score = a[fits], r[fits], score[fits]
        order = np.lexsort((ids[r], -score.astype(object) if len(score) and score.min() == LOWEST else -score, a))
        a, r, score = a[order], r[order], score[order]
        for slot in range(max(map(len, windows))):
            low, high = (np.array([ws[slot][f] if slot < len(ws) else d for ws in windows], np.int64)
                         for f, d in (("low", 1), ("high", 0)))
            inside = np.flatnonzero((score >= low[a]) & (score <= high[a]))
            owner = a[inside]
            first = np.searchsorted(owner, owner, side="left")
            for j in inside[np.arange(len(owner)) - first < k]:
                out.append((names[a[j]], windows[a[j]][slot]["slot"], int(ids[r[j]]), int(score[j])))
    cells = list(zip(*out)) or [()] * 4
    name = pa.struct([("id", pa.int64()), ("label", pa.int32()), ("tie", pa.int64())])
    return pa.table([pa.array(c, t) for c, t in zip(cells, (name, pa.int32(), pa.int64(), pa.int64()))],
                    names=["anchor", "slot", "id", "score"])


def _search(wanted: DataFrame, items: DataFrame, blocks: int, parts: int, same: bool, k: int) -> DataFrame:
    """The ``k`` best rows (by score, then id) of each window of ``wanted`` (anchor, v, windows)."""
    keys = ["block", "part"]
    tasks = min(blocks * parts, 20_000)
    left = (wanted.withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(parts)).cast("int"))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks, *keys))
    right = (items.select("id", "label", "v", F.pmod(F.xxhash64("id", "label", "tie"), F.lit(blocks)).cast("int").alias("block"))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(tasks, *keys))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda a, b: _block_pair(a, b, same, k), _FOUND)
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def _until_filled(wanted: DataFrame, lows: list[Column], items: DataFrame, blocks: int, parts: int, same: bool, k: int) -> DataFrame:
    """``_search`` at falling thresholds: ``wanted`` (anchor, v, slot, low, high, ...) has a row for
    each window; ``lows`` are the thresholds in its columns, never below the window's ``low``."""
    settled = None
    for i, low in enumerate(lows):
        window = F.struct("slot", F.greatest(low, "low").alias("low"), "high")
        asked = wanted.groupBy("anchor").agg(F.first("v").alias("v"), F.collect_list(window).alias("windows"))
        found = stored(_search(asked, items, blocks, parts, same, k), "negatives-found")
        last = i + 1 == len(lows)
        full = found.filter(F.col("rank") == k).select("anchor", "slot")
        part = found if last else found.join(full, ["anchor", "slot"], "left_semi")
        settled = part if settled is None else settled.unionByName(part)
        if last:
            break
        wanted = stored(wanted.join(full, ["anchor", "slot"], "left_anti"), "negatives-open")
        if wanted.isEmpty():
            break
    return settled


def mine(rows: DataFrame, is_anchor: Column, positives: int, negatives: int, least: int, most: int, scale: int = 256,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """For each anchor and each of its ``positives``: rank, id and score of the first ``negatives``
    rows of another label with ``least * positive_score <= 100 * score <= most * positive_score``.

    Scores are inner products of the vectors' components floor(``scale`` * x); higher ones come
    first, ties by smaller id. An anchor's positives are its best other rows of its label.
    Rows with a null id, label, vector or component, or a component that is not finite, take no
    part. Rows alike in id, label and vector count once; rows of one id that differ are rows of
    their own, but a row never matches a row of its own id. A shorter vector is filled with
    zeros. Anchors without other rows of their label, and positives without a row in their
    window, give no row; an empty table gives an empty result.
    """
    vector = F.transform(F.col(f"`{vector_col}`"), lambda x: x.cast("double"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(vector, lambda x: F.when(F.abs(x * scale) < 2.0**53, F.floor(x * scale).cast("double")).otherwise(x * scale))
    taken = rows.filter(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label_col}`").isNotNull() & F.col(f"`{vector_col}`").isNotNull() & finite)
    items = taken.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("label"), whole.alias("v"),
                         F.coalesce(is_anchor, F.lit(False)).alias("is_anchor")).distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    items = stored(items.select("*", F.xxhash64("v").alias("tie"), norm.alias("norm")), "negatives-items")
    n, n_anchors, width, top = items.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.max(F.size("v")), F.max("norm")).first()
    width, top = max(width or 1, 1), top or 0.0
    blocks, parts = (max(1, -(-x * width // size)) for x, size in ((n, BLOCK), (n_anchors, BLOCK // 2)))
    bottom = F.lit(LOWEST).cast("long")
    anchors = items.filter("is_anchor").select(F.struct("id", "label", "tie").alias("anchor"), "v", "norm", F.lit(0).alias("slot"),
                                               bottom.alias("low"), F.lit(HIGHEST).cast("long").alias("high"))
    lows = [F.floor(F.col("norm") * (top * share)).cast("long") for share in HIGH] + [bottom]
    near = stored(_until_filled(anchors, lows, items, blocks, parts, True, positives), "negatives-positives")
    bound = lambda percent, rounded: F.expr(f"(score - pmod(score, 100)) div 100 * {percent} + cast({rounded}(pmod(score, 100) * {percent} / 100.0) as long)")
    pairs = near.select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
                        bound(least, "ceil").alias("low"), bound(most, "floor").alias("high"))
    windows = pairs.filter("low <= high").join(anchors.select("anchor", "v"), "anchor")
    lows = [F.floor(F.col("positive_score") * share).cast("long") for share in SLABS] + [bottom]
    far = _until_filled(windows, lows, items, blocks, parts, False, negatives)
    return far.join(pairs, ["anchor", "slot"]).select(
        F.col("anchor.id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
