"""Exact dedup by a heavy-hitter split.

Each text's SHA-256 is taken where it is read. A Misra-Gries summary per partition finds the
digests that may be frequent; their summaries are added up, the few candidates are counted
exactly, and the verified winners are broadcast, so rows of a huge group of copies are settled
where they are and never shuffled. The other digests use an ordinary shuffle.

Bounds: with share ``s`` and ``k`` counters, candidates have a summed counter of at least
``s*n - n/(k+1)``, and counters sum up to at most ``n``: at most ``1/(s - 1/(k+1))`` candidates
(342 by default) and ``1/s`` winners (256), whatever the data.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER_ASCII, as_bytes, per_text, stored


def _digest_rows(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
    sha = hashlib.sha256
    return pa.RecordBatch.from_arrays(
        [ids, pa.array([sha(t.translate(LOWER_ASCII)).digest() for t in texts], pa.binary())], ["id", "digest"])


def misra_gries(counters: dict, more: dict, k: int) -> int:
    """Adds ``more`` to ``counters`` and cuts them to ``k``; returns what each count may lack."""
    for d, n in more.items():
        counters[d] = counters.get(d, 0) + n
    if len(counters) <= k:
        return 0
    cut = sorted(counters.values(), reverse=True)[k]
    for d in [d for d, n in counters.items() if n <= cut]:
        del counters[d]
    for d in counters:
        counters[d] -= cut
    return cut


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = 1 / 256,
           counters: int = 1024) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The row with
    the largest id of a group stays. Repeated rows with that id count in ``group_size`` and all
    have ``kept`` true (they are the same document); a null id is smaller than any other, and
    in a group of null ids only all rows stay. An empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = stored(per_text(docs, id_col, text_col, f"id {id_type}, digest binary", _digest_rows), "digests")

    def summary(batches):
        held, lack, n = {}, 0, 0
        for batch in batches:
            n += batch.num_rows
            lack += misra_gries(held, Counter(batch.column(0).to_pylist()), counters)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *held], pa.binary()), pa.array([n, *held.values()], pa.int64()),
             pa.array([lack, *[0] * len(held)], pa.int64())], ["digest", "n", "lack"])

    sketch = (rows.select("digest").mapInArrow(summary, "digest binary, n long, lack long")
              .groupBy("digest").agg(F.sum("n").alias("n"), F.sum("lack").alias("lack")))
    sketch = stored(sketch, "misra-gries")
    total = sketch.filter("digest IS NULL").first()
    n, lack = (total["n"], total["lack"]) if total else (0, 0)
    least = max(2, share * n)
    maybe = sketch.filter(F.col("digest").isNotNull() & (F.col("n") >= least - lack)).select("digest")
    winners = (rows.join(F.broadcast(maybe), "digest").groupBy("digest")
               .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
               .filter(F.col("group_size") >= least))
    winners = stored(winners, "heavy-digests")
    heavy = rows.join(F.broadcast(winners), "digest")
    light = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    groups = light.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    both = heavy.unionByName(light.join(groups, "digest"))
    return both.select(F.col("id").alias(id_col), "keep_id", "group_size",
                       F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       F.lower(F.hex("digest")).alias("text_sha256"))


def _digest(text: pa.Array) -> pa.Array:
    """The digest that ``copies`` takes of a text."""
    return pa.array([hashlib.sha256((t or b"").translate(LOWER_ASCII)).digest() for t in as_bytes(text)], pa.binary())


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without exact copies: one row of each group stays, with all its columns.

    A row stays by its id and its own text's digest, so rows of one id (or of none) with
    different texts are told apart. Of rows that repeat both id and text one is kept as well.
    Columns of any name may be there.
    """
    kept = (copies(docs, id_col, text_col).filter("kept")
            .select(F.col(f"`{id_col}`").alias("__kept_id"), F.unhex("text_sha256").alias("__kept_sha")).distinct())
    # taken as not deterministic, or the join's null filter would have it computed a second time, in
    # a second Python worker of each task
    own = F.arrow_udf(_digest, "binary").asNondeterministic()
    rows = docs.select("*", own(docs[text_col]).alias("__own_sha"))
    joined = rows.join(kept, rows[id_col].eqNullSafe(kept["__kept_id"]) & (rows["__own_sha"] == kept["__kept_sha"]))
    return joined.dropDuplicates(["__kept_id", "__kept_sha"]).select([docs[c] for c in docs.columns])
