"""Document fingerprints: invertible Bloom lookup tables of paragraph digests, in Spark's functions.

A paragraph ends at a line break or a sentence mark, and after 100 code points at the latest.
The set of a text's paragraph digests goes into cells: each digest is added to one cell of
each of three sub-tables, a cell being (count, XOR of digests, XOR of their check hashes). The
tables of two versions subtract cell by cell, so what they share cancels; peeling then takes a
digest out of a cell that holds just one, removes it from its other cells, and so on, until all
differing digests are out. Where digests stay behind, the pair is tried again with four times
the cells. The likeness of two texts is the Jaccard index of their digest sets, from the number
of differing digests and the sets' sizes.

Peeling runs for all pairs at once: a row is a cell of a pair, a step is an aggregation by
(pair, cell), and as rows are partitioned by pair from the start, no step moves data. Steps
take the sub-tables in turn, so a digest is never taken out twice in one step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

CELLS = 24  # of the fingerprint itself
STEPS = 12
RETRIES = 5
_PIECE = r"[^.!?\n]{1,100}[.!?\n]*|[.!?\n]+"


def digests(text: Column) -> Column:
    """The distinct 64-bit digests of a text's paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), lambda p: F.xxhash64(p)))


def _cell(digest: Column, table: int, cells: Column, seed: Column) -> Column:
    """The digest's cell in a sub-table (0, 1, 2) of a third of ``cells``."""
    third = (cells / 3).cast("long")
    return F.pmod(F.xxhash64(digest, seed, F.lit(table)), third) + third * table


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def sketch(found: Column, cells: int = CELLS) -> Column:
    """The table of a digest set as text: a cell is count:digests:checks in hex (32 bits of the last)."""
    third = cells // 3

    def table(t: int) -> Column:
        zero = F.lit(0).cast("long")
        homes = F.transform(found, lambda d: F.struct(_cell(d, t, F.lit(cells), F.lit(0)).alias("c"), d.alias("d")))
        empty = F.struct(F.lit(0).alias("n"), zero.alias("x"), zero.alias("y"))

        def add(s, h):
            return F.struct((s["n"] + 1).alias("n"), s["x"].bitwiseXOR(h["d"]).alias("x"), s["y"].bitwiseXOR(_check(h["d"])).alias("y"))

        def shown(s):
            return F.concat_ws(":", F.hex(s["n"]), F.hex(s["x"]), F.hex(F.shiftrightunsigned(s["y"], 32)))

        own = F.sequence(F.lit(t * third).cast("long"), F.lit(t * third + third - 1).cast("long"))
        return F.transform(own, lambda c: F.aggregate(F.filter(homes, lambda h: h["c"] == c), empty, add, shown))

    return F.array_join(F.concat(*[table(t) for t in range(3)]), ".")


def _peel(pairs: DataFrame, seed: int) -> DataFrame:
    """(pair, differ): the number of differing digests of each pair (pair, plus, minus, cells),
    null where some could not be peeled."""
    def cell(digest: str, t: int) -> str:
        return f"pmod(xxhash64({digest}, {seed}, {t}), cells div 3) + (cells div 3) * {t}"

    def added(rows: DataFrame) -> DataFrame:
        return rows.groupBy("pair", "cells", "cell").agg(F.expr("sum(n) AS n"), F.expr("bit_xor(x) AS x"), F.expr("bit_xor(y) AS y")).filter(
            "n != 0 OR x != 0 OR y != 0")

    signed = "inline(concat(transform(plus, d -> struct(d AS d, 1L AS n)), transform(minus, d -> struct(d AS d, -1L AS n))))"
    part = pairs.repartition("pair").selectExpr("pair", "cells", signed)
    rows = added(part.selectExpr("pair", "cells", "n", "d AS x", "xxhash64(d, 'check') AS y",
                                 f"explode(array({', '.join(cell('d', t) for t in range(3))})) AS cell"))
    for step in range(STEPS):
        t = step % 3
        pure = f"abs(n) = 1 AND y = xxhash64(x, 'check') AND cell = {cell('x', t)}"
        out = ", ".join(f"struct({cell('x', k)} AS cell, -n AS n, x, y)" for k in range(3) if k != t)
        # what has been taken out is counted in cell -1
        rows = added(rows.selectExpr("pair", "cells", f"inline(IF({pure}, array({out}, struct(-1L AS cell, 1L AS n, 0L AS x, 0L AS y)), "
                                                      "array(struct(cell, n, x, y))))"))
    return rows.groupBy("pair").agg(F.count(F.when(F.col("cell") >= 0, 1)).alias("left"),
                                    F.sum(F.when(F.col("cell") == -1, F.col("n"))).alias("out")).select(
        "pair", F.when(F.col("left") == 0, F.coalesce("out", F.lit(0).cast("long"))).alias("differ"))


def differences(pairs: DataFrame) -> DataFrame:
    """(pair, differ) of all ``pairs`` (pair, plus, minus, cells): digests that one set has alone.

    Tried with ``cells``, then four times as many for those that fail, and so on; a pair that
    fails ``RETRIES`` times (its odds are negligible) is counted from the sets themselves.
    A pair without any digest in its cells differs in none.
    """
    done = []
    for seed in range(RETRIES):
        tried = stored(_peel(pairs, seed), f"peeled-{seed}")
        done.append(tried.filter("differ IS NOT NULL"))
        failed = tried.filter("differ IS NULL").select("pair")
        if failed.limit(1).count() == 0:
            break
        pairs = stored(pairs.join(failed, "pair", "left_semi").withColumn("cells", F.col("cells") * 4), "unpeeled")
    else:
        done.append(pairs.select("pair", (F.size(F.array_except("plus", "minus")) + F.size(F.array_except("minus", "plus"))).cast("long")
                                 .alias("differ")))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def next_documents(rows: DataFrame, n_rows: int, per_part: int = 50_000) -> DataFrame:
    """``rows`` (id, th, ...) with ``next`` (id, th of the next in order; the first's after the last).

    Rows are range-partitioned by id and written; the next one is looked up inside a part, and
    for a part's last row among the parts' first rows (one per part).
    """
    parts = max(1, -(-n_rows // per_part))
    placed = stored(rows.repartitionByRange(parts, "id", "th").withColumn("part", F.spark_partition_id()), "ordered")
    first = placed.groupBy("part").agg(F.min(F.struct("id", "th")).alias("first"))
    by = Window.orderBy("part")
    after = first.select("part", F.coalesce(F.lead("first").over(by), F.first("first").over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = F.lead(F.struct("id", "th")).over(Window.partitionBy("part").orderBy("id", "th"))
    return placed.withColumn("inside", inside).join(after, "part").withColumn("next", F.coalesce("inside", "after")).drop(
        "inside", "after", "part")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of the code points replaced by the first as many of the
    next document's. Null counts as empty; two empty texts are alike (1.0). Null ids come first;
    rows that repeat both id and text are one document (and all get its result); a single
    document is its own next. An empty table gives an empty result.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn(
        "th", F.xxhash64("text"))
    rows = stored(texts.select("id", "th", F.length("text").cast("long").alias("n_chars")), "lengths")
    n = rows.count()
    single = rows.distinct()
    repeated = single.count() < n
    link = stored(next_documents(single, n).select("id", "th", "n_chars", "next", F.floor(F.col("n_chars") / 4).cast("int").alias("m")),
                  "next-documents")
    t, k = texts.alias("t"), link.alias("k")
    head = t.join(k, F.col("t.id").eqNullSafe(F.col("k.next.id")) & (F.col("t.th") == F.col("k.next.th"))).select(
        F.col("k.id").alias("key_id"), F.col("k.th").alias("key_th"), F.col("k.next").alias("next"), F.col("k.n_chars").alias("n_chars"),
        F.col("k.m").alias("m"), F.expr("substring(t.text, 1, k.m)").alias("head"))
    t = texts.alias("t")
    both = t.join(head.alias("h"), F.col("t.id").eqNullSafe(F.col("h.key_id")) & (F.col("t.th") == F.col("h.key_th")))
    edited = both.select("id", "th", "next", "n_chars", digests(F.col("text")).alias("own"),
                         F.expr("concat(substring(text, 1, cast(n_chars - m as int)), head)").alias("edited"))
    edited = edited.select("id", "th", "next", "n_chars", "own", F.sha2("edited", 256).alias("edited_sha256"),
                           digests(F.col("edited")).alias("changed"))
    if repeated:
        edited = edited.dropDuplicates(["id", "th"])
    edited = stored(edited, "edited")
    other = edited.select(F.col("id").alias("next_id"), F.col("th").alias("next_th"), F.col("own").alias("following"))
    pairs = edited.join(other, F.col("next.id").eqNullSafe(F.col("next_id")) & (F.col("next.th") == F.col("next_th")))
    pairs = stored(pairs.drop("next", "next_id", "next_th").withColumn("row", F.monotonically_increasing_id()), "pairs")

    def cells(plus: str, minus: str, share: float) -> Column:
        # a first guess at the number of differing digests
        return (3 * (8 + F.ceil((F.size(plus) + F.size(minus)) * share / 3))).cast("long")

    asked = pairs.select((F.col("row") * 2).alias("pair"), F.col("own").alias("plus"), F.col("changed").alias("minus"),
                         cells("own", "changed", 0.5).alias("cells")).unionByName(
        pairs.select((F.col("row") * 2 + 1).alias("pair"), F.col("own").alias("plus"), F.col("following").alias("minus"),
                     cells("own", "following", 1.5).alias("cells")))
    found = differences(asked)
    found = found.groupBy((F.col("pair") / 2).cast("long").alias("row")).agg(
        F.max(F.when(F.col("pair") % 2 == 0, F.col("differ"))).alias("d0"), F.max(F.when(F.col("pair") % 2 == 1, F.col("differ"))).alias("d1"))

    def near(differ: str, minus: str) -> Column:
        total, d = F.size("own") + F.size(minus), F.coalesce(F.col(differ), F.lit(0))
        return F.when(total == 0, F.lit(1.0)).otherwise((total - d) / (total + d))

    out = pairs.join(found, "row", "left").select(
        "id", "th", "n_chars", "edited_sha256", sketch(F.col("own")).alias("fingerprint"), sketch(F.col("changed")).alias("edited_fingerprint"),
        near("d0", "changed").alias("near_edited"), near("d1", "following").alias("near_next"))
    if repeated:
        out = rows.select(F.col("id").alias("row_id"), F.col("th").alias("row_th")).join(
            out, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_th") == F.col("th"))).drop("row_id", "row_th")
    return out.withColumnRenamed("id", id_col).drop("th")
