"""Repeated passages: what substring dedup (words) and suffix-array dedup (bytes) share.

A text is a row of units (word hashes or bytes). All windows of ``length`` units are to be
compared across the corpus without moving every window:

1. every window names one short gram in it, the one with the least hash (its anchor); equal
   windows name equal anchors, and a text has about 2/(length - gram) anchors a unit;
2. texts in which an anchor occurs that occurs again anywhere go on, the others are done;
3. there, each anchor is extended to a gram of twice the length, to the right and to the left:
   every window around the anchor holds one of the two. The windows of one extended gram are a
   run of starts ``lo .. hi``, and the units ``lo .. hi + length`` are its context.

Rows of one extended gram and one context agree in all their windows, so they are counted, not
compared; windows are only looked at where one gram stands in different contexts, that is at
the ends of a shared passage. All counts are over all documents.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import U64, as_bytes, fmix64, in_blocks, stored, work_folder

_BASES = (U64(0x9E3779B97F4A7C15 | 1), U64(0xD6E8FEB86659FD93 | 1))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as needed."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, n.bit_length())
            for name, b in (("up", self.base), ("down", self.inverse)):
                x = np.full(size, b, dtype=U64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


_POWERS = [Powers(b) for b in _BASES]


class Grams:
    """Hashes of any stretch of units: polynomial prefix sums modulo 2**64, then a finaliser."""

    def __init__(self, units: np.ndarray, which: int = 0):
        n = len(units)
        up, self.down = _POWERS[which](n + 1)
        self.sums = np.zeros(n + 1, dtype=U64)
        np.cumsum(units * up[:n], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return fmix64((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(U64))

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return fmix64((self.sums[size:] - self.sums[:n]) * self.down[:n] + U64(size))


@dataclass(frozen=True)
class Shape:
    length: int  # units of a window
    gram: int  # of an anchor
    half: int  # of an extended anchor, at most (length + gram + 1) / 2


def anchors(hashes: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor position, first, last window start) of a text's gram hashes; leftmost of ties."""
    width = shape.length - shape.gram + 1
    value, index, span = hashes, np.arange(len(hashes)), 1
    while span < width:
        step = min(span, width - span)
        less = value[step:] < value[:-step]
        value = np.where(less, value[step:], value[:-step])
        index = np.where(less, index[step:], index[:-step])
        span += step
    first = np.flatnonzero(np.r_[True, index[1:] != index[:-1]]) if len(index) else np.zeros(0, dtype=np.int64)
    return index[first], first, np.r_[first[1:], len(index)] - 1


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def document_key(id_col: str, text_col: str) -> Column:
    """A 64-bit name of a document (its id and text), by which its rows are joined."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))


def survey(docs: DataFrame, id_col: str, text_col: str, units, shape: Shape, unit_count) -> DataFrame:
    """One stored row per input row: id, key, n units, sha256 of the text as it would be kept
    whole, anchors (their hashes). ``units(bytes)`` gives the unit hashes, ``unit_count(bytes)``
    (count, the bytes kept if nothing is removed)."""

    def rows(ids, keys, texts):
        n, sha, flat, ends = [], [], [], [0]
        for t in texts:
            count, whole = unit_count(t)
            n.append(count)
            sha.append(hashlib.sha256(whole).digest())
            found = np.zeros(0, dtype=U64)
            if count >= shape.length:
                h = Grams(units(t)).all(shape.gram)
                found = h[anchors(h, shape)[0]]
            flat.append(found)
            ends.append(ends[-1] + len(found))
        return pa.RecordBatch.from_arrays(
            [ids, keys, pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(np.concatenate(flat)))], ["id", "key", "n", "sha", "anchors"])

    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in as_bytes(batch.column(2))]
            for a, b in in_blocks(texts):
                yield rows(batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), texts[a:b])

    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_col}`"), document_key(id_col, text_col), F.col(f"`{text_col}`"))
    return stored(texts.mapInArrow(run, f"id {id_type}, key long, n long, sha binary, anchors array<long>"), "survey")


def suspects(docs: DataFrame, id_col: str, text_col: str, found: DataFrame) -> DataFrame:
    """The texts in which an anchor stands that stands again anywhere: id, key, text, again (those
    anchors), as a table bucketed by key, so that later joins by key leave the texts in place.

    Rows that repeat both id and text are one document.
    """
    spark = docs.sparkSession
    each = found.select("key", F.explode("anchors").alias("h"))
    # stored, so that the join below shuffles both sides and Spark can split an anchor that a large
    # share of all texts has
    again = stored(each.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("h"), "again")
    marked = stored(each.join(again, "h", "left_semi").groupBy("key").agg(F.collect_set("h").alias("again")), "marked")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), document_key(id_col, text_col).alias("key"),
                        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    both = texts.join(marked, "key")
    # the narrow survey tells whether any row repeats another
    if found.groupBy("key").count().filter("count > 1").limit(1).count():
        both = both.dropDuplicates(["key", "id"])
    name = f"llm_suspects_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (both.write.bucketBy(buckets, "key").option("compression", "zstd")
     .option("path", f"{work_folder(spark).rstrip('/')}/llm/{name}").saveAsTable(name))
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files and their buckets stay with the frame, no name is left behind
    return table


def extended(texts: DataFrame, units, shape: Shape) -> DataFrame:
    """Rows g, c (hashes of extended gram and context), id, key, lo, hi of the suspects'
    repeated anchors (stored); grams that stand once are left out."""

    def run(batches):
        for batch in batches:
            ids, key, all_texts, again = batch.column(0), batch.column(1), as_bytes(batch.column(2)), batch.column(3)
            for a, b in in_blocks(all_texts, 1 << 20):
                cols, row = [[] for _ in range(4)], []
                for i in range(a, b):
                    u = units(all_texts[i])
                    one = Grams(u)
                    h = one.all(shape.gram)
                    p, lo, hi = anchors(h, shape)
                    keep = np.isin(h[p].view(np.int64), again[i].values.to_numpy())
                    p, lo, hi = p[keep], lo[keep], hi[keep]
                    turn = p - (shape.length - shape.half)  # from here on the right gram is inside
                    right = hi >= turn
                    left = lo < turn
                    lo2, hi2 = np.r_[np.maximum(lo, turn)[right], lo[left]], np.r_[hi[right], np.minimum(hi, turn - 1)[left]]
                    start = np.r_[p[right], p[left] + shape.gram - shape.half]
                    g = one(start, start + shape.half)
                    g ^= np.r_[np.zeros(right.sum(), dtype=U64), np.ones(left.sum(), dtype=U64)]
                    # the context's hash also says where in it the gram stands
                    shift = fmix64((start - lo2).astype(U64) + U64(1))
                    for c, x in zip(cols, (g, one(lo2, hi2 + shape.length) ^ shift, lo2, hi2)):
                        c.append(x)
                    row.append(np.full(len(g), i))
                if row:
                    at = pa.array(np.concatenate(row))
                    g, context, lo2, hi2 = (np.concatenate(c) for c in cols)
                    yield pa.RecordBatch.from_arrays(
                        [_signed(g), _signed(context), ids.take(at), key.take(at),
                         pa.array(lo2.astype(np.int32)), pa.array(hi2.astype(np.int32))],
                        ["g", "c", "id", "key", "lo", "hi"])

    id_type = texts.schema["id"].dataType.simpleString()
    rows = stored(texts.select("id", "key", "text", "again").mapInArrow(
        run, f"g long, c long, id {id_type}, key long, lo int, hi int"), "extended")
    several = stored(rows.groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("g"), "several")
    return stored(rows.join(several, "g", "left_semi"), "repeated-grams")


def contexts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(groups, open): rows counted by gram and context, with the first occurrence of each; and
    those groups whose gram also stands in another context."""
    groups = stored(rows.groupBy("g", "c").agg(
        F.count(F.lit(1)).alias("k"), F.min(F.struct("id", "key", "lo", "hi")).alias("first")), "contexts")
    several = groups.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups, groups.join(several.select("g"), "g", "left_semi")


def by_text(ranges: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts with the list of their ranges (structs): id, key, text, ranges."""
    fields = [c for c in ranges.columns if c not in ("id", "key")]
    lists = ranges.groupBy("key").agg(F.collect_list(F.struct(*fields)).alias("ranges"))
    return texts.join(lists, "key").select("id", "key", "text", "ranges")


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n units lie in one of the ranges [start, end)."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, ends, -1)
    return np.cumsum(steps[:-1]) > 0


def outcome(found: DataFrame, changed: DataFrame) -> DataFrame:
    """Each input row with its text's outcome: id, key, n, sha and the columns of ``changed``
    (null where nothing is removed)."""
    return found.select("id", "key", "n", "sha").join(changed.drop("id"), "key", "left")
