"""Substring dedup by level-wise doubling.

Windows of a quarter of the length (9 of 35 words) that occur once are dropped with all that
holds them; those that repeat are extended to twice the length (18), and again, up to the
asked length: no candidate is compared at a length unless its part repeats at half of it. See
``passages`` for how a level samples and counts windows. Words are compared by 64-bit hashes
of their bytes, windows by 128-bit hashes of these.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages
from .common import WordHashes, as_bytes, stored

_WORDS = WordHashes()


def _units(text: bytes) -> np.ndarray:
    return _WORDS.of(text.split())  # bytes.split() parts at 0x20 and 0x09-0x0D


def _whole(text: bytes) -> tuple[int, bytes]:
    words = text.split()
    return len(words), b" ".join(words)


def shape(window: int) -> passages.Shape:
    half = -(-window // 2)
    return passages.Shape(window, -(-half // 2), half)


def _windows(batches, size: int):
    """Each window of the open ranges: w1, w2 (128-bit hash), k (occurrences), id, key, start."""
    for batch in batches:
        texts = as_bytes(batch.column(2))
        for i, text in enumerate(texts):
            ranges = batch.column(3)[i].values
            lo, hi, k = (ranges.field(f).to_numpy().astype(np.int64) for f in ("lo", "hi", "k"))
            u = _units(text)
            n = hi - lo + 1
            start = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w1, w2 = (passages.Grams(u, w)(start, start + size) for w in (0, 1))
            same = pa.array(np.full(len(start), i))
            yield pa.RecordBatch.from_arrays(
                [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.repeat(k, n)),
                 batch.column(0).take(same), batch.column(1).take(same), pa.array(start.astype(np.int32))],
                ["w1", "w2", "k", "id", "key", "lo"])


def _cut(batches, size: int):
    for batch in batches:
        texts = as_bytes(batch.column(2))
        kept, removed = [], []
        for i, text in enumerate(texts):
            ranges = batch.column(3)[i].values
            words = text.split()
            gone = passages.covered(len(words), ranges.field("lo").to_numpy(), ranges.field("hi").to_numpy() + size)
            removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()),
             pa.array([hashlib.sha256(x).digest() for x in kept], pa.binary()),
             pa.array([x.decode() for x in kept], pa.string())], ["id", "key", "removed", "kept_sha", "kept_text"])


def _run(docs: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame]:
    """(every row's survey, texts that lose words: id, key, removed, kept_sha, kept_text)."""
    levels = shape(window)
    found = passages.survey(docs, id_col, text_col, _units, levels, _whole)
    texts = passages.suspects(docs, id_col, text_col, found)
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = passages.extended(texts, _units, levels)
    groups, open_ = passages.contexts(rows)
    repeated = rows.join(groups.filter("k > 1").select("g", "c"), ["g", "c"], "left_semi").select(
        "id", "key", "lo", "hi")
    ends = passages.by_text(open_.select("first.*", "k"), texts)
    windows = stored(ends.mapInArrow(lambda b: _windows(b, window), f"w1 long, w2 long, k long, id {id_type}, key long, lo int"),
                     "windows")
    again = windows.groupBy("w1", "w2").agg(F.sum("k").alias("n")).filter("n > 1").select("w1", "w2")
    single = windows.filter("k = 1").join(again, ["w1", "w2"], "left_semi").select("id", "key", "lo", F.col("lo").alias("hi"))
    ranges = repeated.unionByName(single)
    return found, passages.by_text(ranges, texts).mapInArrow(
        lambda b: _cut(b, window), f"id {id_type}, key long, removed long, kept_sha binary, kept_text string")


def repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 35) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256.

    A word goes when a window of ``window`` words that covers it also starts anywhere else, the
    same document included; all occurrences go. A null or short text loses nothing; rows that
    repeat both id and text are one document; an empty table gives an empty result.
    """
    found, changed = _run(docs, id_col, text_col, window)
    rows = passages.outcome(found, changed.drop("kept_text"))
    return rows.select(F.col("id").alias(id_col), F.col("n").alias("n_words"),
                       F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
                       F.lower(F.hex(F.coalesce("kept_sha", "sha"))).alias("kept_sha256"))


def drop_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars",
                  window: int = 35) -> DataFrame:
    """``docs`` with repeated windows cut out of the text (kept words joined by one space).

    Texts that lose nothing stay as they are; ``size_col``, if there, follows a changed text.
    """
    _, changed = _run(docs, id_col, text_col, window)
    lost = stored(changed.filter("removed > 0").select(F.col("key").alias("__key"), F.col("kept_text").alias("__kept")), "kept-texts")
    rows = docs.withColumn("__own_key", passages.document_key(id_col, text_col)).join(
        lost, F.col("__own_key") == F.col("__key"), "left")
    new = {text_col: F.coalesce("__kept", F.col(f"`{text_col}`")).alias(text_col)}
    if size_col and size_col in docs.columns:
        kind = docs.schema[size_col].dataType
        new[size_col] = F.when(F.col("__kept").isNotNull(), F.length("__kept").cast(kind)).otherwise(F.col(f"`{size_col}`")).alias(size_col)
    return rows.select([new.get(c, F.col(f"`{c}`")) for c in docs.columns])
