"""Suffix-array dedup over bytes.

``passages`` finds the stretches of text around repeated 32-byte anchors that extend to
repeated 64-byte grams; stretches alike as a whole are settled by counting. The stretches that
share a gram but differ go to shards of a few MB, all of one gram to one shard. Each shard
sorts its suffixes by Larsson-Sadakane refinement, takes common prefixes by Kasai's relation,
and keeps the first of equal 100-byte strings. A gram with very many different stretches is
dealt over several shards; what each of them kept is then merged in byte order, where the range
partitioner finds a string's place by binary search among the shards' sampled bounds.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages
from .common import U64, as_bytes, fmix64, stored

#: A 64-bit hash for each byte value.
_BYTES = fmix64(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _units(text: bytes) -> np.ndarray:
    return _BYTES[np.frombuffer(text, dtype=np.uint8)]


def _whole(text: bytes) -> tuple[int, bytes]:
    return len(text), text


def shape(length: int) -> passages.Shape:
    gram = max(1, (length // 3) & ~3 or length // 3)
    return passages.Shape(length, gram, min(2 * gram, (length + gram + 1) // 2))


def _words8(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one big-endian number (zeros past the end)."""
    wide = np.r_[data, np.zeros(8, dtype=np.uint8)].astype(U64)
    key = np.zeros(len(data), dtype=U64)
    for j in range(8):
        key = (key << U64(8)) | wide[j:j + len(data)]
    return key


def suffix_array(data: np.ndarray, depth: int) -> np.ndarray:
    """Suffix positions in the order of their first ``depth`` bytes (at least), by
    Larsson-Sadakane: only groups not yet told apart are sorted again, by the ranks of the
    suffixes that start as many bytes later as are sorted so far."""
    n, h = len(data), 8
    key = _words8(data)
    sa = np.argsort(key, kind="stable")
    new = np.r_[True, key[sa[1:]] != key[sa[:-1]]] if n else np.zeros(0, dtype=bool)
    rank = np.zeros(n + 1, dtype=np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0)) + 1  # 0: past the end
    while h < depth and not new.all():
        at = np.flatnonzero(~(new & np.r_[new[1:], True]))
        sub = sa[at]
        pair = (rank[sub] << 32) | rank[np.minimum(sub + h, n)]
        order = np.argsort(pair, kind="stable")
        sub, pair = sub[order], pair[order]
        sa[at] = sub
        first = np.r_[True, pair[1:] != pair[:-1]]
        new[at] = first
        rank[sub] = np.maximum.accumulate(np.where(first, at, 0)) + 1
        h *= 2
    return sa


def common_prefixes(data: np.ndarray, sa: np.ndarray, starts: np.ndarray, cap: int) -> np.ndarray:
    """For each place in ``sa``, the common prefix with the suffix before it (up to ``cap``).

    Kasai's relation in text order: where the neighbours of a suffix and of the one that
    starts a byte earlier correspond, its prefix is one less. Only the others, and each of
    ``starts`` (so that the cap can't run on), are compared, eight bytes at a time.
    """
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    before = np.full(n, -1, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    own = np.arange(n)
    follows = np.zeros(n, dtype=bool)
    follows[1:] = (before[1:] > 0) & (before[:-1] == before[1:] - 1) & (data[:-1] == data[np.maximum(before[1:] - 1, 0)])
    follows[starts] = False
    at = np.flatnonzero(~follows & (before >= 0))
    size = np.zeros(n, dtype=np.int64)
    key = np.r_[_words8(data), np.zeros(cap + 8, dtype=U64)]
    alive = at
    for step in range(0, cap, 8):
        if not len(alive):
            break
        a, b = alive, before[alive]
        inside = np.minimum(n - a, n - b) - step
        differ = key[a + step] ^ key[b + step]
        # leading equal bytes of the eight
        equal = np.zeros(len(alive), dtype=np.int64)
        open_ = np.ones(len(alive), dtype=bool)
        for j in range(8):
            open_ &= ((differ >> U64(56 - 8 * j)) & U64(0xFF)) == 0
            equal += open_
        equal = np.clip(np.minimum(equal, inside), 0, 8)
        size[alive] += equal
        alive = alive[equal == 8]
    last = np.maximum.accumulate(np.where(follows, 0, own))
    size = np.where(follows, np.maximum(size[last] - (own - last), 0), size)
    return size[sa]


def _shard(table: pa.Table, length: int) -> pa.Table:
    """Rows (win, id, key, lo, hi) of one shard's stretches: starts that go have win null; of a
    dealt gram also each string kept (lo = hi), for the merge."""
    order = pc.sort_indices(table, [("id", "ascending"), ("key", "ascending"), ("lo", "ascending")], null_placement="at_start")
    table = table.take(order)
    parts = as_bytes(table["part"].combine_chunks())
    lo, dealt = table["lo"].to_numpy().astype(np.int64), table["dealt"].to_numpy(zero_copy_only=False)
    sizes = np.array([len(p) for p in parts])
    # 0xFF stands in no UTF-8 text
    data = np.frombuffer(b"\xff".join(parts) + b"\xff", dtype=np.uint8)
    begin = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    sa = suffix_array(data, length)
    prefix = common_prefixes(data, sa, begin, int(sizes.max()) + 8)
    group = np.empty(len(data), dtype=np.int64)
    group[sa] = np.cumsum(prefix < length)
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    inside = np.arange(len(data)) - begin[owner]
    at = np.flatnonzero(inside + length <= sizes[owner])
    by = np.lexsort((at, group[at]))
    again = np.zeros(len(at), dtype=bool)
    again[by[1:]] = group[at[by[1:]]] == group[at[by[:-1]]]
    gone = at[again]
    run = np.r_[True, (gone[1:] != gone[:-1] + 1) | (owner[gone[1:]] != owner[gone[:-1]])] if len(gone) else np.zeros(0, bool)
    first = np.flatnonzero(run)
    last = np.r_[first[1:], len(gone)] - 1
    a, b = (gone[first], gone[last]) if len(gone) else (gone, gone)
    stay = at[~again & dealt[owner[at]]]
    win = [None] * len(a) + [bytes(data[i:i + length]) for i in stay.tolist()]
    a, b = np.r_[a, stay], np.r_[b, stay]
    who = pa.array(owner[a])
    return pa.table([pa.array(win, pa.binary()), table["id"].combine_chunks().take(who), table["key"].combine_chunks().take(who),
                     pa.array((lo[owner[a]] + inside[a]).astype(np.int32)), pa.array((lo[owner[b]] + inside[b]).astype(np.int32))],
                    ["win", "id", "key", "lo", "hi"])


def _parts(batches, length: int):
    for batch in batches:
        for i, text in enumerate(as_bytes(batch.column(2))):
            ranges = batch.column(3)[i].values
            lo, hi = (ranges.field(f).to_numpy().astype(np.int64) for f in ("lo", "hi"))
            same = pa.array(np.full(len(lo), i))
            yield pa.RecordBatch.from_arrays(
                [ranges.field("g"), ranges.field("salt"), batch.column(0).take(same), batch.column(1).take(same), ranges.field("lo"),
                 pa.array([text[a:b + length] for a, b in zip(lo.tolist(), hi.tolist())], pa.binary())],
                ["g", "salt", "id", "key", "lo", "part"])


def _merge(batches):
    """Sorted rows: all but the first of each string go."""
    last = None
    for batch in batches:
        win = batch.column(0).to_pylist()
        again = [w == (win[i - 1] if i else last) for i, w in enumerate(win)]
        last = win[-1] if win else last
        rest = batch.filter(pa.array(again, pa.bool_()))
        yield pa.RecordBatch.from_arrays([rest.column(1), rest.column(2), rest.column(3), rest.column(3)], ["id", "key", "lo", "hi"])


def _cut(batches, length: int):
    for batch in batches:
        removed, spans, kept = [], [], []
        for i, text in enumerate(as_bytes(batch.column(2))):
            ranges = batch.column(3)[i].values
            gone = passages.covered(len(text), ranges.field("lo").to_numpy(), ranges.field("hi").to_numpy() + length)
            removed.append(int(gone.sum()))
            spans.append(int((gone & ~np.r_[False, gone[:-1]]).sum()))
            kept.append(hashlib.sha256(np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["id", "key", "removed", "spans", "kept_sha"])


def repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100,
                   shard_bytes: int = 4 << 20) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes when a string of ``length`` bytes that covers it also starts earlier: in a
    document of smaller id (null is the smallest; of equal ids, of smaller key) or earlier
    in the same one. Null or short texts lose nothing; rows that repeat both id and text are one
    document; an empty table gives an empty result.
    """
    levels = shape(length)
    id_type = docs.schema[id_col].dataType.simpleString()
    found = passages.survey(docs, id_col, text_col, _units, levels, _whole)
    texts = passages.suspects(docs, id_col, text_col, found)
    rows = passages.extended(texts, _units, levels)
    groups, open_ = passages.contexts(rows)
    later = rows.join(groups.filter("k > 1").select("g", "c", "first"), ["g", "c"]).filter(
        ~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key")) & (F.col("lo") == F.col("first.lo")))
    ).select("id", "key", "lo", "hi")
    # stretches of a gram that fill more than half a shard are dealt over several
    each = max(1, shard_bytes // (4 * length))
    counts = groups.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    dealt = open_.join(counts, "g").select(
        "g", "first.*", F.when(F.col("n") > each, F.pmod(F.xxhash64("c"), F.ceil(F.col("n") / each))).alias("salt"))
    parts = stored(passages.by_text(dealt.select("g", "salt", "id", "key", "lo", "hi"), texts).mapInArrow(
        lambda b: _parts(b, length), f"g long, salt long, id {id_type}, key long, lo int, part binary"), "stretches")
    total = parts.agg(F.sum(F.octet_length("part"))).first()[0] or 0
    shards = max(1, -(-total // (shard_bytes // 2)))
    sharded = parts.select(F.pmod(F.xxhash64("g", "salt"), F.lit(shards)).alias("shard"), "id", "key", "lo", "part",
                           F.col("salt").isNotNull().alias("dealt"))
    out = stored(sharded.groupBy("shard").applyInArrow(
        lambda t: _shard(t, length), f"win binary, id {id_type}, key long, lo int, hi int"), "shards")
    merged = (out.filter("win IS NOT NULL").repartitionByRange("win").sortWithinPartitions("win", "id", "key", "lo")
              .mapInArrow(_merge, f"id {id_type}, key long, lo int, hi int"))
    ranges = later.unionByName(out.filter("win IS NULL").drop("win")).unionByName(merged)
    changed = passages.by_text(ranges, texts).mapInArrow(
        lambda b: _cut(b, length), f"id {id_type}, key long, removed long, spans long, kept_sha binary")
    done = passages.outcome(found, changed)
    return done.select(F.col("id").alias(id_col), F.col("n").alias("n_bytes"),
                       F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
                       F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"),
                       F.lower(F.hex(F.coalesce("kept_sha", "sha"))).alias("kept_sha256"))
