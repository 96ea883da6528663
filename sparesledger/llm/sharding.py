"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in Spark's functions only.

The key's 64-bit state runs through a linear congruential generator; each step jumps to the
next shard count at which the key would move. Going from ``n`` to ``n + 1`` shards moves only
the keys that land in the new shard, and no table of ring points is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import gapless_rank, stored

MULTIPLIER = 2862933555777941757  # fixed value of the published algorithm
_LOW32 = 0xFFFFFFFF


def _lcg(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2**64, as 32-bit halves in longs that never overflow."""
    m = [F.lit((MULTIPLIER >> (16 * i)) & 0xFFFF).cast("long") for i in range(4)]
    cross = lo * m[1]
    low = lo * m[0] + F.shiftleft(cross.bitwiseAND(0xFFFF), 16) + 1
    high = (F.shiftright(low, 32) + F.shiftright(cross, 16) + lo * m[2]
            + F.shiftleft((lo * m[3]).bitwiseAND(0xFFFF), 16)
            + hi * m[0] + F.shiftleft((hi * m[1]).bitwiseAND(0xFFFF), 16))
    return high.bitwiseAND(_LOW32), low.bitwiseAND(_LOW32)


def _run(key: Column, shards: int, steps: int) -> Column:
    long = lambda x: F.lit(x).cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(_LOW32).alias("lo"),
                     long(0).alias("b"), long(0).alias("j"))

    def step(s, _):
        hi, lo = _lcg(s["hi"], s["lo"])
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(hi, 1) + 1).cast("double")))
        return F.when(s["j"] < shards, F.struct(hi.alias("hi"), lo.alias("lo"), s["j"].alias("b"),
                                                jump.cast("long").alias("j"))).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)


def jump_hash(key: Column, shards: int) -> Column:
    """Shard 0 .. ``shards - 1`` of a 64-bit key.

    A key makes about ln(shards) jumps; the loop has room for 64, and a key that needs more
    (none is ever likely to) runs again with room for ``shards`` jumps, which always suffices.
    """
    if shards <= 64:
        return _run(key, shards, shards)["b"].cast("int")
    short = _run(key, shards, 64)
    return F.when(short["j"] >= shards, short["b"]).otherwise(_run(key, shards, shards)["b"]).cast("int")


def shard_rows(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    The id alone decides the shard; null ids share one shard. ``grown_shard`` is the shard with
    one more in place. Slots are 0, 1, 2, ... within each shard (by hash bucket, id, size, CRC);
    repeated rows get slots of their own. A null text has size 16 and CRC 0. An empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    key = F.xxhash64(F.col(f"`{id_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), (F.octet_length(text) + 16).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), jump_hash(key, shards).alias("shard"),
                       jump_hash(key, shards + 1).alias("grown_shard"))
    rows = stored(rows, "shards")
    placed = gapless_rank(rows, "shard", ["id", "size", "text_crc32"], "slot", rows.count())
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         "grown_shard")
