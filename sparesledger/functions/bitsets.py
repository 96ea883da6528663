"""Exact sets over a small known domain as bit masks.

A set of plants or of statuses needs one bit a member: ``bit_or`` gathers it in a plain hash
aggregate with map-side combine, where ``collect_set`` or several distinct counts take object
buffers, sorting or an Expand of all rows. Masks merge by ``bit_or`` again, so partial results of
any kind can be put together.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = 63  # bits used of a 64-bit word; larger domains take several words


class BitSet:
    """The sets over ``members`` (all values that can occur; their order is the order of a decoded
    set), kept in the aggregate columns ``{name}_0``, ``{name}_1``, ..."""

    def __init__(self, name: str, members: Sequence):
        self.members = sorted(set(members))
        self.columns = [f"{name}_{w}" for w in range(max(1, -(-len(self.members) // WORD)))]

    def gather(self, value: Column) -> list[Column]:
        """The aggregates that gather the values of a group; NULLs are left out, and a value outside
        the domain is an error, never lost."""
        known = F.array(*map(F.lit, self.members)) if self.members else F.array().cast("array<string>")
        at = F.array_position(known, value) if self.members else F.lit(0).cast("long")
        stranger = F.raise_error(F.concat(F.lit("not in the set's domain: "), value.cast("string"))).cast("long")
        at = F.when(value.isNull(), F.lit(-1).cast("long")).when(at == 0, stranger).otherwise(at - 1)

        def bit(word: int) -> Column:
            inside = at.between(word * WORD, (word + 1) * WORD - 1)
            return F.when(inside, F.call_function("shiftleft", F.lit(1).cast("long"), (at - word * WORD).cast("int"))).otherwise(F.lit(0).cast("long"))

        return [F.bit_or(bit(w)).alias(c) for w, c in enumerate(self.columns)]

    def merge(self) -> list[Column]:
        """The aggregates that unite gathered sets."""
        return [F.bit_or(c).alias(c) for c in self.columns]

    def size(self) -> Column:
        return reduce(Column.__add__, (F.bit_count(F.coalesce(F.col(c), F.lit(0).cast("long"))) for c in self.columns)).cast("long")

    def has(self, member) -> Column:
        w, bit = divmod(self.members.index(member), WORD)
        return F.coalesce(F.col(self.columns[w]), F.lit(0).cast("long")).bitwiseAND(F.lit(1 << bit).cast("long")) != 0

    def decoded(self) -> Column:
        """The members of the set as an array, in order."""
        return F.array_compact(F.array(*(F.when(self.has(m), F.lit(m)) for m in self.members)))
