"""Exact decimal arithmetic for money, ratios and figures in millions.

Spark cuts the scale of a decimal product or quotient once its precision passes 38, and a later
``round`` then rounds a second time. Products here are sized from their operands' types so that
nothing is cut; quotients are whole-number divisions with a remainder (``a - a % b`` divides
without a rest), so ``round(num / den, n)`` is HALF_UP of the true quotient whatever the types.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, IntegerType, LongType, ShortType,
)

from sparesledger.sources.schemas import MONEY

WIDEST = 38
_WHOLE = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}


def to_money(c: Column) -> Column:
    return c.cast(MONEY)


def decimal_type(df: DataFrame, name: str) -> DecimalType:
    """The decimal type of a money or quantity column, as its source declared it."""
    kind = df.schema[name].dataType
    if isinstance(kind, DecimalType):
        return kind
    if type(kind) in _WHOLE:
        return DecimalType(_WHOLE[type(kind)], 0)
    raise TypeError(f"{name} is {kind.simpleString()}: amounts and quantities must be exact numbers")


def sum_type(kind: DecimalType) -> DecimalType:
    """The type Spark gives a sum of ``kind``."""
    return DecimalType(min(WIDEST, kind.precision + 10), kind.scale)


def difference_type(a: DecimalType, b: DecimalType) -> DecimalType:
    scale = max(a.scale, b.scale)
    return DecimalType(min(WIDEST, max(a.precision - a.scale, b.precision - b.scale) + scale + 1), scale)


def fit(c: Column, whole: int, scale: int) -> Column:
    """``c`` (of at most ``scale`` places) with ``whole`` digits before the point; a larger value
    is an error, never NULL and never rounded."""
    kind = DecimalType(min(WIDEST, whole + scale), scale)
    kept = c.try_cast(kind)
    wide = F.concat(F.lit(f"more than {whole} digits before the point: "), c.cast("string"))
    return F.when(c.isNull() | kept.isNotNull(), kept).otherwise(F.raise_error(wide).cast(kind))


def product(a: Column, a_type: DecimalType, b: Column, b_type: DecimalType) -> tuple[Column, DecimalType]:
    """``a * b`` with all its places, and its type; the wider operand gives way (see ``fit``) where
    the type's 38 digits would not hold every product."""
    whole = [t.precision - t.scale for t in (a_type, b_type)]
    room = WIDEST - 1 - a_type.scale - b_type.scale
    if room < 2:
        raise ValueError(f"a product of {a_type.simpleString()} and {b_type.simpleString()} has too many places")
    if sum(whole) > room:
        less = min(*whole, room // 2)
        whole = [room - less, less] if whole[0] >= whole[1] else [less, room - less]
    kinds = [DecimalType(w + t.scale, t.scale) for w, t in zip(whole, (a_type, b_type))]
    cells = [c if k == t else fit(c, w, t.scale) for c, k, t, w in zip((a, b), kinds, (a_type, b_type), whole)]
    return (cells[0].cast(kinds[0]) * cells[1].cast(kinds[1]),
            DecimalType(kinds[0].precision + kinds[1].precision + 1, a_type.scale + b_type.scale))


def quotient(num: Column, num_type: DecimalType, den: Column, den_type: DecimalType, digits: int) -> Column:
    """``round(num / den, digits)``, HALF_UP of the true quotient; NULL where ``den`` is 0 or NULL."""
    d = den.cast(den_type)
    d = F.when(d != 0, d)
    scale = max(num_type.scale, den_type.scale)
    room = min(WIDEST - 2 - num_type.scale, WIDEST - 1 - scale) - digits
    whole = num_type.precision - num_type.scale
    n = num.cast(num_type) if whole <= room else fit(num, room, num_type.scale)
    n = n * F.lit(Decimal(10) ** digits)
    rest = n % d
    down = ((n - rest) / d).cast(DecimalType(32, 0))  # no rest is left, so the division is exact
    away = F.when((n >= 0) == (d > 0), F.lit(1)).otherwise(F.lit(-1)).cast(DecimalType(1, 0))
    near = F.when(F.abs(rest) + F.abs(rest) >= F.abs(d), down + away).otherwise(down)
    return near * F.lit(Decimal(1).scaleb(-digits)) if digits else near


def _parsed(kind: str) -> DecimalType:
    kind = DataType.fromDDL(kind)
    assert isinstance(kind, DecimalType)
    return kind


def div_round(num: Column, den: Column, digits: int, num_type: str = "decimal(20,2)",
              den_type: str = "decimal(14,2)") -> Column:
    """``quotient`` of columns whose types are given as text; NULL when ``den`` is 0 or NULL
    (``NULLIF`` semantics)."""
    return quotient(num.cast(num_type), _parsed(num_type), den, _parsed(den_type), digits)


def avg_round(c: Column, digits: int) -> Column:
    """Exactly rounded mean of a decimal column of two places (NULLs skipped, NULL on no rows)."""
    return div_round(F.sum(c), F.count(c), digits, num_type="decimal(30,2)", den_type="decimal(20,0)")


def in_millions(c: Column, digits: int) -> Column:
    """``round(c / 1e6, digits)`` of a column of two places, kept in decimal, so the rounding is exact."""
    return F.round(c.cast("decimal(30,2)") * F.lit(Decimal("0.000001")), digits)
