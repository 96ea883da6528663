"""One typing of source rows for every way in: CSV, JSON, Parquet, JDBC, batch or streaming.

Columns go by name, dates may carry a time of day, and a value either becomes exactly what it
says in the declared type or is a problem: numbers are never rounded, text that is no number or
date never becomes NULL. ``conform`` raises on the first problem, ``judged`` lists them per row so
that bad rows can be set aside.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparesledger.sources.schemas import SOURCE_SCHEMAS

#: Columns that a reader adds about a row: its file, and its line where that could not be parsed.
FILE, CORRUPT, PROBLEMS = "_source_file", "_corrupt_record", "_problems"
_OWN = (FILE, CORRUPT, PROBLEMS)
_PLACES = 18  # of numbers in exponent notation, and of JSON numbers, that are looked at


def declared(table: str, types: Mapping[str, str] | None = None) -> T.StructType | None:
    """The extract's declared columns, those in ``types`` with another type; None for an extract
    whose columns are not declared (all its columns stay as they are)."""
    own = {k.upper(): T.DataType.fromDDL(v) for k, v in (types or {}).items()}
    fields = SOURCE_SCHEMAS[table].fields if table in SOURCE_SCHEMAS else []
    unknown = own.keys() - {f.name.upper() for f in fields}
    if unknown:
        raise ValueError(f"extract {table} has no declared column {', '.join(sorted(unknown))}")
    return T.StructType([T.StructField(f.name, own.get(f.name.upper(), f.dataType)) for f in fields]) if fields else None


def _text_is_exact(c: Column, kept: Column, scale: int) -> Column:
    """Whether number text has no more than ``scale`` places that count, exponents included."""
    places = F.length(F.regexp_extract(c, r"\.(\d*?)0*(?:[eE]|\s*$)", 1))
    power = F.coalesce(F.regexp_extract(c, r"[eE]([+-]?\d+)", 1).try_cast("int"), F.lit(0))
    wide = c.try_cast(T.DecimalType(38, _PLACES))
    return (places - power <= scale) | ((places - power <= _PLACES) & (wide == kept.cast(T.DecimalType(38, _PLACES))))


def _doubtful(c: Column, kept: Column, found: T.DataType, want: T.DataType) -> Column:
    """A cheap test that no value fails to which ``_lost`` applies: number text without an exponent and
    with no more characters behind its point than places is taken exactly if it can be cast."""
    if isinstance(want, T.DecimalType) and isinstance(found, T.StringType):
        point = F.instr(c, ".")
        return c.isNotNull() & (kept.isNull() | c.contains("e") | c.contains("E") | ((point > 0) & (F.length(c) - point > want.scale)))
    return _lost(c, kept, found, want)


def typed(c: Column, found: T.DataType, want: T.DataType) -> tuple[Column, Column]:
    """``c`` as ``want``, and whether it says something else than that."""
    kept = c.try_cast(want) if found != want else c
    return kept, _lost(c, kept, found, want)


def _lost(c: Column, kept: Column, found: T.DataType, want: T.DataType) -> Column:
    """Whether ``c`` says something else than ``kept``, its cast to ``want``."""
    if isinstance(want, T.StringType) and found == want:
        return F.lit(False)
    lost = c.isNotNull() & kept.isNull()
    if isinstance(want, T.DecimalType) and found != want:
        if isinstance(found, T.StringType):
            lost = lost | ~_text_is_exact(c, kept, want.scale)
        elif isinstance(found, T.DecimalType) and found.scale > want.scale:
            lost = lost | (kept.try_cast(found) != c)
        elif isinstance(found, (T.DoubleType, T.FloatType)):
            lost = lost | (kept.cast(found) != c)
    return F.coalesce(lost, F.lit(False))


def _columns(df: DataFrame, table: str, types: Mapping[str, str] | None, prefix: str = ""):
    """(name, value, problem, doubt) of the declared columns in their order, then of the others; no
    row has a problem without a doubt. With ``prefix`` both take a column's value from the column of
    that prefix and its name."""
    schema = declared(table, types)
    found = {f.name.strip().upper(): f for f in df.schema.fields if f.name not in _OWN}
    fields = schema.fields if schema else []
    missing = [f.name for f in fields if f.name.upper() not in found]
    if missing:
        raise ValueError(f"extract {table} lacks the columns {', '.join(missing)}")
    for f in fields:
        source = found.pop(f.name.upper())
        c = F.col(f"`{source.name}`")
        value, lost = typed(c, source.dataType, f.dataType)
        kept = F.col(f"`{prefix}{f.name}`") if prefix else value
        if prefix:
            lost = _lost(c, kept, source.dataType, f.dataType)
        told = F.concat(F.lit(f"{f.name} does not fit {f.dataType.simpleString()}: "), c.cast("string"))
        yield f.name, value, F.when(lost, told), _doubtful(c, kept, source.dataType, f.dataType)
    for f in found.values():
        yield f.name.strip(), F.col(f"`{f.name}`"), None, None


def conform(df: DataFrame, table: str, types: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with the extract's declared columns typed, then the others as they are; a value that
    its type cannot hold exactly raises. Works on streams too."""
    out = []
    for name, value, problem, _ in _columns(df, table, types):
        if problem is not None:
            value = F.when(problem.isNotNull(), F.raise_error(problem).cast(declared(table, types)[name].dataType)).otherwise(value)
        out.append(value.alias(name))
    return df.select(out + [F.col(c) for c in df.columns if c == FILE])


def judged(df: DataFrame, table: str, types: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` typed as ``conform`` does, with its problems in an array (empty: a good row) and the
    row's source text as JSON; a line that could not be parsed is a problem as well."""
    prefix = "_typed_"  # values are cast once, in a step of their own, and then looked at
    columns = list(_columns(df, table, types, prefix))
    told = [p for _, _, p, _ in columns if p is not None]
    doubts = [d for _, _, _, d in columns if d is not None]
    cast = df.select("*", *(v.alias(prefix + n) for n, v, p, _ in columns if p is not None))
    if CORRUPT in df.columns:
        doubts.append(F.col(CORRUPT).isNotNull())
        told = [F.when(F.col(CORRUPT).isNotNull(), F.concat(F.lit("malformed line: "), F.col(CORRUPT))), *told]
    # the list is made for doubtful rows alone: its expressions are not compiled
    none = F.array().cast("array<string>")
    problems = F.when(reduce(or_, doubts), F.array_compact(F.array(*told))).otherwise(none) if told else none
    raw = F.to_json(F.struct([F.col(f"`{c}`") for c in df.columns if c not in _OWN]))
    own = [F.col(FILE)] if FILE in df.columns else []
    return cast.select([(v if p is None else F.col(f"`{prefix}{n}`")).alias(n) for n, v, p, _ in columns] + own + [problems.alias(PROBLEMS), raw.alias("_source_row")])
