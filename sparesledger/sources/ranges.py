"""Parallel reads of a database table by ranges of its key.

Each range is one predicate and one task; together they cover every key once, NULL included. The
cuts come from quantiles of the extract as it was stored by the last run, so ranges hold like
numbers of rows however the keys lie, and from an observed minimum and maximum on the first one.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Cut = int | Decimal | _dt.date | str
#: Extracts that grow with the business; they are never read by a single task.
LARGE = ("gl_je_lines", "xla_ae_headers", "xla_distribution_links", "ap_invoices_all", "ap_invoice_distributions_all",
         "mtl_material_transactions")
ROWS_PER_READ = 1_000_000


def _literal(value: Cut) -> str:
    if isinstance(value, _dt.date):
        return f"DATE '{value:%Y-%m-%d}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def range_predicates(column: str, cuts: Sequence[Cut]) -> list[str]:
    """Predicates of the ranges between ``cuts``: below the first (with the NULLs), between each two,
    from the last on. Without cuts one predicate that takes all rows."""
    cuts = sorted(set(cuts))
    if not cuts:
        return ["1 = 1"]
    at = [_literal(c) for c in cuts]
    return [f"{column} < {at[0]} OR {column} IS NULL",
            *(f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:])), f"{column} >= {at[-1]}"]


def even_cuts(low: int, high: int, ranges: int) -> list[int]:
    """Whole-number cuts of ``low`` .. ``high`` into at most ``ranges`` like-wide ranges."""
    span = high - low + 1
    return sorted({low + span * i // ranges for i in range(1, ranges)} - {low})


def quantile_cuts(stored: DataFrame, column: str, ranges: int) -> list[Cut]:
    """Cuts that part the stored rows into about like-large ranges (one aggregation, ``ranges``
    values to the driver)."""
    if ranges < 2:
        return []
    found = stored.agg(F.percentile_approx(F.col(f"`{column}`"), [i / ranges for i in range(1, ranges)], 20 * ranges)).first()[0]
    return sorted(set(found or []))


def observed_cuts(spark: SparkSession, table: str, column: str, ranges: int, options: Mapping[str, str]) -> list[int]:
    """``even_cuts`` of the least and greatest key that the database states."""
    asked = {k: v for k, v in options.items() if k.lower() not in ("dbtable", "query")}
    row = spark.read.format("jdbc").options(**asked, query=f"SELECT MIN({column}) AS low_key, MAX({column}) AS high_key FROM {table}").load().first()
    return [] if row is None or row[0] is None else even_cuts(int(row[0]), int(row[1]), ranges)


def planned_ranges(spark: SparkSession, table: str, column: str, options: Mapping[str, str], stored: DataFrame | None = None,
                   rows: int | None = None, ranges: int = 64) -> list[str]:
    """The predicates to read a table by: about ``ROWS_PER_READ`` rows each by the last run's rows and
    quantiles, else ``ranges`` even ranges of the observed keys."""
    if stored is not None and rows is not None:
        return range_predicates(column, quantile_cuts(stored, column, max(1, -(-rows // ROWS_PER_READ))))
    name = next((v for k, v in options.items() if k.lower() == "dbtable"), table)
    return range_predicates(column, observed_cuts(spark, name, column, ranges, options))
