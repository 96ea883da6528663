"""Side-by-side check of a registered query against its DuckDB oracle SQL.

Both results are fetched as pandas frames, columns sorted by name, every value turned
into a canonical string (NULL/NaN alike), and the row multisets compared. Used by the
tests and by ``scripts/check_oracle.py``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    try:
        import pandas as pd

        if v is pd.NaT or v is pd.NA:
            return "NULL"
    except ImportError:  # pragma: no cover
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v) and abs(v) < 1e15:
            return repr(float(int(v)))
        return repr(v)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _canon(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return repr(float(v)) if abs(v) < 2**53 else str(v)
    return str(v)


def canonical_rows(pdf) -> tuple[list[str], list[tuple[str, ...]]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_canon(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return cols, sorted(rows)


@dataclass
class Result:
    name: str
    spark_rows: int
    oracle_rows: int
    columns_match: bool
    values_match: bool
    detail: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return self.columns_match and self.values_match and self.spark_rows == self.oracle_rows


def compare(spark, name: str, query, sql: str, sf_dir: str, con=None, max_detail: int = 5) -> Result:
    con = con or duckdb_connection(sf_dir)
    s_pdf = query(spark, sf_dir).toPandas()
    o_pdf = con.execute(sql).df()
    s_cols, s_rows = canonical_rows(s_pdf)
    o_cols, o_rows = canonical_rows(o_pdf)
    res = Result(name, len(s_rows), len(o_rows), s_cols == o_cols, s_rows == o_rows)
    if not res.columns_match:
        res.detail.append(f"columns spark-only={sorted(set(s_cols) - set(o_cols))} "
                          f"oracle-only={sorted(set(o_cols) - set(s_cols))}")
    elif not res.values_match:
        s_only = sorted(set(s_rows) - set(o_rows))[:max_detail]
        o_only = sorted(set(o_rows) - set(s_rows))[:max_detail]
        for a, b in zip(s_only, o_only):
            diffs = [f"{c}: spark={x} oracle={y}" for c, x, y in zip(s_cols, a, b) if x != y]
            res.detail.append("; ".join(diffs))
        if not s_only and not o_only:
            res.detail.append("same distinct rows, different multiplicities")
    return res
