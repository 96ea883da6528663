"""SQL access to the layers.

``register_views`` exposes a lazy model under the table names alone, as temp views. Over a
published catalog (``register_layer``), ``register_sql`` adds the secured view, which the reference's
SQL calls by two-part name, and table functions that take the persona or the grouping as an
argument. Spark's parser takes no database before a table function's name, so these belong to the
session. Their bodies are SQL, inlined into the calling query, so a constant persona becomes a plant
filter that reaches the scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import SparkSession

from sparesledger.functions.aging import DEAD_STOCK, NON_MOVING_STATUSES
from sparesledger.operators.reports import MEASURES, SYNONYMS
from sparesledger.operators.security import BOARD, PLANT_PERSONAS, secured_view
from sparesledger.plans.model import Model
from sparesledger.sources.schemas import SOURCE_TABLES


def register_views(spark: SparkSession, model: Model, persona: str = BOARD) -> list[str]:
    """Temp views for the bronze extracts, silver, gold and the persona's secured view."""
    names = []
    bronze = model.sources(SOURCE_TABLES)
    for name, df in {**bronze, **model.silver_tables(), **model.gold_tables()}.items():
        df.createOrReplaceTempView(name)
        names.append(name)
    secured_view(model.stores_aging, persona).createOrReplaceTempView("vw_stores_aging_secured")
    names.append("vw_stores_aging_secured")
    return names


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _choice(argument: str, columns: dict[str, str], of: str) -> str:
    """The column that ``argument`` names; an unknown name is an error."""
    whens = " ".join(f"WHEN {text(word)} THEN {column}" for word, column in columns.items())
    return f"CASE lower({argument}) {whens} ELSE raise_error(concat('unknown {of}: ', {argument})) END"


def register_sql(spark: SparkSession, prefix: str = "", persona: str = BOARD, plants: Sequence[str] = PLANT_PERSONAS) -> list[str]:
    """Create, over the registered ``{prefix}gold.agg_stores_aging``:

    * view ``{prefix}gold.vw_stores_aging_secured``: the rows that ``persona`` sees;
    * table function ``stores_aging_secured(persona)``: BOARD sees all rows, a plant its own,
      anyone else none;
    * table function ``visibility_check(persona)``: who is asking, plants, rows and value visible;
    * table function ``stock_summary(dimension, measure, status)``: value in millions and lines by
      one dimension, with the synonyms of ``reports.SYNONYMS``; ``status`` is ``all``,
      ``dead stock`` or ``non-moving``.

    The functions' names have the prefix as well. Returns all names.
    """
    if prefix and not re.fullmatch(r"\w+", prefix):
        raise ValueError(f"not a name prefix: {prefix!r}")
    gold = f"{prefix}gold"
    listed = ", ".join(map(text, plants))

    def seen_by(who: str) -> str:
        return (f"SELECT * FROM {gold}.agg_stores_aging WHERE CASE WHEN {who} = {text(BOARD)} THEN TRUE "
                f"WHEN {who} IN ({listed}) THEN org_code = {who} ELSE FALSE END")

    spark.sql(f"CREATE OR REPLACE VIEW {gold}.vw_stores_aging_secured AS {seen_by(text(persona))}")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}stores_aging_secured(persona STRING COMMENT 'BOARD, a plant code, or anyone else')
        RETURNS TABLE RETURN {seen_by(f'{prefix}stores_aging_secured.persona')}""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}visibility_check(persona STRING)
        RETURNS TABLE (running_as STRING, orgs_visible BIGINT, rows_visible BIGINT, value_visible_pkr_mn DECIMAL(30,1)) RETURN
        SELECT {prefix}visibility_check.persona, plants, n, value
        FROM (SELECT count(DISTINCT org_code) AS plants, count(*) AS n, round(cast(sum(onhand_value_avg_cost) AS DECIMAL(30,2)) * 0.000001BD, 1) AS value
              FROM {prefix}stores_aging_secured({prefix}visibility_check.persona))""")
    values = {word: column for word, column in SYNONYMS.items() if column in MEASURES} | {m: m for m in MEASURES}
    groups = {word: column for word, column in SYNONYMS.items() if column not in MEASURES and not column.startswith("days_")}
    groups |= {column: column for column in groups.values()}
    moving = ", ".join(map(text, NON_MOVING_STATUSES))
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {prefix}stock_summary(dimension STRING DEFAULT 'plant', measure STRING DEFAULT 'value', status STRING DEFAULT 'all')
        RETURNS TABLE (dimension STRING, value_pkr_mn DECIMAL(30,1), item_lines BIGINT) RETURN
        SELECT shown, round(cast(sum(amount) AS DECIMAL(30,2)) * 0.000001BD, 1), count(*)
        FROM (SELECT {_choice(f'{prefix}stock_summary.dimension', groups, 'dimension')} AS shown, {_choice(f'{prefix}stock_summary.measure', values, 'measure')} AS amount
              FROM {gold}.agg_stores_aging
              WHERE CASE lower({prefix}stock_summary.status) WHEN 'all' THEN TRUE WHEN 'dead stock' THEN movement_status = {text(DEAD_STOCK)}
                         WHEN 'non-moving' THEN movement_status IN ({moving}) ELSE raise_error(concat('unknown status: ', {prefix}stock_summary.status)) END)
        GROUP BY shown""")
    return [f"{gold}.vw_stores_aging_secured", *(prefix + n for n in ("stores_aging_secured", "visibility_check", "stock_summary"))]
