"""Plant-level row visibility.

The persona is a Python argument, so the predicate is built before planning: BOARD adds
no filter, a known plant persona becomes ``org_code = '<plant>'`` (pushed down to the
scan of a stored gold table), and anything else becomes ``FALSE``, which Catalyst folds
into an empty relation -- unknown personas fail closed. This is a query-time filter, not
enforced security; enforcement belongs to the catalog's row filters.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparesledger.functions.money import in_millions

BOARD = "BOARD"
# The plant personas the reference knows.
PLANT_PERSONAS: tuple[str, ...] = ("GCI", "WCI", "GCM")


def persona_predicate(persona: str, plants: Sequence[str] = PLANT_PERSONAS, column: str = "org_code"):
    if persona == BOARD:
        return F.lit(True)
    if persona in plants:
        return F.col(column) == persona
    return F.lit(False)


def secured_view(gold: DataFrame, persona: str, plants: Sequence[str] = PLANT_PERSONAS) -> DataFrame:
    """Rows of ``gold`` visible to ``persona``: BOARD all, a plant its own, others none."""
    return gold.filter(persona_predicate(persona, plants))


def secured_view_sql(spark: SparkSession, table: str, persona: str,
                     plants: Sequence[str] = PLANT_PERSONAS) -> DataFrame:
    """The secured view in SQL, with the persona bound as a named parameter.

    The persona and the plant list are parameter markers, never text spliced into the
    statement, so their values cannot change the SQL; they bind as literals, and Catalyst folds
    the CASE just as it folds ``secured_view``'s Python-built predicate. ``table`` is a
    catalog or temp-view name (a dotted identifier).
    """
    part = r"(`[^`]+`|[A-Za-z0-9_]+)"
    if not re.fullmatch(rf"{part}(\.{part})*", table):
        raise ValueError(f"not a table identifier: {table!r}")
    return spark.sql(
        f"""SELECT * FROM {table}
            WHERE CASE WHEN :persona = 'BOARD' THEN TRUE
                       WHEN array_contains(CAST(:plants AS ARRAY<STRING>), :persona) THEN org_code = :persona
                       ELSE FALSE END""",
        args={"persona": persona, "plants": list(plants)},
    )


def visibility_check(gold: DataFrame, persona: str, plants: Sequence[str] = PLANT_PERSONAS) -> DataFrame:
    """One row: who is asking, plants visible, rows visible, value visible (millions)."""
    return secured_view(gold, persona, plants).agg(
        F.lit(persona).alias("running_as"),
        F.count_distinct("org_code").alias("orgs_visible"),
        F.count("*").alias("rows_visible"),
        in_millions(F.sum("onhand_value_avg_cost"), 1).alias("value_visible_pkr_mn"),
    )


def row_filter_by_map(gold: DataFrame, security_map: DataFrame, user: str) -> DataFrame:
    """Rows of plants granted to ``user`` in an entitlement table (user, plant).

    A semi join never duplicates gold rows, even with repeated grants. The grants are
    reduced to one row per plant; the join strategy is left to their measured size.
    """
    grants = security_map.filter(F.col("USER_NAME") == user).select(
        F.col("ORG_CODE").alias("org_code")).distinct()
    return gold.join(grants, "org_code", "left_semi")
