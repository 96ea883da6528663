"""Lazy wiring of bronze -> silver -> gold.

A ``Model`` takes source extracts (the fixtures, bronze tables on storage, or any mapping
of DataFrames) and exposes every silver and gold table as a cached property. Nothing runs
until an action, but for reading the few plants that gold numbers; each report is one Catalyst plan from the sources (or from stored
layers, when the model is built over a written warehouse).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sparesledger.functions.aging import DEFAULT_EDGES
from sparesledger.operators import aging, recon, silver
from sparesledger.sources.fixtures import Fixtures

FIXTURE_AS_OF = _dt.date(2025, 12, 31)  # as-of date of the fixture mapping (FIXTURES.md)


class Model:
    def __init__(
        self,
        sources: Mapping[str, DataFrame] | Fixtures,
        as_of=None,
        edges: Sequence[int] = DEFAULT_EDGES,
        silver_tables: Mapping[str, DataFrame] | None = None,
        gold_tables: Mapping[str, DataFrame] | None = None,
        **aging_options,
    ):
        if as_of is None and isinstance(sources, Fixtures):
            as_of = FIXTURE_AS_OF
        self._sources = sources
        self._silver = dict(silver_tables or {})
        self._gold = dict(gold_tables or {})
        self.as_of = as_of
        self.edges = tuple(edges)
        self.aging_options = aging_options

    # -- constructors -----------------------------------------------------------------------

    @classmethod
    def from_fixtures(cls, spark: SparkSession, sf_dir: str, **kw) -> "Model":
        return cls(Fixtures(spark, sf_dir), **kw)

    @classmethod
    def from_warehouse(cls, spark: SparkSession, root: str, read_gold: bool = True, **kw) -> "Model":
        """Read bronze, silver and gold parquet tables written by ``run_pipeline``.

        Stored gold carries the as-of date and options of the run that wrote it; pass
        ``read_gold=False`` to recompute gold from the stored silver with this model's
        ``as_of`` and options instead.
        """
        from sparesledger.plans.pipeline import read_layers

        bronze, silver_t, gold_t = read_layers(spark, root, read_gold=read_gold)
        return cls(bronze, silver_tables=silver_t, gold_tables=gold_t, **kw)

    @classmethod
    def from_catalog(cls, spark: SparkSession, prefix: str = "", read_gold: bool = True, **kw) -> "Model":
        """Read the tables that ``run_pipeline(..., catalog_prefix=prefix)`` registered, by name; tables
        stored in buckets keep them, so joins on their key need no shuffle."""
        def tables(layer: str) -> dict[str, DataFrame]:
            database = f"{prefix}{layer}"
            if not spark.catalog.databaseExists(database):
                return {}
            return {t.name: spark.table(f"{database}.{t.name}") for t in spark.catalog.listTables(database) if t.tableType not in ("TEMPORARY", "VIEW")}

        bronze = {t: df.drop("_ingest_ts", "_source_system") for t, df in tables("bronze").items()}
        return cls(bronze, silver_tables=tables("silver"), gold_tables=tables("gold") if read_gold else {}, **kw)

    # -- sources ---------------------------------------------------------------------------

    def source(self, name: str) -> DataFrame:
        if isinstance(self._sources, Fixtures):
            return self._sources.table(name)
        return self._sources[name]

    def has_source(self, name: str) -> bool:
        return hasattr(type(self._sources), name) if isinstance(self._sources, Fixtures) else name in self._sources

    def sources(self, names: Sequence[str], optional: Sequence[str] = ()) -> dict[str, DataFrame]:
        """The extracts ``names``; ``KeyError`` if one that is not ``optional`` is absent."""
        missing = [n for n in names if n not in optional and not self.has_source(n)]
        if missing:
            raise KeyError(f"extracts not there: {', '.join(missing)}")
        return {n: self.source(n) for n in names if self.has_source(n)}

    def stored(self, folder: str) -> "Model":
        """This model over extracts whose common steps are written below ``folder`` once (fixtures; other
        extracts are stored already). Its layers are made anew."""
        sources = self._sources.stored(folder) if isinstance(self._sources, Fixtures) else self._sources
        return Model(sources, as_of=self.as_of, edges=self.edges, **self.aging_options)

    # -- silver ------------------------------------------------------------------------------

    def _s(self, name: str, build) -> DataFrame:
        if name not in self._silver:
            self._silver[name] = build()
        return self._silver[name]

    @property
    def dim_account(self) -> DataFrame:
        return self._s("dim_account", lambda: silver.dim_account(self.source("gl_code_combinations")))

    @property
    def dim_organization(self) -> DataFrame:
        return self._s("dim_organization", lambda: silver.dim_organization(self.source("hr_operating_units")))

    @property
    def dim_item(self) -> DataFrame:
        return self._s("dim_item", lambda: silver.dim_item(self.source("mtl_system_items_b"), self.dim_organization))

    @property
    def fact_material_txn(self) -> DataFrame:
        return self._s("fact_material_txn", lambda: silver.fact_material_txn(self.source("mtl_material_transactions")))

    @property
    def fact_ap_distribution(self) -> DataFrame:
        return self._s("fact_ap_distribution", lambda: silver.fact_ap_distribution(
            self.source("ap_invoice_distributions_all"), self.source("ap_invoices_all"), self.source("ap_suppliers")))

    @property
    def fact_gl_line(self) -> DataFrame:
        return self._s("fact_gl_line", lambda: silver.fact_gl_line(self.source("gl_je_lines"), self.source("gl_je_headers")))

    @property
    def bridge_sla_gl(self) -> DataFrame:
        return self._s("bridge_sla_gl", lambda: silver.bridge_sla_gl(
            self.source("xla_distribution_links"), self.source("xla_ae_headers")))

    def silver_tables(self) -> dict[str, DataFrame]:
        return {t: getattr(self, t) for t in silver.SILVER_TABLES}

    @cached_property
    def plants(self) -> aging.Plants | None:
        """All plants, read once from their dimension (one row per operating unit)."""
        return aging.known_plants(self.dim_organization)

    @property
    def plant_codes(self) -> tuple[str, ...] | None:
        return self.plants and self.plants.codes

    # -- gold --------------------------------------------------------------------------------

    def _g(self, name: str, build) -> DataFrame:
        if name not in self._gold:
            self._gold[name] = build()
        return self._gold[name]

    @property
    def stores_aging(self) -> DataFrame:
        return self._g("agg_stores_aging", lambda: aging.stores_aging(
            self.dim_item,
            self.source("mtl_onhand_quantities_detail"),
            self.source("cst_item_costs"),
            self.fact_material_txn,
            as_of=self.as_of,
            edges=self.edges,
            **{"plants": self.plants, **self.aging_options},
        ))

    @property
    def recon_ap_to_gl(self) -> DataFrame:
        return self._g("recon_ap_to_gl", lambda: recon.recon_ap_to_gl(
            self.fact_ap_distribution, self.dim_organization, self.bridge_sla_gl, self.fact_gl_line, self.dim_account))

    def gold_tables(self) -> dict[str, DataFrame]:
        return {"agg_stores_aging": self.stores_aging, "recon_ap_to_gl": self.recon_ap_to_gl}
