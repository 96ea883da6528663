"""Source-shaped extracts derived from the driver's test tables (spec: ``FIXTURES.md``).

The reference ships no data, so the ERP extracts are derived from the TPC-H-style tables:
regions become plants, parts become items, line items become material transactions and AP
distributions, orders become invoices, and the general ledger is posted from the AP totals
with a few planted differences. Everything is a lazy DataFrame plan over the parquet
files, so every query's work grows with the input.

Scale notes: only ``region`` (5 rows) and ``nation`` (25 rows) are broadcast explicitly;
they are fixed-size reference tables. ``supplier`` grows with the data, so its join to
line items is left to the optimizer (broadcast under the size threshold, else sort-merge,
with AQE splitting skewed supplier keys).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparesledger.functions.periods import period_name, shift_years
from sparesledger.functions.aging import ISSUE_TYPE, RECEIPT_TYPE
from sparesledger.session import stored
from sparesledger.sources.schemas import MONEY, SOURCE_SCHEMAS

# Fixed values of the fixture mapping (FIXTURES.md section 3).
ORG_CODES = ("GCI", "WCI", "GCM", "WCM", "HOC")  # plant code by region key 0..4
YEAR_SHIFT = 24  # dates move 1995-2001 -> 2019-2025; 24 keeps leap days
TERMS = ("NET30", "NET60", "NET90")  # by supplier key % 3
# Account suffix -> (natural account, type, enabled, description); id = region key * 10 + suffix.
ACCOUNTS = (
    (1, "1310", "A", "Y", "Stores & Spares Inventory"),
    (2, "2110", "L", "Y", "Accounts Payable - Trade"),
    (3, "5410", "E", "Y", "Repairs & Maintenance"),
    (9, "1310", "A", "N", "Stores & Spares Inventory - Closed"),
)
GL_MISSING_PERIOD = "JAN-19"  # posted to AP but left out of GL
GL_ONLY_PERIOD, GL_ONLY_AMOUNT = "DEC-25", "1234.50"  # posted to GL only
JUNE_EXTRA_DR, SEPTEMBER_EXTRA_DR = "250.00", "0.50"  # org 0: INVESTIGATE / RECONCILED with variance
DECEMBER_DISABLED_DR, INVENTORY_DR = "999.00", "777.00"  # org 0: ignored by the recon
INVENTORY_JOURNAL_SUFFIX = 90
UNLINKED_MOD, UNLINKED_REM = 1000, 17  # distributions with id % 1000 = 17 have no SLA link
SECURITY_GRANTS = (  # (user, plant); the board user is granted every plant
    ("gci_user", "GCI"), ("wci_user", "WCI"), ("gcm_user", "GCM"),
    ("dual_user", "GCI"), ("dual_user", "WCI"),
)
BOARD_USER = "board"


def _dec(v: str) -> Column:
    return F.lit(v).cast(MONEY)


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Project and cast to the declared source schema (column order and types)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in SOURCE_SCHEMAS[table].fields])


class Fixtures:
    """Lazily built source extracts over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def stored(self, folder: str) -> "Fixtures":
        """These extracts with the distributions, which six of them are made from, written below
        ``folder`` once: for a run that writes all extracts, each in a job of its own."""
        out = Fixtures(self.spark, self.sf_dir)
        out._distributions = stored(self._distributions, f"{folder.rstrip('/')}/distributions")
        return out

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in SOURCE_SCHEMAS}

    # -- plants and items -------------------------------------------------------------------

    @cached_property
    def hr_operating_units(self) -> DataFrame:
        r = self._read("region")
        return _conform(
            r.select(
                F.col("r_regionkey").alias("ORG_ID"),
                F.element_at(F.array(*[F.lit(c) for c in ORG_CODES]), F.col("r_regionkey") + 1).alias("ORG_CODE"),
                F.col("r_name").alias("ORG_NAME"),
                F.lit(1).alias("LEDGER_ID"),
                F.lpad(F.col("r_regionkey").cast("string"), 3, "0").alias("PLANT_SEGMENT"),
                F.col("r_name").alias("REGION"),
            ),
            "hr_operating_units",
        )

    @cached_property
    def _item_pairs(self) -> DataFrame:
        """part x plant where ``p_partkey % 5 >= plant``: each part sits in 1-5 plants.

        Written as a bounded explode (at most 5 rows per part) plus a semi join to the
        5-row region table -- no cross join. The parts are dealt out first: a small file of them is
        one split, whose task would make and group all pairs alone.
        """
        regions = F.broadcast(self._read("region").select(F.col("r_regionkey").cast("long").alias("org_id")))
        p = self._read("part").select(
            "p_partkey", "p_name", "p_type", "p_size", "p_retailprice").repartition("p_partkey").select(
            "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("p_partkey") % 5)).alias("org_id"))
        return p.join(regions, "org_id", "left_semi")

    @cached_property
    def mtl_system_items_b(self) -> DataFrame:
        p = self._item_pairs
        return _conform(
            p.select(
                F.col("p_partkey").alias("INVENTORY_ITEM_ID"),
                F.col("org_id").alias("ORGANIZATION_ID"),
                F.concat(F.lit("ITM-"), F.col("p_partkey").cast("string")).alias("SEGMENT1"),
                F.col("p_name").alias("DESCRIPTION"),
                F.col("p_type").alias("CATEGORY_CODE"),
                F.col("p_type").alias("CATEGORY_NAME"),
                F.lit("EA").alias("PRIMARY_UOM_CODE"),
                F.col("p_size").alias("FULL_LEAD_TIME"),
            ),
            "mtl_system_items_b",
        )

    @cached_property
    def mtl_onhand_quantities_detail(self) -> DataFrame:
        p = self._item_pairs
        return _conform(
            p.filter((F.col("p_partkey") + F.col("org_id")) % 11 != 0).select(
                F.col("p_partkey").alias("INVENTORY_ITEM_ID"),
                F.col("org_id").alias("ORGANIZATION_ID"),
                (F.col("p_size") + F.col("org_id")).alias("PRIMARY_TRANSACTION_QUANTITY"),
            ),
            "mtl_onhand_quantities_detail",
        )

    @cached_property
    def cst_item_costs(self) -> DataFrame:
        p = self._item_pairs
        retail = F.col("p_retailprice").cast(MONEY)
        return _conform(
            p.select(
                F.col("p_partkey").alias("INVENTORY_ITEM_ID"),
                F.col("org_id").alias("ORGANIZATION_ID"),
                F.when(F.col("p_partkey") % 97 == 0, _dec("0")).otherwise(retail).alias("ITEM_COST"),
                F.round(retail * (F.lit(90) + F.col("p_partkey") % 41) / F.lit(100), 2).alias("LAST_PO_COST"),
            ),
            "cst_item_costs",
        )

    # -- line items with their plant --------------------------------------------------------

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items with the plant of their supplier (region of the supplier's nation).

        Line items join the plain supplier scan first, so the optimizer sizes that join from
        real file statistics (broadcast of the supplier side under the threshold, else
        sort-merge with AQE); the 25-row nation table is then broadcast explicitly. Joining
        supplier x nation first would make Spark estimate that side as the product of both
        sizes and pick line items as the build side.
        """
        li = self._read("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_returnflag", "l_shipdate",
        )
        s = self._read("supplier").select("s_suppkey", "s_nationkey")
        nation = F.broadcast(self._read("nation").select("n_nationkey", "n_regionkey"))
        return (
            li.join(s, li.l_suppkey == s.s_suppkey)
            .join(nation, F.col("s_nationkey") == nation.n_nationkey)
            .select(*li.columns, F.col("n_regionkey").cast("long").alias("org_id"))
        )

    @cached_property
    def mtl_material_transactions(self) -> DataFrame:
        li = self._lines
        issue = F.col("l_returnflag") == "R"
        qty = F.col("l_quantity").cast(MONEY)
        value = F.col("l_extendedprice").cast(MONEY)
        out = li.select(
            F.col("l_partkey").alias("INVENTORY_ITEM_ID"),
            F.col("org_id").alias("ORGANIZATION_ID"),
            F.when(issue, ISSUE_TYPE).otherwise(RECEIPT_TYPE).alias("TRANSACTION_TYPE_ID"),
            F.when(issue, "Issue to Maintenance").otherwise("PO Receipt").alias("TRANSACTION_TYPE_NAME"),
            shift_years(F.col("l_shipdate"), YEAR_SHIFT).alias("TRANSACTION_DATE"),
            F.when(issue, -qty).otherwise(qty).alias("PRIMARY_QUANTITY"),
            F.round(value / F.when(qty != 0, qty), 2).alias("ACTUAL_COST"),
            value.alias("TRANSACTION_COST_TOTAL"),
            F.col("l_suppkey").alias("VENDOR_ID"),
            F.concat(F.lit("PO-"), F.col("l_orderkey").cast("string")).alias("PO_NUMBER"),
            # no unique key in the input: full rows are distinct, so hash the full row. 64 bits
            # are unique at test scale; near 10^12 rows a few collisions are expected, which is
            # harmless because no operator uses transaction_id as a key.
            F.xxhash64(*[F.col(c) for c in li.columns]).alias("TRANSACTION_ID"),
        )
        return _conform(out, "mtl_material_transactions")

    # -- payables -----------------------------------------------------------------------------

    @cached_property
    def _distributions(self) -> DataFrame:
        """One AP distribution per (order, line number); keys repeat in the input, so aggregate.

        Lines are dealt by order first (summing before that would save nothing, as few keys repeat):
        the sums, the invoices' vendors and the join of distributions with invoices all use that
        one shuffle.
        """
        g = self._lines.repartition("l_orderkey").groupBy("l_orderkey", "l_linenumber").agg(
            F.sum(F.col("l_extendedprice").cast(MONEY)).alias("amount"),
            F.min("org_id").alias("org_id"),
            F.min("l_shipdate").alias("first_ship"),
            F.min("l_suppkey").alias("min_supp"),
        )
        acct_date = shift_years(F.col("first_ship"), YEAR_SHIFT)
        return g.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("dist_id"),
            F.col("l_orderkey").alias("invoice_id"),
            F.col("l_linenumber").cast("long").alias("line_id"),
            "org_id",
            F.col("amount").cast(MONEY).alias("amount"),
            acct_date.alias("acct_date"),
            period_name(acct_date).alias("period"),
            "min_supp",
        )

    @cached_property
    def ap_invoice_distributions_all(self) -> DataFrame:
        d = self._distributions
        return _conform(
            d.select(
                F.col("dist_id").alias("INVOICE_DISTRIBUTION_ID"),
                F.col("invoice_id").alias("INVOICE_ID"),
                F.col("line_id").alias("INVOICE_LINE_ID"),
                F.col("org_id").alias("ORG_ID"),
                F.col("amount").alias("AMOUNT"),
                (F.col("org_id") * 10 + 1).alias("DIST_CODE_COMBINATION_ID"),
                F.col("period").alias("PERIOD_NAME"),
                F.col("acct_date").alias("ACCOUNTING_DATE"),
            ),
            "ap_invoice_distributions_all",
        )

    @cached_property
    def ap_invoices_all(self) -> DataFrame:
        vendor = self._distributions.groupBy(F.col("invoice_id").alias("o_orderkey")).agg(
            F.min("min_supp").alias("VENDOR_ID")
        )
        o = self._read("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        inv_date = shift_years(F.col("o_orderdate"), YEAR_SHIFT)
        return _conform(
            o.join(vendor, "o_orderkey", "left").select(
                F.col("o_orderkey").alias("INVOICE_ID"),
                "VENDOR_ID",
                F.concat(F.lit("INV-"), F.col("o_orderkey").cast("string")).alias("INVOICE_NUM"),
                inv_date.alias("INVOICE_DATE"),
                F.date_add(inv_date, 30).alias("DUE_DATE"),
                F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("PAYMENT_STATUS_PAID_FLAG"),
            ),
            "ap_invoices_all",
        )

    @cached_property
    def ap_suppliers(self) -> DataFrame:
        s = self._read("supplier")
        return _conform(
            s.select(
                F.col("s_suppkey").alias("VENDOR_ID"),
                F.col("s_name").alias("VENDOR_NAME"),
                F.element_at(F.array(*[F.lit(t) for t in TERMS]), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("TERMS_NAME"),
            ),
            "ap_suppliers",
        )

    # -- general ledger -----------------------------------------------------------------------

    @cached_property
    def gl_code_combinations(self) -> DataFrame:
        r = self._read("region").select(F.col("r_regionkey").cast("long").alias("org"), "r_name")
        accts = F.array(*[
            F.struct(F.lit(k).alias("k"), F.lit(nat).alias("nat"), F.lit(t).alias("typ"),
                     F.lit(en).alias("en"), F.lit(desc).alias("descr"))
            for k, nat, t, en, desc in ACCOUNTS
        ])
        a = r.select("org", "r_name", F.explode(accts).alias("a"))
        seg1 = F.lit("01")
        seg2 = F.lpad(((F.col("org") + 1) * 100).cast("string"), 4, "0")
        seg3 = F.col("a.nat")
        seg4 = F.lpad(F.col("org").cast("string"), 3, "0")
        seg5 = F.lit("000")
        return _conform(
            a.select(
                (F.col("org") * 10 + F.col("a.k")).alias("CODE_COMBINATION_ID"),
                seg1.alias("SEGMENT1"), seg2.alias("SEGMENT2"), seg3.alias("SEGMENT3"),
                seg4.alias("SEGMENT4"), seg5.alias("SEGMENT5"),
                F.concat(F.lit("Stores - "), F.col("r_name")).alias("COST_CENTRE_DESC"),
                F.col("a.descr").alias("ACCOUNT_DESC"),
                F.col("a.typ").alias("ACCOUNT_TYPE"),
                F.concat_ws(".", seg1, seg2, seg3, seg4, seg5).alias("CONCATENATED_SEGMENTS"),
                F.col("a.en").alias("ENABLED_FLAG"),
            ),
            "gl_code_combinations",
        )

    @cached_property
    def _ap_by_period_org(self) -> DataFrame:
        """AP total per (period, plant): the amount the Payables journals post."""
        d = self._distributions
        return d.groupBy("period", "org_id").agg(
            F.sum("amount").cast(MONEY).alias("total"),
            F.max("acct_date").alias("acct_date"),
        ).filter(F.col("period") != GL_MISSING_PERIOD)

    @staticmethod
    def _je_id(period_date: Column, suffix: Column) -> Column:
        return (F.year(period_date) * 100 + F.month(period_date)).cast("long") * 100 + suffix

    @cached_property
    def _journal_lines(self) -> DataFrame:
        """All journal lines with their header attributes (one row per line).

        One aggregation of AP per (period, plant) plus the one GL-only journal; each row
        then explodes into its 2-6 lines (a bounded array), so the AP totals are computed
        once per plan.
        """
        ap = self._ap_by_period_org.withColumn("from_ap", F.lit(True))
        gl_only = ap.filter(F.col("org_id") == 0).select("org_id").distinct().select(
            F.lit(GL_ONLY_PERIOD).alias("period"), "org_id", _dec(GL_ONLY_AMOUNT).alias("total"),
            F.to_date(F.lit(GL_ONLY_PERIOD), "MMM-yy").alias("acct_date"), F.lit(False).alias("from_ap"),
        )
        rows = ap.unionByName(gl_only)
        month = F.month("acct_date")
        org0_ap = F.col("from_ap") & (F.col("org_id") == 0)
        payables_id = self._je_id(F.col("acct_date"), F.col("org_id"))
        inventory_id = self._je_id(F.col("acct_date"), F.lit(INVENTORY_JOURNAL_SUFFIX))
        none = F.lit(None).cast(MONEY)

        def line(je_id, num, suffix, dr, cr, source, category):
            return F.struct(
                je_id.alias("je"), F.lit(num).cast("long").alias("ln"),
                (F.col("org_id") * 10 + suffix).cast("long").alias("ccid"),
                dr.cast(MONEY).alias("dr"), cr.cast(MONEY).alias("cr"),
                F.lit(source).alias("src"), F.lit(category).alias("cat"),
            )

        pay, cat = "Payables", "Purchase Invoices"
        lines = F.array(
            line(payables_id, 1, 1, F.col("total"), none, pay, cat),
            line(payables_id, 2, 2, none, F.col("total"), pay, cat),
            F.when(org0_ap & (month == 6), line(payables_id, 3, 1, _dec(JUNE_EXTRA_DR), none, pay, cat)),
            F.when(org0_ap & (month == 9), line(payables_id, 3, 1, _dec(SEPTEMBER_EXTRA_DR), none, pay, cat)),
            F.when(org0_ap & (month == 12), line(payables_id, 4, 9, _dec(DECEMBER_DISABLED_DR), none, pay, cat)),
            F.when(org0_ap, line(inventory_id, 1, 1, _dec(INVENTORY_DR), none, "Inventory", "Inventory")),
        )
        exploded = rows.select(
            "period", "org_id", "acct_date", F.explode(F.filter(lines, lambda x: x.isNotNull())).alias("l")
        )
        return exploded.select(
            F.col("l.je").alias("JE_HEADER_ID"), F.col("l.ln").alias("JE_LINE_NUM"),
            F.col("l.ccid").alias("CODE_COMBINATION_ID"), F.lit(1).cast("long").alias("LEDGER_ID"),
            F.col("period").alias("PERIOD_NAME"), F.col("l.dr").alias("ACCOUNTED_DR"),
            F.col("l.cr").alias("ACCOUNTED_CR"), F.last_day("acct_date").alias("EFFECTIVE_DATE"),
            F.col("l.src").alias("JE_SOURCE"), F.col("l.cat").alias("JE_CATEGORY"),
            F.concat_ws(" ", F.col("l.src"), F.col("period"), F.col("org_id").cast("string")).alias("NAME"),
        )

    @cached_property
    def gl_je_lines(self) -> DataFrame:
        return _conform(self._journal_lines, "gl_je_lines")

    @cached_property
    def gl_je_headers(self) -> DataFrame:
        return _conform(self._journal_lines.filter(F.col("JE_LINE_NUM") == 1), "gl_je_headers")

    # -- sub-ledger accounting bridge -----------------------------------------------------

    @cached_property
    def _linked(self) -> DataFrame:
        return self._distributions.filter(F.col("dist_id") % UNLINKED_MOD != UNLINKED_REM)

    @cached_property
    def xla_ae_headers(self) -> DataFrame:
        d = self._linked
        return _conform(
            d.select(
                F.col("dist_id").alias("AE_HEADER_ID"),
                F.lit("Payables").alias("APPLICATION_NAME"),
                F.col("period").alias("PERIOD_NAME"),
                F.col("acct_date").alias("ACCOUNTING_DATE"),
            ),
            "xla_ae_headers",
        )

    @cached_property
    def xla_distribution_links(self) -> DataFrame:
        d = self._linked
        return _conform(
            d.select(
                F.col("dist_id").alias("GL_SL_LINK_ID"),
                F.col("dist_id").alias("SOURCE_DISTRIBUTION_ID_NUM_1"),
                F.lit("AP_INV_DIST").alias("SOURCE_DISTRIBUTION_TYPE"),
                self._je_id(F.col("acct_date"), F.col("org_id")).alias("JE_HEADER_ID"),
                F.col("dist_id").alias("AE_HEADER_ID"),
            ),
            "xla_distribution_links",
        )

    # -- security -------------------------------------------------------------------------------

    @cached_property
    def org_security_map(self) -> DataFrame:
        orgs = self.hr_operating_units
        board = orgs.select(F.lit(BOARD_USER).alias("USER_NAME"), "ORG_CODE")
        grants = self.spark.createDataFrame(list(SECURITY_GRANTS), "USER_NAME string, ORG_CODE string")
        # keep only grants on plants that exist (bounded: one row per grant)
        grants = grants.join(F.broadcast(orgs.select("ORG_CODE")), "ORG_CODE", "left_semi")
        return _conform(board.unionByName(grants), "org_security_map")


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Fixtures(spark, sf_dir).tables()
