"""Landing -> bronze: read extracts with explicit schemas, tag them, write them as-is.

The source is a parameter: CSV files with a header (the reference), JSON lines, parquet, or any
``spark.read.format`` source such as JDBC (``options`` carries the connection; each
extract's ``dbtable``/``query`` and read partitioning -- ``partitionColumn``/
``numPartitions`` so a large table is read in parallel -- go per table). Whatever the way in,
``conform`` types the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparesledger.session import shuffles_removed
from sparesledger.sources.conform import CORRUPT, FILE, PROBLEMS, conform, declared, judged
from sparesledger.sources.schemas import SOURCE_TABLES

SOURCE_SYSTEM = "EBS_R12"  # fixed value of the audit column
ROWS_PER_FILE = 1_000_000  # of a compressed extract
Types = Mapping[str, Mapping[str, str]]  # by extract: column -> type instead of the declared one


def json_schema(table: str, types: Mapping[str, str] | None = None) -> T.StructType | None:
    """What JSON is read as: numbers at 18 places (``conform`` holds them against the declared
    type), dates as text."""
    schema = declared(table, types)
    wider = {T.DecimalType: T.DecimalType(38, 18), T.DateType: T.StringType()}
    return schema and T.StructType([T.StructField(f.name, wider.get(type(f.dataType), f.dataType)) for f in schema.fields])


def _raw(spark: SparkSession, table: str, path: str | None, fmt: str, options: Mapping[str, str] | None,
         types: Mapping[str, str] | None, bad_lines: bool = False, predicates: Sequence[str] | None = None) -> DataFrame:
    """The extract as its source has it: CSV as text under its header's names, JSON numbers wide,
    other formats in their own types. ``bad_lines``: a malformed CSV or JSON line is kept in
    ``CORRUPT`` instead of failing the read. ``predicates``: one task each reads a JDBC table."""
    opts = dict(options or {})
    if predicates:
        own = {k.lower(): k for k in opts}
        url, name = opts.pop(own["url"]), opts.pop(own["dbtable"])
        return spark.read.jdbc(url, name, predicates=list(predicates), properties=opts)
    if fmt == "csv":
        opts.setdefault("header", "true")
        opts.setdefault("enforceSchema", "false")  # each file's header is held against the first one's
        if not bad_lines:
            opts.setdefault("mode", "FAILFAST")
            return spark.read.options(**opts).csv(path)
        names = spark.read.options(**opts).csv(path).columns
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
        return spark.read.options(**opts, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).schema(schema).csv(path)
    reader = spark.read.format(fmt)
    if fmt == "json" and (schema := json_schema(table, types)):
        opts.setdefault("mode", "PERMISSIVE" if bad_lines else "FAILFAST")
        if bad_lines:
            schema = schema.add(CORRUPT, T.StringType())
            opts["columnNameOfCorruptRecord"] = CORRUPT
        reader = reader.schema(schema)
    reader = reader.options(**opts)
    return reader.load(path) if path is not None else reader.load()


def read_extract(
    spark: SparkSession,
    table: str,
    path: str | None = None,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """One extract in its declared types (no inference, so no extra pass over the file).

    Columns are taken by name, whatever their order; columns that are not declared are kept
    behind the declared ones, and a missing one raises ``ValueError``. Dates may carry a time of
    day. A value that its declared type cannot hold exactly fails the read instead of being
    rounded; ``types`` declares another type for a column, such as ``{"ITEM_COST": "decimal(20,8)"}``.
    """
    return conform(_raw(spark, table, path, fmt, options, types), table, types)


def split_extract(
    spark: SparkSession,
    table: str,
    path: str | None = None,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """One extract with every row: typed columns, ``_problems`` (empty for a good row), the file the
    row stands in and its source text. ``good_rows`` and ``rejects`` part them."""
    rows = _raw(spark, table, path, fmt, options, types, bad_lines=True, predicates=predicates)
    at = F.col("_metadata.file_path") if fmt != "jdbc" else F.lit(None).cast("string")
    return judged(rows.withColumn(FILE, at), table, types)


def good_rows(split: DataFrame) -> DataFrame:
    return split.filter(F.size(PROBLEMS) == 0).drop(PROBLEMS, FILE, "_source_row")


def rejects(split: DataFrame, table: str) -> DataFrame:
    """The rows of ``split_extract`` that did not fit: extract, file, problems, source row."""
    return split.filter(F.size(PROBLEMS) > 0).select(
        F.lit(table).alias("table_name"), F.col(FILE).alias("source_file"), F.col(PROBLEMS).alias("problems"),
        F.col("_source_row").alias("source_row"))


def add_audit_columns(df: DataFrame, source_system: str = SOURCE_SYSTEM) -> DataFrame:
    """``_ingest_ts`` (load time) and ``_source_system`` on every bronze row."""
    return df.withColumn("_ingest_ts", F.current_timestamp()).withColumn("_source_system", F.lit(source_system))


def extract_options(table: str, fmt: str, options: Mapping[str, str] | None,
                    table_options: Mapping[str, Mapping[str, str]] | None) -> dict[str, str]:
    """The reader options of one extract: the common ones, its own, and for JDBC its name as ``dbtable``
    unless it names a table or query."""
    opts = {**(options or {}), **((table_options or {}).get(table, {}))}
    if fmt == "jdbc" and not {k.lower() for k in opts} & {"dbtable", "query"}:  # JDBC keys are case-insensitive
        opts["dbtable"] = table
    return opts


def extract_path(root: str | None, table: str, fmt: str) -> str | None:
    return None if fmt == "jdbc" else f"{root.rstrip('/')}/{table}.{fmt}"


def land_bronze(
    spark: SparkSession,
    source_root: str | None,
    target_root: str,
    tables: Iterable[str] = SOURCE_TABLES,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    table_options: Mapping[str, Mapping[str, str]] | None = None,
    types: Types | None = None,
) -> dict[str, str]:
    """Full refresh of each extract into ``{target_root}/{table}`` (parquet, overwrite).

    Files are read from ``{source_root}/{table}.{fmt}``. With ``fmt='jdbc'``, ``options``
    holds the connection (url, user, driver, ...) and ``table_options[table]`` what belongs to
    one extract: its ``dbtable`` or ``query`` and its read partitioning (``partitionColumn``,
    ``lowerBound``, ``upperBound``, ``numPartitions``); without either, ``dbtable`` is the
    extract name.
    """
    tables = list(tables)
    if fmt == "jdbc" and len(tables) > 1 and {k.lower() for k in (options or {})} & {"dbtable", "query"}:
        raise ValueError("dbtable/query name one extract: give them per table in table_options")
    written = {}
    for t in tables:
        opts = extract_options(t, fmt, options, table_options)
        df = read_extract(spark, t, extract_path(source_root, t, fmt), fmt, opts, (types or {}).get(t))
        out = f"{target_root}/{t}"
        add_audit_columns(df).write.mode("overwrite").parquet(out)
        written[t] = out
    return written


def write_extracts(sources: Mapping[str, DataFrame], root: str, fmt: str = "csv", parallelism: int = 4,
                   compression: str | None = None) -> dict[str, str]:
    """Write source-shaped DataFrames as extract files (``{root}/{table}.{fmt}``), one folder each,
    ``parallelism`` of them at a time. A file compressed with ``compression`` (such as ``gzip``) is read by
    one task, so it gets ``ROWS_PER_FILE`` rows at most."""

    def write(t: str) -> str:
        path = f"{root}/{t}.{fmt}"
        w = sources[t].write.mode("overwrite")
        if fmt == "csv":
            w = w.option("header", "true").option("dateFormat", "yyyy-MM-dd")
        if compression:
            w = w.options(compression=compression, maxRecordsPerFile=ROWS_PER_FILE, **{"zlib.compress.level": "BEST_SPEED"})
        w.format(fmt).save(path)
        return path

    if not sources:
        return {}
    with shuffles_removed(next(iter(sources.values())).sparkSession), ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return dict(zip(sources, pool.map(write, sources)))
