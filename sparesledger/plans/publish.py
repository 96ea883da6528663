"""Published versions of a layer, and what was written.

A run writes a layer's tables into a folder of its own and then publishes them all at once by
creating one small file, which names the version. Readers take the latest such file, so they see
the tables of one whole run; a run that fails before that leaves the previous version in place.

    {root}/{layer}/versions/{version}/{table}       the tables
    {root}/{layer}/manifests/{version}.jsonl        per table: rows, rejected rows, sums, bytes, schema
    {root}/{layer}/published/{number}-{version}     the switch; the largest name is current

Creating a file is atomic on HDFS and on object stores; nothing is renamed or overwritten. Files
of old versions stay until ``expire`` removes them, so a query that began before a switch ends.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from sparesledger.session import hadoop_path

@dataclass(frozen=True)
class Buckets:
    """A table stored in ``count`` buckets by ``column``, sorted by it in each file."""

    column: str
    count: int


MANIFEST = ("layer string, version string, table_name string, row_count long, rejected long, bytes long, files long, "
            "sums map<string,string>, columns array<struct<name:string,type:string,comment:string,filled:long>>, "
            "bucket_column string, bucket_count int, schema string, written_at timestamp")


@dataclass
class Written:
    """One written table, as its manifest line has it."""

    table_name: str
    row_count: int
    bytes: int
    files: int
    schema: str
    rejected: int = 0
    sums: dict[str, str] = field(default_factory=dict)
    columns: list[dict] = field(default_factory=list)
    bucket_column: str | None = None
    bucket_count: int | None = None


def new_version() -> str:
    now = _dt.datetime.now(_dt.timezone.utc)
    return f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def version_path(root: str, layer: str, version: str) -> str:
    return f"{root.rstrip('/')}/{layer}/versions/{version}"


def _manifest_path(root: str, layer: str, version: str) -> str:
    return f"{root.rstrip('/')}/{layer}/manifests/{version}.jsonl"


def write_table(df: DataFrame, path: str, partition_by: str | None = None, rejected: Observation | None = None,
                buckets: Buckets | None = None, fills: bool = False) -> Written:
    """Write ``df`` into the new folder ``path`` and count it on the way (no second scan): rows, the exact
    sum of every decimal column and, with ``fills``, the filled values of each column; bytes and files
    come from a listing.

    The counting is the last step before the write, behind any shuffle, so a stage that runs again
    after a lost executor is not counted twice.
    """
    out = df
    if partition_by:
        # REBALANCE, not repartition(col): AQE splits a hot month into advisory-size tasks and
        # merges small ones, so no month lands in one task and no month becomes many tiny files.
        out = df.hint("rebalance", partition_by)
    if buckets:
        out = df.repartition(buckets.count, buckets.column)
    seen = Observation()
    fields = df.schema.fields
    money = [i for i, f in enumerate(fields) if isinstance(f.dataType, DecimalType)]
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count(F.col(f"`{f.name}`")).alias(f"filled_{i}") for i, f in enumerate(fields) if fills),
                      *(F.sum(F.col(f"`{fields[i].name}`")).cast("string").alias(f"sum_{i}") for i in money))
    writer = out.write.mode("errorifexists").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if buckets:  # Spark writes buckets of tables only: a name for the time of the write, the files stay
        name = f"default.sparesledger_writing_{uuid.uuid4().hex}"
        writer.bucketBy(buckets.count, buckets.column).sortBy(buckets.column).option("path", path).saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
    else:
        writer.save(path)
    fs, at = hadoop_path(df.sparkSession, path)
    size = fs.getContentSummary(at)
    got = seen.get
    sums = {fields[i].name: got[f"sum_{i}"] for i in money if got[f"sum_{i}"] is not None}
    columns = [{"name": f.name, "type": f.dataType.simpleString(), "comment": f.metadata.get("comment"), "filled": got.get(f"filled_{i}")}
               for i, f in enumerate(fields)]
    return Written(path.rpartition("/")[2], got["rows"], size.getLength(), size.getFileCount(), df.schema.json(),
                   rejected.get["bad"] if rejected is not None else 0, sums, columns,
                   buckets and buckets.column, buckets and buckets.count)


def _create(spark: SparkSession, path: str, text: str) -> None:
    fs, at = hadoop_path(spark, path)
    out = fs.create(at, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, at = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def publish(spark: SparkSession, root: str, layer: str, version: str, tables: Sequence[Written]) -> None:
    """Make ``version`` the layer's current one. Of two runs that publish at once the later name
    wins as a whole."""
    now = _dt.datetime.now(_dt.timezone.utc).isoformat(timespec="milliseconds")
    lines = [json.dumps({"layer": layer, "version": version, **asdict(t), "written_at": now}) for t in tables]
    _create(spark, _manifest_path(root, layer, version), "\n".join(lines) + "\n")
    folder = f"{root.rstrip('/')}/{layer}/published"
    last = max((int(n.partition("-")[0]) for n in _names(spark, folder)), default=0)
    _create(spark, f"{folder}/{last + 1:012d}-{version}", "")


def versions(spark: SparkSession, root: str, layer: str) -> list[str]:
    """The layer's published versions, the current one last."""
    return [n.partition("-")[2] for n in _names(spark, f"{root.rstrip('/')}/{layer}/published")]


def current(spark: SparkSession, root: str, layer: str) -> str | None:
    return next(reversed(versions(spark, root, layer)), None)


def layer_path(spark: SparkSession, root: str, layer: str) -> str:
    """The folder that holds the layer's current tables."""
    version = current(spark, root, layer)
    if version is None:
        raise FileNotFoundError(f"no published {layer} under {root}")
    return version_path(root, layer, version)


def manifest(spark: SparkSession, root: str, layer: str, version: str | None = None) -> DataFrame:
    """One row per table of a published version (default: the current one); reads no table."""
    version = version or current(spark, root, layer)
    if version is None:
        raise FileNotFoundError(f"no published {layer} under {root}")
    return spark.read.schema(MANIFEST).json(_manifest_path(root, layer, version))


def read_layer(spark: SparkSession, root: str, layer: str, names: Iterable[str] | None = None,
               version: str | None = None) -> dict[str, DataFrame]:
    """The tables of one version (default: the current one) in the schemas they were written with:
    no footer is read, partition values keep their declared type and columns their order.

    An empty mapping where the layer was never published; ``KeyError`` for a name it does not have.
    """
    version = version or current(spark, root, layer)
    if version is None:
        return {}
    have = {r.table_name: r.schema for r in manifest(spark, root, layer, version).select("table_name", "schema").collect()}
    missing = [n for n in names or () if n not in have]
    if missing:
        raise KeyError(f"{layer} version {version} has no {', '.join(missing)}")
    out = {}
    for n in names if names is not None else have:
        schema = StructType.fromJson(json.loads(have[n]))
        out[n] = spark.read.schema(schema).parquet(f"{version_path(root, layer, version)}/{n}").select(*(f"`{c}`" for c in schema.names))
    return out


def expire(spark: SparkSession, root: str, layer: str, keep: int = 2) -> list[str]:
    """Delete the files of all published versions but the last ``keep`` (at least the current one);
    returns the versions removed. Their manifests stay as a record."""
    gone = versions(spark, root, layer)[:-max(1, keep)]
    for v in gone:
        fs, at = hadoop_path(spark, version_path(root, layer, v))
        fs.delete(at, True)
    return gone
