"""Incremental landing: new extract files -> bronze, each file exactly once.

The reference reloads every extract in full. When extracts arrive as files in a drop
folder (or a replication tool writes them there), Structured Streaming's file source
lands only the new ones: the checkpoint records which files were committed, the parquet
sink writes each micro-batch atomically, and a restarted query resumes where it stopped.
``availableNow`` processes what is there and stops, so the same code runs as a scheduled
batch job or as a continuous stream (``processing_time``). Rows are typed by the same
``conform`` as in batch: columns go by header name and numbers are never rounded.

A file that is sent again, or a row that changed, lands behind the older one; ``current_rows``
reads the target as it stands: of each key the row that landed last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparesledger.session import ensure_checkpoint_dir, hadoop_path
from sparesledger.sources.bronze import SOURCE_SYSTEM, add_audit_columns, json_schema
from sparesledger.sources.conform import conform, declared
from sparesledger.sources.schemas import AUDIT_COLUMNS, SOURCE_KEYS


def _file_schema(spark: SparkSession, table: str, source_dir: str, fmt: str, opts: Mapping[str, str],
                 types: Mapping[str, str] | None) -> T.StructType:
    """The columns of the files as they are: for CSV the header's names, all text, for JSON wide
    numbers, else what the files state. With no file there yet the declared columns stand in; a
    later CSV file whose header differs from them then stops the stream, as one does that differs
    from the first file's."""
    if fmt == "json" and (schema := json_schema(table, types)):
        return schema
    fs, pattern = hadoop_path(spark, source_dir)
    if fs.globStatus(pattern):
        found = spark.read.format(fmt).options(**opts).load(source_dir).schema
    else:
        found = declared(table, types) or T.StructType()
    if fmt != "csv":
        return found
    return T.StructType([T.StructField(f.name, T.StringType()) for f in found.fields])


def stream_extract(
    spark: SparkSession,
    table: str,
    source_dir: str,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    source_system: str = SOURCE_SYSTEM,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """A streaming DataFrame over the extract files of one table, with audit columns."""
    opts = dict(options or {})
    if fmt in ("csv", "json"):
        opts.setdefault("mode", "FAILFAST")  # as the batch reader: a malformed row stops the stream
    if fmt == "csv":
        opts.setdefault("header", "true")
        opts.setdefault("enforceSchema", "false")
    schema = _file_schema(spark, table, source_dir, fmt, opts, types)
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    df = spark.readStream.format(fmt).schema(schema).options(**opts).load(source_dir)
    return add_audit_columns(conform(df, table, types), source_system)


def current_rows(landed: DataFrame, table: str, keys: Sequence[str] | None = None) -> DataFrame:
    """The landed rows of an extract as they stand: of each key the one that landed last (of one
    batch the largest row), without audit columns.

    ``keys`` default to the extract's own; an extract without a key can't be landed this way and
    raises ``ValueError``. One hash aggregation that keeps a row per key and task before the shuffle.
    """
    keys = list(keys or SOURCE_KEYS.get(table, ()))
    if not keys:
        raise ValueError(f"extract {table} has no key: load it in full")
    rows = [c for c in landed.columns if c not in AUDIT_COLUMNS]
    whole = F.struct(*(F.col(f"`{c}`") for c in rows))
    last = landed.groupBy(*(F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys))).agg(
        F.max(F.struct(F.col("_ingest_ts"), whole.alias("row"))).alias("last"))
    return last.select(*(F.col(f"last.row.`{c}`").alias(c) for c in rows))


def _qualified(spark: SparkSession, path: str) -> str:
    """``path`` qualified as the sink resolves it (session Hadoop conf, scheme, no extra '/')."""
    return hadoop_path(spark, path)[1].toString()


def land_incrementally(
    spark: SparkSession,
    table: str,
    source_dir: str,
    target_dir: str,
    checkpoint_location: str | None = None,
    fmt: str = "csv",
    options: Mapping[str, str] | None = None,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    types: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start the landing query; with no ``processing_time`` it drains the folder and stops."""
    # A stream's identity is its sink: a target folder's commit log and its checkpoint are a
    # pair. The default checkpoint lives under the configured shared folder, keyed by the
    # qualified target, so a restarted application resumes it. A target that already has a
    # commit log is never paired with a fresh checkpoint (the sink would skip the new batch
    # ids as already committed): land a different source into a new target instead. The
    # query name carries the same key, so two streams cannot write one target at once.
    key = hashlib.sha1(_qualified(spark, target_dir).encode()).hexdigest()[:16]
    ckpt = checkpoint_location or f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/bronze/{table}-{key}"
    fs, sink_log = hadoop_path(spark, f"{target_dir.rstrip('/')}/_spark_metadata")
    if fs.exists(sink_log) and not fs.exists(hadoop_path(spark, f"{ckpt.rstrip('/')}/commits")[1]):
        raise ValueError(f"{target_dir} already has a stream commit log but {ckpt} has no commits: "
                         "resume with its checkpoint, or land into a new target")
    writer = (
        stream_extract(spark, table, source_dir, fmt, options, max_files_per_trigger, types=types)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", ckpt)
        .queryName(f"land_{table}_{key[:8]}")
    )
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    return writer.start(target_dir)
