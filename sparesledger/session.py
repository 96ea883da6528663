"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import threading
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale. On a cluster, size shuffle partitions so one reduce
# partition holds ~128-256 MB after AQE coalescing; AQE then merges small ones and splits
# skewed join partitions at run time.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "sparesledger",
    driver_memory: str = "8g",
    extra: dict | None = None,
) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folder chosen by ensure_checkpoint_dir when spark.checkpoint.dir is unset (tests, bench).
# Keyed weakly by the SparkContext it configured: every session of that context sees it, and
# it dies with the context, so a new one never inherits it.
_LOCAL_FALLBACK: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def shared_folder(spark: SparkSession) -> str | None:
    """The folder the session names in ``spark.checkpoint.dir`` (None when unset).

    The session conf is read first (it also carries the cluster's value); the context conf
    is a fallback for deployments that keep it only there. This is the stable base for
    written tables and stream checkpoints -- Spark's own checkpoint folder adds a
    per-application UUID below it and would move on every run. A local folder chosen by
    ``ensure_checkpoint_dir`` (tests, bench) is remembered for its SparkContext.
    """
    d = None
    try:
        d = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:  # noqa: BLE001 - some deployments refuse conf lookups
        d = None
    if not d:
        try:
            d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - no JVM context (e.g. Spark Connect)
            d = None
    if d:
        return d
    try:
        return _LOCAL_FALLBACK.get(spark.sparkContext)
    except Exception:  # noqa: BLE001 - no JVM context (e.g. Spark Connect)
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """``shared_folder``, else the folder set with ``setCheckpointDir`` (None when neither)."""
    return shared_folder(spark) or spark.sparkContext.getCheckpointDir() or None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder; set one only when the session has none.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is always used as is.
    Only callers that know they run locally (tests, the bench) pass ``fallback``; library
    code passes nothing and fails loudly rather than writing to a machine-local folder.
    """
    d = shared_folder(spark)
    if d:
        return d
    if fallback is None:
        raise ValueError(
            "spark.checkpoint.dir is not set: set it to shared storage (or pass an explicit root/checkpoint path)"
        )
    if spark.sparkContext.getCheckpointDir():
        # set programmatically: its base is not known (Spark adds a per-application folder),
        # and a local fallback must not silently replace it
        raise ValueError("checkpoint folder set without spark.checkpoint.dir: set the conf to its base")
    spark.sparkContext.setCheckpointDir(fallback)
    _LOCAL_FALLBACK[spark.sparkContext] = fallback  # later calls (default roots, streams) agree
    return fallback  # the stable base, not Spark's per-application subfolder


def work_folder(spark: SparkSession) -> str:
    """Where queries that write put their tables: the shared folder, else the folder set with
    ``setCheckpointDir``; with neither, a temporary one where the session runs in one local process
    (tests). On a cluster an unset folder is an error."""
    found = checkpoint_dir(spark)
    if found:
        return found
    master = spark.sparkContext.master
    local = master == "local" or master.startswith("local[")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="sparesledger-") if local else None)


CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING: dict[str, tuple[int, str | None]] = {}  # by session: blocks entered, the setting before the first
_CLEANING_LOCK = threading.Lock()


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Of the writes in this block Spark removes the shuffle files when each one ends: what was written
    is what later steps read. They would stay until the driver happens to collect garbage. The last
    block to end, of those open at once in a session, puts the session's setting back."""
    session = spark._jsparkSession.sessionUUID()
    with _CLEANING_LOCK:
        blocks, was = _CLEANING.get(session) or (0, spark.conf.get(CLEAN_SHUFFLES, None))
        _CLEANING[session] = blocks + 1, was
        spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            blocks, was = _CLEANING.pop(session)
            if blocks > 1:
                _CLEANING[session] = blocks - 1, was
            elif was is None:
                spark.conf.unset(CLEAN_SHUFFLES)
            else:
                spark.conf.set(CLEAN_SHUFFLES, was)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written into the new folder ``path`` and read back, its shuffle files gone."""
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                 max_partitions: int | None = None) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    The initial shuffle partition count is set so the largest shuffle (the transaction
    profile, at most the size of its input after partial aggregation) gives about
    ``target_partition_bytes`` per reduce task -- small enough to sort and aggregate without
    heavy spill -- and never fewer than two waves of tasks over the cluster's cores. AQE then
    coalesces partitions that turn out small and splits skewed ones, so over-estimating is
    cheap and under-estimating is what this guards against.

    >>> cluster_conf(100 * 2**40, 8000)["spark.sql.shuffle.partitions"]
    '409600'
    """
    by_size = -(-input_bytes // target_partition_bytes)
    n = max(2 * total_cores, by_size)
    if max_partitions is not None:  # the caller's choice: larger reduce tasks for fewer of them
        n = min(n, max_partitions)
    return {
        **SCALE_CONF,
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(target_partition_bytes, 256 << 20)),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def hadoop_path(spark: SparkSession, path: str):
    """(FileSystem, qualified Path) for ``path`` under the session's Hadoop configuration."""
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    return fs, fs.makeQualified(p)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more (no error if it is not there)."""
    fs, at = hadoop_path(spark, path)
    fs.delete(at, True)
