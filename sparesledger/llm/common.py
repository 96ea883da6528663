"""Helpers shared by the operators: intermediate tables, gapless ranks, hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparesledger.session import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Maps the bytes A-Z to a-z; all other bytes of UTF-8 stay.
LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
U64 = np.uint64
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_FALLBACK: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` as the session has it.

    Only where that is unset *and* the session runs in one local process (tests) is a
    temporary folder taken; on a cluster an unset folder is an error, as a machine-local one
    would be lost or unseen by other executors.
    """
    folder = shared_folder(spark)
    if folder:
        return folder
    sc = spark.sparkContext
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to storage that all executors share")
    if sc.applicationId not in _FALLBACK:
        _FALLBACK[sc.applicationId] = tempfile.mkdtemp(prefix="llm-")
    return _FALLBACK[sc.applicationId]


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    Cuts lineage (a lost executor loses nothing) and keeps later readers from computing it
    again. Once it is written, nothing reads the shuffle files it came from; Spark removes them at
    the end of the write rather than when the driver happens to collect garbage. The folder's
    retention policy removes old tables.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    was = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, was)
    return spark.read.schema(df.schema).parquet(path)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, nulls as None."""
    wide = pa.types.is_large_string(column.type)
    return column.cast(pa.large_binary() if wide else pa.binary()).to_pylist()


def slices(column: pa.Array, rows: int = 256) -> Iterator[pa.Array]:
    """``column`` in parts, so that not all its texts are Python objects at once."""
    for a in range(0, len(column), rows):
        yield column.slice(a, rows)


def in_blocks(texts: Sequence[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together (a longer text alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def per_text(docs: DataFrame, id_col: str, text_col: str, schema: str, rows: Callable, *args) -> DataFrame:
    """``rows(ids, texts, *args) -> RecordBatch`` applied to blocks of documents, by Arrow.

    ``ids`` is the id column's slice, ``texts`` UTF-8 bytes with null as empty. A block holds
    a few MB of text or one longer document, whatever the batch size.
    """

    def run(batches):
        for batch in batches:
            for ids, part in zip(slices(batch.column(0)), slices(batch.column(1))):
                texts = [t or b"" for t in as_bytes(part)]
                for a, b in in_blocks(texts):
                    yield rows(ids.slice(a, b - a), texts[a:b], *args)

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def gapless_rank(df: DataFrame, key: str, order: Sequence[str], out: str, n_rows: int, per_task: int = 4096) -> DataFrame:
    """Adds ``out``: 0, 1, 2, ... within each value of ``key``, without one task per key.

    Rows of a key are dealt to sub-buckets by a hash of ``order``; only (key, sub-bucket)
    counts are summed up in order, and rows are numbered inside their sub-bucket. The number
    of sub-buckets follows ``n_rows``, so a key that holds a third of all rows is spread.
    """
    subs = max(1, -(-n_rows // per_task))
    rows = df.withColumn("__sub", F.pmod(F.xxhash64(*order), F.lit(subs)))
    counts = rows.groupBy(key, "__sub").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(key).orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "__sub", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(key, "__sub").orderBy(*order)
    numbered = rows.withColumn("__row", F.row_number().over(inside))
    return (numbered.join(starts, [key, "__sub"])
            .withColumn(out, (F.col("__start") + F.col("__row") - 1).cast("long"))
            .drop("__sub", "__start", "__row"))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def fmix64(x: np.ndarray) -> np.ndarray:
    """MurmurHash3's 64-bit finaliser: a bijection of 64-bit words, element by element."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=U64, count=len(words))


def binary_rows(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose row i is ``values[offsets[i]:offsets[i + 1]]`` (1-byte values)."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(values)])
