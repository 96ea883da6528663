"""Texts as number sequences over a chunk's own vocabulary.

A chunk is a few MB of consecutive documents. Its texts become one row of word numbers (the
positions), and its distinct words are dealt to hash buckets, one row per bucket. So a word
crosses the shuffle once per chunk, however often it occurs, and its occurrences stay with the
chunk; a very frequent word is no hot key. Numbers are given bucket by bucket, so what a bucket
returns for its words in their order lines up with the sequence by plain concatenation.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_bytes, in_blocks, stored

SCHEMA = "chunk long, bucket int, ids array<{id}>, a binary, b binary, c binary"
NAMES = ["chunk", "bucket", "ids", "a", "b", "c"]


def packed(x: np.ndarray | bytes, level: int = 1) -> bytes:
    raw = x if isinstance(x, bytes) else x.tobytes()
    return zstandard.ZstdCompressor(level=level).compress(raw)


def unpacked(x: bytes, kind: str | None = None):
    raw = zstandard.ZstdDecompressor().decompress(x)
    return raw if kind is None else np.frombuffer(raw, dtype=kind)


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which compress better."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes() if x.size else b""


def from_planes(raw: bytes, kind: str) -> np.ndarray:
    """The numbers of ``planes``."""
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, len(raw) // size).T.copy().view(kind).ravel()


def vocabulary() -> defaultdict:
    """word -> its number, by first appearance."""
    words: defaultdict = defaultdict()
    words.default_factory = words.__len__
    return words


def numbers(words: dict, tokens: list) -> np.ndarray:
    return np.fromiter(map(words.__getitem__, tokens), dtype=np.uint32, count=len(tokens))


def runs(lengths: np.ndarray) -> np.ndarray:
    """0..l-1 for each length in turn."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches values[s:s + l], one after the other."""
    return values[np.repeat(starts, lengths) + runs(lengths)]


def batch_of(id_type: pa.DataType, rows: list[tuple]) -> pa.RecordBatch:
    chunk, bucket, ids, a, b, c = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(chunk, pa.int64()), pa.array(bucket, pa.int32()), pa.array(ids, pa.list_(id_type)),
         pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(c, pa.binary())], NAMES)


def cut(docs: DataFrame, columns: list, id_type: str, tokenise: Callable, buckets: int, limit: int = 8 << 20,
        checked: bool = False, apart: bool = False) -> DataFrame:
    """The chunks of ``docs`` (``columns``: id, text, then what else ``tokenise`` is given), not stored.

    ``tokenise(texts, batch slice)`` gives (distinct words as bytes, number sequence of each text,
    a weight per word or None, an array kept beside the sequences or None). Rows of bucket -1
    hold the ids, sequence lengths (a), numbers (b) and that array (c); the others hold words
    (a), word lengths (b) and weights (c). A chunk's number is its partition's and its place in it,
    so it says the same on a second evaluation only where the partitions of ``docs`` do. For that,
    ``checked`` puts a digest of the words into c instead: of all in row -1, of a bucket's in its row.
    ``apart`` keeps numbers beyond two bytes as three planes of bytes: smaller, for a little more time.
    """

    def run(batches):
        part, n = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = [t or b"" for t in as_bytes(batch.column(1))]
            for x, y in in_blocks(texts, limit):
                words, seqs, weights, beside = tokenise(texts[x:y], batch.slice(x, y - x))
                rows = []
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
                home = (hashes % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(home, kind="stable")
                place = np.empty(len(words), dtype=np.uint32)
                place[order] = np.arange(len(words), dtype=np.uint32)
                small = np.uint16 if len(words) <= 1 << 16 else np.uint32
                if checked:
                    beside = digest(hashes)
                sequence = place[np.concatenate(seqs)].astype(small) if words else b""
                if apart and 1 << 16 < len(words) <= 1 << 24:
                    sequence = planes(sequence)[:3 * len(sequence)]
                rows.append((part + n, -1, batch.column(0).slice(x, y - x).to_pylist(),
                             packed(np.array([len(s) for s in seqs], dtype=np.uint32)),
                             packed(sequence),
                             None if beside is None else packed(beside)))
                bounds = np.searchsorted(home[order], np.arange(buckets + 1))
                for k in np.flatnonzero(np.diff(bounds)).tolist():
                    mine = order[bounds[k]:bounds[k + 1]]
                    own = [words[i] for i in mine.tolist()]
                    rows.append((part + n, k, None, packed(b"".join(own)),
                                 packed(np.array([len(w) for w in own], dtype=np.uint32)),
                                 packed(digest(hashes[mine])) if checked else
                                 None if weights is None else packed(weights[mine])))
                n += 1
                yield batch_of(batch.column(0).type, rows)

    return docs.select(*columns).mapInArrow(run, SCHEMA.format(id=id_type))


def chunked(docs: DataFrame, columns: list, id_type: str, tokenise: Callable, buckets: int, name: str, apart: bool = False) -> DataFrame:
    """``cut``, stored."""
    return stored(cut(docs, columns, id_type, tokenise, buckets, apart=apart), name, "none")


def digest(hashes: np.ndarray) -> np.ndarray:
    """Number and exclusive-or of word hashes: the digests of parts add up to that of the whole."""
    return np.array([len(hashes), np.bitwise_xor.reduce(hashes, initial=np.uint64(0))], dtype=np.uint64)


def words_of(a: bytes, b: bytes) -> list[bytes]:
    text, ends = unpacked(a), np.cumsum(unpacked(b, "<u4"))
    ends = ends.tolist()
    return [text[s:e] for s, e in zip([0, *ends[:-1]], ends)]


def per_bucket(rows: DataFrame, resolve: Callable[[Iterator], Iterator], id_type: str) -> DataFrame:
    """``resolve`` over each task's word rows in bucket order: gives (chunk, bucket, a, b, c)."""

    def run(batches):
        for chunk, bucket, a, b, c in resolve((r[0], r[1], r[2], r[3], r[4]) for batch in batches
                                              for r in zip(*(batch.column(k).to_pylist() for k in ("chunk", "bucket", "a", "b", "c")))):
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([bucket], pa.int32()), pa.nulls(1, pa.list_(pa.null())),
                                              pa.array([a], pa.binary()), pa.array([b], pa.binary()), pa.array([c], pa.binary())], NAMES
                                             ).select(["chunk", "bucket", "a", "b", "c"])

    words = rows.filter("bucket >= 0").select("chunk", "bucket", "a", "b", "c")
    return (words.repartition("bucket").sortWithinPartitions("bucket", "chunk")
            .mapInArrow(run, "chunk long, bucket int, a binary, b binary, c binary"))


def per_chunk(rows: DataFrame, resolved: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """``finish(chunk, ids, lengths, numbers, beside, [(a, b, c) of the buckets in order])`` for each
    chunk, which gives RecordBatches."""
    id_type = rows.schema["ids"].dataType

    def done(chunk, held):
        (ids, a, b, c), found = held
        yield from finish(chunk, ids, *sequences(a, b), None if c is None else unpacked(c), found)

    def run(batches):
        at, held = None, None
        for batch in batches:
            ids = batch.column(2)
            for i in range(batch.num_rows):
                chunk, bucket, a, b, c = (batch.column(k)[i].as_py() for k in ("chunk", "bucket", "a", "b", "c"))
                if chunk != at:
                    if held:
                        yield from done(at, held)
                    at, held = chunk, None
                if bucket < 0:
                    held = ((ids[i].values, a, b, c), [])
                else:
                    held[1].append((a, b, c))
        if held:
            yield from done(at, held)

    both = rows.filter("bucket < 0").unionByName(resolved.withColumn("ids", F.lit(None).cast(id_type)).select(*NAMES))
    return both.repartition("chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(run, schema)


def sequences(a: bytes, b: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and numbers of a chunk's row -1."""
    numbers_ = unpacked(b)
    lengths = unpacked(a, "<u4").astype(np.int64)
    n = int(lengths.sum())
    if n and len(numbers_) == 3 * n:
        return lengths, from_planes(numbers_ + bytes(n), "<u4")
    return lengths, np.frombuffer(numbers_, dtype="<u2" if len(numbers_) == 2 * n else "<u4")


def per_chunk_again(rows: DataFrame, resolved: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """``per_chunk`` where ``rows`` are ``checked`` and cut a second time for the sequences.

    The two sides are shuffled apart from each other, so each is cut in a stage of its own, with
    the partition numbers of ``docs``. A chunk whose words are not those of its sequences (the
    partitions of ``docs`` came out differently) is an error, never a wrong row.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise RuntimeError("the chunks differ between two evaluations; store the documents first")
        row = left.to_batches()[0]
        found = sorted(zip(*(right.column(k).to_pylist() for k in ("bucket", "a", "b", "c"))), key=lambda x: x[0])
        parts = np.array([unpacked(c, "<u8") for *_, c in found], dtype=np.uint64).reshape(-1, 2)
        whole = unpacked(row.column(5)[0].as_py(), "<u8")
        if (parts[:, 0].sum(), np.bitwise_xor.reduce(parts[:, 1])) != tuple(whole):
            raise RuntimeError("the chunks differ between two evaluations; store the documents first")
        lengths, numbers_ = sequences(row.column(3)[0].as_py(), row.column(4)[0].as_py())
        return pa.Table.from_batches(list(finish(row.column(0)[0].as_py(), row.column(2)[0].values, lengths, numbers_, None,
                                                 [x[1:] for x in found])))

    return rows.filter("bucket < 0").groupBy("chunk").cogroup(resolved.groupBy("chunk")).applyInArrow(run, schema)


def bucket_count(docs: DataFrame) -> int:
    """As many buckets as the session shuffles into partitions."""
    return max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
