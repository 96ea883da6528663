"""Near-duplicate detection by circulant MinHash, banding and exact verification.

Signatures (Li and Li's C-MinHash): a first permutation scatters the shingles over 2**32
places, a second one, shifted circularly by k, gives coordinate k: the least of
``pi(sigma(s) - k)`` over the set. Two permutations serve for all coordinates; both are
bijections computed on the fly. Bands of coordinates are buckets of candidates; a candidate
pair is linked only if the full sets pass ``100 * intersection >= percent * union``.

Documents of equal sets are one class from the start, and only links between classes not yet
connected are looked for, as the result is each document's component. First each class is
compared with the bucket leader it shares most buckets with, one comparison each however large
the bucket. Of buckets that then still span several components, two classes of different
components are compared if they meet in a prefix: a set's rarest shingles, so many that sets
alike enough share one for certain, with enough shingles left in both after the first that they
share, and parity bits that do not differ too much (both bounds are exact); each is compared
with a few neighbours first, which connects most of a large group, then all pairs still in
different components are. So a common passage makes no pairs, a large group few, and no link
is lost.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER_ASCII, U64, WordHashes, as_bytes, fmix64, per_text, stored

COORDINATES = 130
NEIGHBOURS = 3
_WORDS = WordHashes()
_ODD = [U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingles(text: bytes, words: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles (A-Z lower-cased)."""
    h = _WORDS.of(text.translate(LOWER_ASCII).split())
    if not len(h):
        return h
    size = min(words, len(h))
    mixed = np.full(len(h) - size + 1, size, dtype=U64)
    for j in range(size):
        mixed = fmix64(mixed * _ODD[0] + h[j:len(h) - size + 1 + j])
    return np.unique(mixed)


def signature(found: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """C-MinHash coordinates (uint32) of a non-empty set of 64-bit hashes."""
    place = (fmix64(found + _ODD[1]) >> U64(32)).astype(np.uint32)  # sigma
    shift = np.arange(1, coordinates + 1, dtype=np.uint32)[:, None]
    least = np.full(coordinates, 0xFFFFFFFF, dtype=np.uint32)
    for s in range(0, len(place), 1024):
        x = place[None, s:s + 1024] - shift
        # pi: MurmurHash3's 32-bit finaliser, a bijection
        x ^= x >> np.uint32(16)
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(13)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def band_rows(percent: int) -> int:
    """Coordinates a band: as many as leave a pair at the threshold unseen less than once in a million."""
    for rows in (6, 5, 4, 3, 2):
        if (1 - (percent / 100) ** rows) ** (COORDINATES // rows) < 1e-6:
            return rows
    return 1


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    parts = sig[:len(sig) // rows * rows].reshape(-1, rows).astype(U64)
    h = np.arange(len(parts), dtype=U64)
    for j in range(rows):
        h = fmix64(h * _ODD[2] + parts[:, j])
    return h


def parities(found: np.ndarray) -> np.ndarray:
    """256 bits of a set, each the parity of the hashes that fall on it: two sets differ in at least
    as many elements as their bits differ."""
    odd = (np.bincount((found & U64(255)).astype(np.int64), minlength=256) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _survey(ids, texts, words: int, rows: int, seen: dict):
    n, key, own, flat, ends = [], [], [], [], [0]
    for t in texts:
        own.append(hashlib.sha256(t).digest())
        found = shingles(t, words)
        k = xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None
        if k is None:
            b = np.zeros(0, dtype=U64)
        elif (b := seen.get(k)) is None:
            if len(seen) > 20_000:
                seen.clear()
            b = seen[k] = bands(signature(found), rows)
        n.append(len(found))
        key.append(k)
        flat.append(b)
        ends.append(ends[-1] + len(b))
    values = np.concatenate(flat) if flat else np.zeros(0, dtype=U64)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(own, pa.binary()), pa.array(n, pa.int64()), pa.array(key, pa.binary()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.view(np.int64)))], ["id", "own", "n", "key", "bands"])


def _own(text: Column) -> Column:
    """The SHA-256 of a text, as in ``_survey``."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def connected(edges: DataFrame) -> DataFrame:
    """Rows (node, comp), comp the least node reachable, for the nodes of ``edges`` (a, b).

    Alternating large-star and small-star steps (Kiveris et al., 2014), each written to the
    shared folder; no component is ever gathered in one place.
    """
    edges = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                   "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        edges = stored(small.select("e.*").filter("a != b").distinct(), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def _stars(edges: DataFrame) -> bool:
    """Whether each node ``a`` has one edge, to a node that has none itself (true if there are none)."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    ends = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return ends.filter("out > 1 OR out > 0 AND into > 0").limit(1).count() == 0


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are alike enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(one, "a").join(two, "b")
    both = F.size(F.array_intersect("x", "y"))
    return joined.select("a", "b", both.alias("i"), (F.size("x") + F.size("y") - both).alias("u")).filter(
        F.lit(100) * F.col("i") >= F.lit(percent) * F.col("u")).select("a", "b")


def _relabel(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, comp) after the links (a, b) between nodes."""
    if links.limit(1).count() == 0:
        return labels
    comp = lambda c: labels.select(F.col("node").alias(c), F.col("comp").alias(f"comp_{c}"))
    between = links.join(comp("a"), "a").join(comp("b"), "b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b"))
    merged = connected(between).select(F.col("node").alias("comp"), F.col("comp").alias("root"))
    return stored(labels.join(merged, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")), "labels")


def _labelled(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """One row per input row: id, own (its text's digest), n, key (null without shingles), component, kept."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = band_rows(percent)
    found = per_text(docs, id_col, text_col, f"id {id_type}, own binary, n long, key binary, bands array<long>",
                     _survey, words, rows, {})
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "shingles")
    # a class stands for its first row: null ids come last, equal ids go by text, equal rows by place
    classes = found.filter("key IS NOT NULL").groupBy("key").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "own", "row")).alias("low"),
        F.first("n").alias("n"), F.first("bands").alias("bands"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    members = classes.select("node", "n", F.explode("bands").alias("bucket"))
    multi = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("bucket")
    members = stored(members.join(multi, "bucket", "left_semi"), "members")
    # full sets of the candidates' classes, from one text of each
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "low.id", "low.own", "key")
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).withColumn("own", _own(F.col("text")))

    def sets_of(batches):
        for batch in batches:
            for i, t in enumerate(as_bytes(batch.column(2))):
                s = shingles(t or b"", words)
                if len(s) and xxhash.xxh3_128_digest(s.tobytes()) == batch.column(1)[i].as_py():
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(i, 1), pa.array([s.view(np.int64)], pa.list_(pa.int64())),
                         pa.array([parities(s)], pa.list_(pa.int64()))], ["node", "shingles", "bits"])

    fetched = wanted.join(texts, wanted["id"].eqNullSafe(texts["id"]) & (wanted["own"] == texts["own"])).select("node", "key", "text")
    sets = stored(fetched.mapInArrow(sets_of, "node long, shingles array<long>, bits array<long>").dropDuplicates(["node"]), "sets", "none")

    # first, each member with the bucket-mate it shares most buckets with, of those that lead them
    lead = members.groupBy("bucket").agg(F.min("node").alias("a"))
    shared = (members.select("bucket", F.col("node").alias("b"), F.col("n").alias("nb")).join(lead, "bucket").filter("a < b")
              .groupBy("a", "b").agg(F.count(F.lit(1)).alias("k"))
              .groupBy("b").agg(F.max_by("a", F.struct("k", F.negative("a"))).alias("a")))
    labels = stored(members.select("node").distinct().withColumn("comp", F.col("node")), "labels")
    labels = _relabel(labels, stored(_verified(shared.select("a", "b"), sets, percent), "links"))

    # then, of buckets that span several components, the pairs whose rarest shingles meet
    open_ = members.join(labels, "node")
    alive = open_.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x != y").select("bucket")
    some = open_.join(alive, "bucket", "left_semi").select("node", "n", "comp").distinct()
    each = stored(some.join(sets, "node").select("node", "n", "comp", F.explode("shingles").alias("shingle")), "open-shingles", "none")
    often = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    rarest = Window.partitionBy("node").orderBy(F.coalesce("times", F.lit(1)), "shingle")
    prefix = (each.join(often, "shingle", "left").withColumn("place", F.row_number().over(rarest))
              .filter((F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1) & F.col("times").isNotNull()))
    # those whose own rare shingles leave too few for a partner of the least size are in no link
    prefix = prefix.filter((F.col("n") - F.col("place") + 1) * (100 + percent) >= F.col("n") * percent + F.ceil(F.col("n") * percent / 100) * percent)
    prefix = prefix.select("shingle", "node", "n", (F.col("n") - F.col("place") + 1).alias("rest"))
    # sizes that can be alike, and (for the first shingle that two share) enough shingles left from there on
    # and, by the parity bits, few enough differences
    differ = sum(F.bit_count(F.col("va")[i].bitwiseXOR(F.col("vb")[i])) for i in range(4))
    alike = ((F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
             & (F.lit(100 + percent) * F.least("ra", "rb") >= F.lit(percent) * (F.col("na") + F.col("nb")))
             & (F.lit(100 + percent) * (F.col("na") + F.col("nb") - differ) >= F.lit(2 * percent) * (F.col("na") + F.col("nb"))))
    prefix = stored(prefix.join(sets.select("node", "bits"), "node"), "prefixes", "none")
    # a few neighbours each first, in two random orders: they connect most of a large group
    for turn in range(2):
        order = Window.partitionBy("shingle").orderBy(F.xxhash64("node", F.lit(turn)), "node").rowsBetween(1, NEIGHBOURS)
        near = prefix.join(labels, "node").withColumn("mates", F.collect_list(F.struct("node", "n", "rest", "bits", "comp")).over(order))
        near = near.select(F.col("node").alias("p"), F.col("n").alias("na"), F.col("rest").alias("ra"), F.col("bits").alias("va"), "comp",
                           F.explode("mates").alias("m")).select(
            F.least("p", "m.node").alias("a"), F.greatest("p", "m.node").alias("b"), "na", "ra", "va", F.col("m.n").alias("nb"),
            F.col("m.rest").alias("rb"), F.col("m.bits").alias("vb"), F.col("comp").alias("ca"), F.col("m.comp").alias("cb"))
        pairs = near.filter((F.col("ca") != F.col("cb")) & alike).select("a", "b").distinct()
        labels = _relabel(labels, stored(_verified(pairs, sets, percent), "links"))
    # then all that are still in different components
    last = prefix.join(labels, "node")
    one = last.select("shingle", F.col("node").alias("a"), F.col("n").alias("na"), F.col("rest").alias("ra"), F.col("bits").alias("va"),
                      F.col("comp").alias("ca"))
    two = last.select("shingle", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("rest").alias("rb"), F.col("bits").alias("vb"),
                      F.col("comp").alias("cb"))
    pairs = (one.join(two, (one["shingle"] == two["shingle"]) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & alike)
             .select("a", "b").distinct())
    labels = _relabel(labels, stored(_verified(pairs, sets, percent), "links"))

    named = classes.select("key", "node", "low").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lowest = named.groupBy("comp").agg(F.min("low").alias("component"))
    by_key = named.join(lowest, "comp").select(F.col("key").alias("class"), "component")
    out = found.select("id", "own", "n", "key", "row").join(by_key, F.col("key") == F.col("class"), "left")
    linked = F.col("key").isNotNull()
    return out.select("id", "own", "n", "key", F.when(linked, F.col("component.id")).otherwise(F.col("id")).alias("component"),
                      F.when(linked, F.col("component.row") == F.col("row")).otherwise(F.lit(True)).alias("kept"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links, its own included (null ids are
    passed over; a component of null ids only has a null one). ``kept`` is true of one row of
    each component: that of the smallest id, null last; of rows of that id (or of null ids only)
    the one of the least text digest, and of rows alike in both any one. Null texts and texts
    without words have no shingles and no links: each such row is kept. An empty table gives an
    empty result.
    """
    return _labelled(docs, id_col, text_col, words, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                     percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component (the row that ``components`` keeps), all columns kept.

    Rows go by id and text together, so rows of one id, or of none, are told apart; of rows
    alike in both that are near copies' survivor one stays. Rows without shingles all stay.
    """
    found = _labelled(docs, id_col, text_col, words, percent).filter("key IS NOT NULL")
    marks = found.groupBy("id", "own").agg(F.min("kept").alias("all"), F.max("kept").alias("one")).filter("NOT all")
    marks = stored(marks.select(F.col("id").alias("__id"), F.col("own").alias("__sha"), "one"), "near-copies")
    rows = docs.select("*", _own(docs[text_col]).alias("__own"))

    def join(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        return left.join(right, left[id_col].eqNullSafe(right["__id"]) & (left["__own"] == right["__sha"]), how)

    left = join(rows, marks.filter("NOT one"), "left_anti")
    again = marks.filter("one")
    if again.limit(1).count():  # the survivor's id and text stand in several rows
        left = join(left, again, "left_anti").union(join(left, again, "left_semi").dropDuplicates([id_col, "__own"]))
    return left.select([F.col(f"`{c}`") for c in docs.columns])
