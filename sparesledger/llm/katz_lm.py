"""Language-model scoring by Katz backoff over word n-grams of any order.

Texts become number sequences (see ``chunks``). Unigram counts come from the word buckets. Then
there is a level for each length of n-gram, two words and up: each chunk's distinct n-grams, as
one compact row per bucket, go to the bucket of their context, where all counts of that context
meet; the table of the bucket gives back each n-gram's count, which is also the count of the next
level's context. An n-gram whose context stands nowhere in the learned texts is not there either. A context that has at least 1/256 of all tokens (so there are at most 256) is
dealt over all buckets by its last word; its sums are small and added up. An n-gram whose context
stands once, in a learned text, has that count too and stays with its chunk, unless a held-out
text asks for the context.

The model, recursively: a seen n-gram has probability ``d_r * r / (c + 1/2)``, ``r`` its count,
``c`` its context's, ``d_r`` its level's Good-Turing discount (1 above five; half a count is set
aside so that no context is left without mass). An unseen one has the context's weight times the
word's probability after the context without its first word; the weight is the mass left over
divided by the shorter context's probability of all words not seen there, so each context's
probabilities sum up to one exactly. A context never seen has weight 1. Unigrams are discounted
the same way, and what they leave over is the probability of the unknown word. Discounts come
from the counts of counts of all tables of a level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chunks
from .chunks import from_planes, packed, planes, unpacked
from .common import LOWER_ASCII, U64, fmix64, stored

K = 5  # counts up to this are discounted
HOT = 256
_START = (1 << 63) - 1  # the context before the first word
END = b""  # the token after the last word; no word is empty


def good_turing(n: np.ndarray) -> np.ndarray:
    """Discounts d_0 .. d_K (d_0 unused) from counts of counts n_0 .. n_(K+1)."""
    d = np.ones(K + 1)
    last = (K + 1) * n[K + 1] / n[1] if n[1] else 0.0
    for r in range(1, K + 1):
        x = ((r + 1) * n[r + 1] / (r * n[r]) - last) / (1 - last) if n[r] and last < 1 else 0.0
        d[r] = x if 0 < x < 1 else r / (r + 0.5)  # too few counts for the estimate
    return d


class Unigrams:
    def __init__(self, n: np.ndarray, tokens: int, types: int):
        self.discount, self.tokens, self.types = good_turing(n), tokens, types
        used = sum(self.discount[r] * r * n[r] for r in range(1, K + 1)) + (tokens - sum(r * n[r] for r in range(1, K + 1)))
        self.unknown = (tokens - used + 0.5) / (tokens + 0.5)

    def prob(self, count: np.ndarray) -> np.ndarray:
        c = count.astype(np.float64)
        d = self.discount[np.minimum(count, K).astype(np.int64)]
        return np.where(count == 0, self.unknown, np.where(count <= K, d, 1.0) * c / (self.tokens + 0.5))

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def _tokenise(texts, batch):
    words, train = chunks.vocabulary(), np.array(batch.column(2).to_pylist(), dtype=np.uint8)
    words[END]
    seqs = [chunks.numbers(words, [*t.translate(LOWER_ASCII).split(), END]) for t in texts]
    weight = np.zeros(len(words), dtype=np.uint32)
    for s, t in zip(seqs, train.tolist()):
        if t:
            weight += np.bincount(s, minlength=len(words)).astype(np.uint32)
    return list(words), seqs, weight, train


def _count_words(rows):
    """Per bucket: each chunk's words' ids (uint64) and counts; then chunk -1: counts of counts, sums."""

    def settle(bucket, held):
        index, total = {}, []
        places = []
        for chunk, a, b, c in held:
            own = chunks.words_of(a, b)
            at = np.fromiter((index.setdefault(w, len(index)) for w in own), dtype=np.int64, count=len(own))
            total.append((at, unpacked(c, "<u4")))
            places.append((chunk, at))
        count = np.zeros(len(index), dtype=np.int64)
        for at, n in total:
            count[at] += n
        for chunk, at in places:
            yield chunk, bucket, packed(planes(((U64(bucket) << U64(32)) + at.astype(U64)).astype("<u8"))), packed(planes(count[at].astype("<u8"))), None
        n = np.bincount(np.minimum(count, K + 2), minlength=K + 3)
        yield -1, bucket, packed(np.r_[n, count.sum(), (count > 0).sum()].astype("<i8")), None, None

    at, held = None, []
    for chunk, bucket, a, b, c in rows:
        if bucket != at and held:
            yield from settle(at, held)
            held = []
        at = bucket
        held.append((chunk, a, b, c))
    if held:
        yield from settle(at, held)


class Level:
    """Distinct n-grams of a chunk, by their context and last word.

    ``at`` is each position's n-gram, ``before`` its context; ``context`` and ``word`` are each
    n-gram's. ``ids`` are the contexts' words (an array for each place in the context). The
    last context is that before the first word. What the table gives back is set by ``answered``.
    """

    def __init__(self, context: np.ndarray, ids: list[np.ndarray], count: np.ndarray, asked: np.ndarray, w: np.ndarray):
        self.ids, self.count, self.context_asked, self.before = ids, count, asked, context
        key, at = np.unique((context.astype(np.int64) << 32) | w, return_inverse=True)
        self.at = at.astype(np.int32)
        self.context, self.word = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)

    def route(self, tokens: int, home: np.ndarray, buckets: int) -> None:
        """Which n-grams go to which bucket: ``sent`` in bucket order, ``bounds`` of each bucket in it."""
        key = np.zeros(len(self.count), dtype=U64)
        for x in self.ids:
            key = fmix64((key * U64(31)) ^ (x + U64(1)))
        own = (key % U64(buckets)).astype(np.int64)
        self.hot = self.count * HOT >= tokens
        self.hot[-1] = True
        # no text that is learned has the context, or one has it once and no other asks
        self.settled = (self.count == 0) | ((self.count == 1) & ~self.context_asked)
        to = np.where(self.hot[self.context], (own[self.context] + home[self.word]) % buckets, own[self.context])
        at = np.flatnonzero(~self.settled[self.context])
        self.sent = at[np.argsort(to[at], kind="stable")]
        self.bounds = np.searchsorted(to[self.sent], np.arange(buckets + 1))

    def answered(self, found: list, discount: np.ndarray, hot: dict) -> None:
        """``r`` and ``asked`` of each n-gram; ``weight``, the logarithm of the context's weight, where it is
        needed (and the answers have the sums for it)."""
        self.r, self.asked, self.weight = self.count[self.context], np.zeros(len(self.word), bool), np.zeros(len(self.word))
        for k, (a, b, c) in zip(np.flatnonzero(np.diff(self.bounds)).tolist(), found, strict=True):
            mine = self.sent[self.bounds[k]:self.bounds[k + 1]]
            raw = unpacked(a)
            n = len(mine)
            self.r[mine] = from_planes(raw[:4 * n], "<u4")
            self.asked[mine] = np.frombuffer(raw, np.uint8, n, 4 * n) > 0
            if b is None:
                continue
            back = mine[(self.r[mine] == 0) & (self.count[self.context[mine]] > 0)]
            stats = np.ascontiguousarray(from_planes(unpacked(c), "<f8").reshape(K + 1, -1).T)
            which = from_planes(unpacked(b), "<u4")
            if not len(back):
                continue
            stats, context = stats[which].copy(), self.context[back]
            for i in np.flatnonzero(self.hot[context]).tolist():
                stats[i] = hot[tuple(int(x[context[i]]) for x in self.ids)]
            left = stats[:, :K] @ ((1 - discount[1:]) * np.arange(1, K + 1)) + 0.5
            self.weight[back] = np.log10(left / (self.count[context] + 0.5)) - np.log10(1 - stats[:, K])


class Chunk:
    """A chunk's texts as positions with their word, and the levels of their n-grams so far."""

    def __init__(self, lengths, numbers, train, found: list, model: Unigrams, texts: int, buckets: int):
        own = [f for f in found if f[2] is None]
        self.rest = [f for f in found if f[2] is not None]
        self.word = np.concatenate([from_planes(unpacked(a), "<u8") for a, _, _ in own])
        self.count = np.concatenate([from_planes(unpacked(b), "<u8") for _, b, _ in own]).astype(np.int64)
        self.lengths, self.w = lengths, numbers.astype(np.int64)
        self.train = np.frombuffer(train, dtype=np.uint8)
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.learned = self.train[self.doc] > 0
        self.first = np.r_[True, self.doc[1:] != self.doc[:-1]]
        self.end = self.w[-1]  # the number of the token after the last word
        self.model, self.texts, self.buckets, self.last = model, texts, buckets, None
        self.home = (fmix64(self.word + U64(1)) % U64(buckets)).astype(np.int64)

    def below(self) -> tuple[np.ndarray, np.ndarray]:
        """At each position: the count of the longest n-gram so far, and of its context."""
        if not self.last:
            return self.count[self.w], np.full(len(self.w), self.model.tokens)
        return self.last.r[self.last.at], self.last.count[self.last.before]

    def next_level(self) -> Level:
        if last := self.last:
            at, count, asked = last.at, last.r, last.asked
            ids = [*(x[last.context] for x in last.ids), self.word[last.word]]
        else:
            at, count, asked, ids = self.w, self.count, np.ones(len(self.count), bool), [self.word]
        before = np.where(self.first, len(count), np.r_[len(count), at[:-1]]).astype(np.int32)
        level = Level(before, [np.r_[x, U64(_START)] for x in ids], np.r_[count, self.texts], np.r_[asked, True], self.w)
        level.route(self.model.tokens, self.home, self.buckets)
        return level

    def climb(self, discounts: list[np.ndarray], hots: list[dict]) -> Iterator[Level]:
        """The levels that are there, with their answers; only the last one is kept."""
        at = 0
        for discount, hot in zip(discounts, hots, strict=True):
            level = self.next_level()
            n = int((np.diff(level.bounds) > 0).sum())
            level.answered(self.rest[at:at + n], discount, hot)
            at += n
            self.last = level
            yield level


def _deal(chunk, c: Chunk):
    """A chunk's distinct n-grams of the next level, a row (bucket, arrays) for each context bucket;
    and a row without arrays with the counts of counts of those that stay here."""
    level = c.next_level()
    n = np.bincount((level.count * level.settled)[level.context], minlength=K + 3)
    n[0] = 0
    yield chunk, chunk % c.buckets, None, None, packed(n.astype("<i8")), None
    times = np.bincount(level.at, weights=c.learned, minlength=len(level.word)).astype("<u4")
    # the context is wanted at the next level too; what ends a text is no context
    asked = (np.bincount(level.at, weights=~c.learned, minlength=len(level.word)) > 0) | (level.word == c.end)
    place = _one(level.at, len(level.word))
    lower, lower_context = (x[place] for x in c.below())
    for k in np.flatnonzero(np.diff(level.bounds)).tolist():
        at = level.sent[level.bounds[k]:level.bounds[k + 1]]
        h, ih = np.unique(level.context[at], return_inverse=True)
        one = _one(ih, len(h))
        ids, index = np.unique(np.concatenate([*(x[h] for x in level.ids), c.word[level.word[at]]]), return_inverse=True)
        index = index.astype("<u4")
        places = [index[i * len(h):(i + 1) * len(h)] for i in range(len(level.ids))]
        shorter = lower_context[at[one]].astype("<u8")
        if len(places) == 2:  # the shorter context is a word: once per word
            shorter, by_context = np.zeros(len(ids), "<u8"), shorter
            shorter[places[1]] = by_context
        arrays = [np.array([len(at), len(h), len(ids), len(places)], "<u4"), _steps(ih.astype("<u4")), index[len(h) * len(places):], times[at],
                  lower[at].astype("<u4"), asked[at].astype(np.uint8), level.count[h].astype("<u8"), shorter,
                  level.hot[h].astype(np.uint8), _steps(ids.astype("<u8")), *map(_steps, places)]
        yield chunk, k, None, packed(b"".join(planes(x) for x in arrays), 3), None, None


def _one(at: np.ndarray, n: int) -> np.ndarray:
    """A place of each number 0..n-1 in ``at``."""
    place = np.empty(n, dtype=np.int64)
    place[at] = np.arange(len(at))
    return place


def _steps(x: np.ndarray) -> np.ndarray:
    """From each number to the next (modulo 2 ** its bits): small where they mostly rise."""
    return np.diff(x, prepend=x.dtype.type(0))


def _read(blob: bytes) -> list[np.ndarray]:
    raw = unpacked(blob)
    out, at = [], 0

    def take(n: int, kind: str) -> np.ndarray:
        nonlocal at
        size = np.dtype(kind).itemsize
        x = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel()
        at += n * size
        return x

    n, h, words, places = take(4, "<u4").tolist()
    for size, kind in (*[(n, "<u4")] * 4, (n, "u1"), (h, "<u8"), (words if places == 2 else h, "<u8"), (h, "u1"), (words, "<u8"), *[(h, "<u4")] * places):
        out.append(take(size, kind))
    out = [np.cumsum(x, dtype=x.dtype) if k == 0 or k >= 8 else x for k, x in enumerate(out)]
    if places == 2:
        out[6] = out[6][out[10]]
    return out


def _table(bucket: int, held: list, below: Callable):
    """One bucket of a level's table: counts all its contexts' n-grams and answers each chunk.

    ``below(count, context's count)`` is the probability of an n-gram's last word after the shorter
    context, where the shorter n-gram was seen.
    """
    blobs = [_read(a) for _, a in held]
    size = [len(b[0]) for b in blobs]
    ids, word = np.unique(np.concatenate([b[8] for b in blobs]), return_inverse=True)
    word_at = np.cumsum([0, *[len(b[8]) for b in blobs]])
    h = np.zeros(sum(len(b[5]) for b in blobs), dtype=np.int64)
    for place in range(9, len(blobs[0])):
        h = np.unique((h << 32) | word[np.concatenate([word_at[i] + b[place] for i, b in enumerate(blobs)])], return_inverse=True)[1]
    n_h = int(h.max()) + 1
    one = _one(h, n_h)
    ch, lower_context, hot = (np.concatenate([b[k] for b in blobs])[one] for k in (5, 6, 7))
    h_at = np.cumsum([0, *[len(b[5]) for b in blobs]])
    key = np.concatenate([(h[h_at[i] + b[0]] << 32) | word[word_at[i] + b[1]] for i, b in enumerate(blobs)])
    order = np.argsort(key)
    new = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    count = np.add.reduceat(np.concatenate([b[2] for b in blobs])[order].astype(np.int64), new)
    wanted = np.maximum.reduceat(np.concatenate([b[4] for b in blobs])[order], new)
    lower = np.concatenate([b[3] for b in blobs])[order[new]].astype(np.int64)
    pair = np.empty(len(key), dtype=np.int64)
    pair[order] = np.repeat(np.arange(len(new)), np.diff(np.r_[new, len(key)]))
    ph = key[order[new]] >> 32
    del key, order, new
    stats, seen = np.zeros((n_h, K + 1)), count > 0
    for k in range(1, K + 1):
        stats[:, k - 1] = np.bincount(ph[count == k], minlength=n_h)
    stats[:, K] = np.bincount(ph[seen], weights=below(lower[seen], lower_context[ph[seen]]), minlength=n_h)
    n = np.bincount(np.minimum(count, K + 2), minlength=K + 3)
    at_hot = np.flatnonzero(hot)
    names = [ids[word[np.concatenate([word_at[i] + b[place] for i, b in enumerate(blobs)])[one[at_hot]]]] for place in range(9, len(blobs[0]))]
    yield -1, bucket, packed(n.astype("<i8")), packed(np.array(names, dtype="<u8")), packed(stats[at_hot])
    at = 0
    for (chunk, _), s in zip(held, size):
        mine = pair[at:at + s]
        at += s
        r = count[mine]
        u, which = np.unique(ph[mine][(r == 0) & (ch[ph[mine]] > 0)], return_inverse=True)
        yield chunk, bucket, packed(planes(r.astype("<u4")) + wanted[mine].tobytes()), packed(planes(which.astype("<u4"))), packed(planes(stats[u].T))


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where ``held_out`` is not true; contexts have up to ``order`` - 1 words.
    Null and empty texts are their end token alone. Repeated rows are counted and scored as often
    as they stand; with nothing to learn from, every token is the unknown word; an empty table
    gives an empty result.
    """
    buckets = chunks.bucket_count(docs)
    id_type = docs.schema[id_col].dataType.simpleString()
    columns = [F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), (~F.coalesce(held_out, F.lit(False))).alias("train")]
    rows = chunks.chunked(docs, columns, id_type, _tokenise, buckets, "sequences", apart=True)
    words = stored(chunks.per_bucket(rows, _count_words, id_type), "unigrams", "none")
    sums = np.sum([np.zeros(K + 5, dtype=np.int64), *[unpacked(r["a"], "<i8") for r in words.filter("chunk = -1").select("a").collect()]], axis=0)
    model = Unigrams(sums[:K + 2], int(sums[K + 3]), int(sums[K + 4]))
    texts = docs.select(columns[2]).filter("train").count()

    kind = docs.sparkSession.createDataFrame([], docs.select(columns[0]).schema).toArrow().schema.field(0).type
    known, discounts, hots = words.filter("chunk >= 0"), [], []

    for level in range(2, order + 1):
        def deal(chunk, ids, lengths, numbers, train, found, discounts=tuple(discounts), hots=tuple(hots)):
            c = Chunk(lengths, numbers, train, found, model, texts, buckets)
            for _ in c.climb(discounts, hots):
                pass
            for row in _deal(chunk, c):
                yield chunks.batch_of(kind, [row])

        def below(count, context, discount=discounts[-1] if discounts else None):
            if discount is None:
                return model.prob(count)
            return np.where(count <= K, discount[np.minimum(count, K)], 1.0) * count / (context + 0.5)

        def table(batches, below=below):
            at, held = None, []

            def settle():
                for chunk, bucket, a, b, c in _table(at, held, below):
                    yield chunks.batch_of(kind, [(chunk, bucket, None, a, b, c)])

            for batch in batches:
                for i in range(batch.num_rows):
                    bucket = batch.column(1)[i].as_py()
                    if bucket != at and held:
                        yield from settle()
                        held = []
                    at = bucket
                    if batch.column(3)[i].is_valid:
                        held.append((batch.column(0)[i].as_py(), batch.column(3)[i].as_py()))
                    else:
                        yield chunks.batch_of(kind, [(-1, bucket, None, batch.column(4)[i].as_py(), packed(b""), packed(b""))])
            if held:
                yield from settle()

        counts = known.withColumn("b", F.when(F.col("c").isNull(), F.col("b"))).withColumn("c", F.when(F.col("c").isNotNull(), F.lit(b"")))
        grams = chunks.per_chunk(rows, counts, deal, chunks.SCHEMA.format(id=id_type))
        answers = stored(grams.repartition("bucket").sortWithinPartitions("bucket", "chunk")
                         .mapInArrow(table, chunks.SCHEMA.format(id=id_type)).drop("ids"), f"grams-{level}", "none")
        # counts of counts (a row per bucket and per chunk), and the sums of at most 257 hot contexts in each bucket
        n, hot = np.zeros(K + 3, dtype=np.int64), {}
        for r in answers.filter("chunk = -1").select("a", "b", "c").toLocalIterator():
            n += unpacked(r["a"], "<i8")
            for name, x in zip(unpacked(r["b"], "<u8").reshape(level - 1, -1).T.tolist(), unpacked(r["c"], "<f8").reshape(-1, K + 1)):
                hot[tuple(name)] = hot.get(tuple(name), 0) + x
        discounts.append(good_turing(n[:K + 2]))
        hots.append(hot)
        # a level's answers stand after those of the levels below
        known = known.unionByName(answers.filter("chunk >= 0").withColumn("bucket", (F.col("bucket") + (level - 1) * buckets).cast("int")))

    def finish(chunk, ids, lengths, numbers, train, found):
        c = Chunk(lengths, numbers, train, found, model, texts, buckets)
        logs = np.log10(model.prob(c.count))[c.w]
        for level, discount in zip(c.climb(discounts, hots), discounts, strict=True):
            r, context = level.r[level.at], level.count[level.before]
            seen = np.log10(np.where(r <= K, discount[np.minimum(r, K)], 1.0) * np.maximum(r, 1)) - np.log10(context + 0.5)
            logs = np.where(r > 0, seen, logs + level.weight[level.at])

        def per_text(x):
            return np.bincount(c.doc, weights=x, minlength=len(ids))

        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(c.train == 0), pa.array(lengths), pa.array(per_text((c.count > 0)[c.w]).astype(np.int64)),
             pa.array(np.full(len(ids), model.tokens)), pa.array(per_text(model.base(c.count)[c.w])), pa.array(per_text(logs))],
            [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return chunks.per_chunk(rows, known, finish, f"`{id_col}` {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                                 "base_score double, score double")
