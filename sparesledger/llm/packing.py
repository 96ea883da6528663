"""Best-fit packing of tokenised documents by large-item matching.

Documents are tokenised where they are read; what is packed is the histogram of piece lengths
(at most ``capacity`` entries), so the plan is global and its size depends on the capacity
alone. Pieces above a third of the capacity fit at most twice into a sequence: the largest is
matched with the largest that still fits beside it. Smaller pieces, in falling order, go to
the sequence with the least gap that holds them. The plan's records say "pieces of length L
with ranks r0.. go to sequences b0.., k in each, from this offset"; every piece finds its
place by its gapless rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import os
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_rows, gapless_rank, per_text, stored

CAPACITY = 2048
#: Latin-1 bytes of lower-case letters, and of the marks that may end a word.
_LETTERS = frozenset([*range(0x61, 0x7B), *range(0xE0, 0xF7), *range(0xF8, 0x100)])
_MARKS = b".,"


class WordIds:
    """Token ids of white-space-delimited words, as little-endian bytes (``width`` an id), by the
    tokenizers library.

    The tokenizer drops white space and never joins tokens across it, so a text's ids are its
    words' ids in turn. Words seen are remembered (up to ``limit``). A text in Latin-1 is
    lower-cased first; of a word that ends in a full stop or comma after a letter the mark is set
    apart, as the tokenizer's own pattern would, when the word is first seen, and a word of
    letters only goes straight to the BPE model.
    A text in which a special token may stand is left as it is: its words go to the tokenizer,
    which finds special tokens (in their own case only) as its defaults say.
    """

    def __init__(self, path: str, width: int = 4, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.code = {2: "H", 4: "I"}[width]
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.limit = self.tokenizer.model, limit
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.sign = os.path.commonprefix(self.special)  # what any special token begins with
        self.plain, self.other = {}, {}
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        hidden = [b for b in range(256) if b not in set(shown)]
        # byte-level BPE shows printable bytes as themselves and the others from U+0100 on
        self.chars = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}
        self.marks = {m: self._encoded(chr(m)) for m in _MARKS}

    def _encoded(self, word: str) -> bytes:
        return array(self.code, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def _latin(self, word: bytes) -> bytes:
        text = word.decode("latin-1")
        if not text.isalpha():
            return self._encoded(text)
        shown = text if word.isascii() else text.encode().decode("latin-1").translate(self.chars)
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _word(self, word: bytes, latin: bool) -> bytes:
        if not latin:
            return self._encoded(word.decode())
        if word[-1] in _MARKS and len(word) > 1 and word[-2] in _LETTERS:
            stem = word[:-1]
            return (self.plain.get(stem) or self._latin(stem)) + self.marks[word[-1]]
        return self._latin(word)

    def _join(self, words: list[bytes], known: dict, latin: bool) -> bytes:
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            pass
        if len(known) > self.limit:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self._word(w, latin)
        return b"".join(map(known.__getitem__, words))

    def text(self, text: bytes) -> bytes:
        if text.isascii():
            plain = text.lower()
        else:
            try:
                plain = text.decode().lower().encode("latin-1")
            except UnicodeEncodeError:
                return self._join(text.split(), self.other, False)
        if self.sign in plain and any(s in plain for s in self.special):
            return self._join(text.split(), self.other, False)
        return self._join(plain.split(), self.plain, True)


def id_width(path: str) -> int:
    """Bytes that hold any id of the tokenizer: 2 or 4."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_file(path).get_vocab(True).values(), default=0) < 1 << 16 else 4


def widened(ids: pa.Array, width: int) -> pa.Array:
    """A binary column of ids of ``width`` bytes as one of four bytes each."""
    if width == 4 or not len(ids):
        return ids
    _, offsets, values = ids.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[ids.offset:ids.offset + len(ids) + 1].astype(np.int64)
    wide = np.frombuffer(values, dtype=np.uint8)[at[0]:at[-1]].view("<u2").astype("<u4") if at[-1] > at[0] else np.zeros(0, "<u4")
    return binary_rows(wide.view(np.uint8), (at - at[0]) * 2)


def _pieces(ids: pa.Array, texts: list[bytes], words: list[WordIds], path: str, capacity: int, width: int) -> pa.RecordBatch:
    if not words:
        words.append(WordIds(path, width))
    row, piece, start, length, kept = [], [], [], [], []
    for i, t in enumerate(texts):
        tokens = words[0].text(t) + bytes(width)
        n = len(tokens) // width
        for k, s in enumerate(range(0, n, capacity)):
            e = min(n, s + capacity)
            row.append(i)
            piece.append(k)
            start.append(s)
            length.append(e - s)
            kept.append(tokens[width * s:width * e])
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
         pa.array(length, pa.int64()), pa.array(kept, pa.binary())], ["id", "piece", "start", "length", "ids"])


def plan_packing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Records (length, first rank, pieces, first bin, pieces per bin, offset) for a histogram."""
    left = {n: c for n, c in counts.items() if c > 0}
    records: list[tuple] = []
    gaps: dict[int, list] = {}  # gap -> [(first bin, bins)]
    used: dict[int, int] = dict.fromkeys(left, 0)
    bins = 0

    def put(length: int, n: int, first: int, each: int, offset: int) -> None:
        records.append((length, used[length], n, first, each, offset))
        used[length] += n
        left[length] -= n

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - a) - 1
        while at >= 0 and (left[large[at]] == 0 or (large[at] == a and left[a] < 2)):
            at -= 1
        if at < 0:
            n, gap = left[a], capacity - a
            put(a, n, bins, 1, 0)
        elif large[at] == a:
            n, gap = left[a] // 2, capacity - 2 * a
            put(a, 2 * n, bins, 2, 0)
        else:
            b = large[at]
            n, gap = min(left[a], left[b]), capacity - a - b
            put(a, n, bins, 1, 0)
            put(b, n, bins, 1, a)
        gaps.setdefault(gap, []).append((bins, n))
        bins += n
    order = sorted(gaps)

    def add(gap: int, first: int, n: int) -> None:
        if n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            at = bisect.bisect_left(order, s)
            if at < len(order):
                gap = order[at]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(at)
            else:
                gap, first, n = capacity, bins, -(-left[s] // (capacity // s))
                bins += n
            each = gap // s
            full = min(n, left[s] // each)
            if full:
                put(s, full * each, first, each, capacity - gap)
                add(gap - each * s, first, full)
            if full < n:
                rest = left[s]
                if rest:
                    put(s, rest, first + full, rest, capacity - gap)
                    add(gap - rest * s, first + full, 1)
                    add(gap, first + full + 1, n - full - 1)
                else:
                    add(gap, first + full, n - full)
    return np.array(records, dtype=np.int64).reshape(-1, 6)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset, ids.

    ``ids`` are the piece's token ids, four bytes each, little-endian, and ``ids_crc32`` their
    CRC32; a sequence is its pieces' ids in the order of ``offset``. A document is its ids, then
    id 0 (so a null or empty text is one token); only documents longer than ``capacity`` are cut. Null and repeated ids and repeated rows are packed like
    any others; an empty table gives an empty result.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    words: list[WordIds] = []
    width = id_width(tokenizer_path)  # on their way, ids take no more bytes than the vocabulary asks for
    pieces = stored(per_text(docs, id_col, text_col,
                             f"id {id_type}, piece int, start long, length long, ids binary",
                             _pieces, words, tokenizer_path, capacity, width), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    records = plan_packing(counts, capacity)
    records = records[np.lexsort((records[:, 1], records[:, 0]))]
    plan = docs.sparkSession.sparkContext.broadcast(records)  # its size depends on the capacity alone
    ranked = gapless_rank(pieces, "length", ["id", "piece", "start", "ids"], "rank", sum(counts.values()))

    def place(batches):
        r = plan.value
        span = np.int64(1) << 44
        keys = r[:, 0] * span + r[:, 1]
        for batch in batches:
            table = {c: batch.column(c) for c in batch.schema.names}
            length, rank = (table[c].to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = r[np.searchsorted(keys, length * span + rank, side="right") - 1] if batch.num_rows else r[:0]
            bin_, inside = np.divmod(rank - at[:, 1], at[:, 4])
            yield pa.RecordBatch.from_arrays(
                [table["id"], table["piece"], table["start"], table["length"],
                 pa.array(at[:, 3] + bin_), pa.array(at[:, 5] + inside * length), widened(table["ids"], width)],
                [id_col, "piece", "start", "length", "sequence_id", "offset", "ids"])

    placed = ranked.mapInArrow(place, f"`{id_col}` {id_type}, piece int, start long, length long, sequence_id long, "
                                      "offset long, ids binary")
    return placed.select(F.col(f"`{id_col}`"), "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "sequence_id", "offset", "ids")
