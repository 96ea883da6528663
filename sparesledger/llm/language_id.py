"""Language identification by unigram pieces, marginalised over segmentations.

Training counts, for each language, the pieces of a fixed public vocabulary in the labelled
texts (all of them: counts are summed where they are read and shuffled as at most one row per
language and piece). A text's likelihood is the product over its words of the sum, over all
ways to cut the word into pieces, of the product of the pieces' probabilities; the forward
algorithm computes the sums, for many words of one length at a time, whatever the length. A character outside the
vocabulary is cut into the vocabulary's byte pieces.

The model has (pieces x languages) numbers: its size depends on the vocabulary and the number
of label values (a few hundred at most), never on the documents; it is collected and broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chunks
from .common import U64, as_bytes, fmix64, in_blocks, slices, stored

SHORT = 32  # code points of a word whose products stay within a double under one fixed scale;
SCALE = 1000.0  # that scale, per code point
CELLS = 1 << 19  # sums held at once for these words,
LONG_CELLS = 1 << 21  # numbers for longer ones
KNOWN = 100_000  # words whose scores a task remembers,
KNOWN_CHARS = 2_000_000  # and their code points together
_MIX = U64(0x9E3779B97F4A7C15)
_SLOTS = 20  # bits
_LETTER = re.compile(r"[A-Za-z]")


class Pieces:
    """The vocabulary's pieces by hash, for looking up many substrings at once."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m, self.size = self.model, self.model.get_piece_size()
        plain = [i for i in range(self.size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        texts = [m.id_to_piece(i) for i in plain]
        self.longest = max(map(len, texts))
        keys = np.zeros(len(texts), dtype=U64)
        #: By slot: 1 where a piece may be, 2 where the start of a longer one may be (never 0 where one is).
        self.there = np.zeros(1 << _SLOTS, dtype=np.uint8)
        size = np.array([len(t) for t in texts])
        for n in np.unique(size).tolist():
            at = np.flatnonzero(size == n)
            chars = np.frombuffer("".join(texts[i] for i in at.tolist()).encode("utf-32-le"), dtype="<u4").reshape(-1, n)
            h = np.zeros(len(at), dtype=U64)
            for j in range(n):
                h = fmix64(h * _MIX + chars[:, j].astype(U64))
                self.there[self._slot(h)] |= 1 if j == n - 1 else 2
            keys[at] = h
        self.byte = np.array([m.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        # two tables of slots: a key that finds its first slot taken goes to the second
        self.keys, self.ids = np.r_[keys, U64(0)], np.array([*plain, -1])
        self.first = np.full(1 << _SLOTS, len(plain), dtype=np.int32)
        self.second = np.full(1 << _SLOTS, len(plain), dtype=np.int32)
        self.rest = []
        for k, (s, t) in enumerate(zip(self._slot(keys).tolist(), self._slot(keys << U64(32)).tolist())):
            if self.first[s] == len(plain):
                self.first[s] = k
            elif self.second[t] == len(plain):
                self.second[t] = k
            else:
                self.rest.append(k)

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> U64(64 - _SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece ids of substring hashes (-1: none)."""
        a, b = self.first[self._slot(h)], self.second[self._slot(h << U64(32))]
        out = np.where(self.keys[a] == h, self.ids[a], np.where(self.keys[b] == h, self.ids[b], -1))
        for k in self.rest:
            out[h == self.keys[k]] = self.ids[k]
        return out

    def scores(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """log P(word) for each language: rows as ``words``, columns as ``prob``'s (pieces x languages)."""
        total = np.zeros((len(words), prob.shape[1]))
        texts = ["▁" + w for w in words]
        size = np.array([len(t) for t in texts], dtype=np.int64)
        short = np.flatnonzero(size <= SHORT)
        ends, step = np.cumsum(size[short]), max(SHORT, CELLS // prob.shape[1])
        x = 0
        while x < len(short):
            y = int(np.searchsorted(ends, (ends[x - 1] if x else 0) + step, side="right"))
            some = short[x:y]
            total[some] = self._forward("".join([texts[i] for i in some.tolist()]), size[some], prob)
            x = y
        long = np.flatnonzero(size > SHORT)
        padded = np.vstack([prob, np.zeros(prob.shape[1])]) if len(long) else prob  # row -1: no piece
        for n in np.unique(size[long]).tolist():
            at = np.flatnonzero(size == n)
            step = max(1, LONG_CELLS // (n * min(n, self.longest) * prob.shape[1]))
            for x in range(0, len(at), step):
                some = at[x:x + step]
                chars = np.frombuffer("".join(texts[i] for i in some.tolist()).encode("utf-32-le", "surrogatepass"),
                                      dtype="<u4").reshape(-1, n)
                total[some] = self._forward_long(chars, padded)
        return total

    def _in_bytes(self, code: int, prob: np.ndarray) -> np.ndarray:
        """The probability of a character cut into byte pieces."""
        return np.prod(prob[self.byte[list(chr(code).encode("utf-8", "surrogatepass"))]], axis=0)

    def _forward(self, text: str, size: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """The sums for words of ``size`` code points (SHORT at most) that stand one after the other in ``text``.

        All words go together, whatever their lengths: a substring is followed only while a piece
        begins with it, and the pieces found are summed up by their start in the word.
        """
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        wide, start = codes.astype(U64), chunks.runs(size)  # each character's place in its word
        left = np.repeat(size, size) - start
        at, h = np.arange(len(codes)), np.zeros(len(codes), dtype=U64)
        found = []
        for j in range(min(int(size.max()), self.longest)):
            h = fmix64(h * _MIX + wide[at + j])
            there = self.there[self._slot(h)]
            some = np.flatnonzero(there & 1)
            piece = self.find(h[some])
            if j == 0:
                whole = np.full(len(codes), -1, dtype=np.int64)
                whole[some] = piece
                bare = np.flatnonzero(whole < 0)
                if len(bare):  # characters outside the vocabulary
                    new, which = np.unique(codes[bare], return_inverse=True)
                    whole[bare] = len(prob) + which
                    spelled = np.vstack([self._in_bytes(c, prob) for c in new.tolist()])
                found.append((at, whole))
            else:
                some, piece = some[piece >= 0], piece[piece >= 0]
                found.append((at[some], piece))
            on = np.flatnonzero((there > 1) & (left[at] > j + 1))
            at, h = at[on], h[on]
        first, piece = (np.concatenate(x) for x in zip(*found))
        length = np.repeat(np.arange(1, len(found) + 1), [len(x) for x, _ in found])
        order = np.argsort(start[first].astype(np.int8), kind="stable")
        bounds = np.searchsorted(start[first[order]], np.arange(int(size.max()) + 1))
        scale = np.cumprod(np.full(len(found), SCALE))
        # a word's sums: one more than it has characters
        word = np.repeat(np.arange(len(size)), size)
        alpha = np.zeros((len(codes) + len(size), prob.shape[1]))
        alpha[np.cumsum(size + 1) - size - 1] = 1
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            some = order[a:b]
            n, source, own = length[some], first[some] + word[first[some]], piece[some]
            factor = prob[np.minimum(own, len(prob) - 1)]
            if len(bare):
                outside = np.flatnonzero(own >= len(prob))
                factor[outside] = spelled[own[outside] - len(prob)]
            alpha[source + n] += alpha[source] * factor * scale[n - 1, None]
        return np.log(np.maximum(alpha[np.cumsum(size + 1) - 1], 1e-300)) - size[:, None] * np.log(SCALE)

    def _forward_long(self, chars: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """The same sums for words of any length: only the last ``longest`` positions are carried, and
        they are rescaled as they shrink. ``before[:, k]`` is the sum k + 1 positions back."""
        rows, n = chars.shape
        wide, reach = chars.astype(U64), min(n, self.longest)
        piece = np.full((rows, n, reach), -1, dtype=np.int64)  # of start and length - 1
        h = np.zeros((rows, n), dtype=U64)
        for j in range(reach):
            h = fmix64(h[:, :n - j] * _MIX + wide[:, j:])
            piece[:, :n - j, j] = self.find(h)
        step = prob[piece]
        for r, i in np.argwhere(piece[:, :, 0] < 0).tolist():
            step[r, i, 0] = self._in_bytes(int(chars[r, i]), prob)
        back = np.arange(reach)
        before = np.zeros((rows, reach, prob.shape[1]))
        before[:, 0] = 1
        log = np.zeros((rows, 1))
        for end in range(1, n + 1):
            some = back[:end]  # pieces of 1 .. end characters that end here
            now = (before[:, some] * step[:, end - 1 - some, some]).sum(axis=1)
            before[:, 1:] = before[:, :-1].copy()
            before[:, 0] = now
            if end % 8 == 0:
                most = np.maximum(before.max(axis=(1, 2)), 1e-300)
                before /= most[:, None, None]
                log[:, 0] += np.log(most)
        return np.log(np.maximum(before[:, 0], 1e-300)) + log


@lru_cache(maxsize=1)
def _pieces(path: str) -> Pieces:
    """One vocabulary per Python worker, whatever the number of its tasks."""
    return Pieces(path)


def _lower(text: bytes) -> str:
    return text.decode().lower()


def blocks(beside: pa.Array, texts: pa.Array) -> Iterator[tuple[list, list[bytes]]]:
    """Values of ``beside`` and texts (null: empty), about a MB of text at a time."""
    for some, part in zip(slices(beside), slices(texts)):
        own, raw = some.to_pylist(), [t or b"" for t in as_bytes(part)]
        for x, y in in_blocks(raw, 1 << 20):
            yield own[x:y], raw[x:y]


def piece_counts(docs: DataFrame, lang_col: str, text_col: str, path: str) -> DataFrame:
    """Rows lang, piece, n over all rows with a label: the vocabulary's own cut of each word."""

    def run(batches):
        pieces, sums, known, held = _pieces(path), {}, {}, 0
        for batch in batches:
            for langs, texts in blocks(batch.column(0), batch.column(1)):
                words = chunks.vocabulary()
                count: dict = {}
                for lang, t in zip(langs, texts):
                    count.setdefault(lang, []).append(chunks.numbers(words, _lower(t).split()))
                new = [w for w in words if w not in known]
                if known and (len(known) + len(new) > KNOWN or held > KNOWN_CHARS):
                    known.clear()
                    new, held = list(words), 0
                held += sum(map(len, new))
                for w, ids in zip(new, pieces.model.encode(new, num_threads=1)):
                    known[w] = ids
                cuts = [known[w] for w in words]
                flat = np.fromiter((i for c in cuts for i in c), dtype=np.int64)
                size = np.array([len(c) for c in cuts], dtype=np.int64)
                for lang, seqs in count.items():
                    n = np.bincount(np.concatenate(seqs), minlength=len(words))
                    if lang not in sums:
                        sums[lang] = np.zeros(pieces.size)
                    if len(flat):
                        sums[lang] += np.bincount(flat, weights=np.repeat(n, size), minlength=pieces.size)
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             ["lang", "piece", "n"])

    labelled = docs.filter(F.col(f"`{lang_col}`").isNotNull()).select(F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`"))
    return labelled.mapInArrow(run, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fold(id_col: str, parts: int = 5) -> Column:
    """crc32 of the id as text, modulo ``parts`` (a null id counts as an empty text)."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % parts


def _predictor(train: DataFrame, vocabulary: str, text_col: str, lang_col: str, smoothing: float):
    """The labels of ``train`` and a function that predicts (languages, posteriors) for each of many columns of texts."""
    counts = stored(piece_counts(train, lang_col, text_col, vocabulary), "piece-counts").collect()  # pieces x languages
    langs = sorted({r["lang"] for r in counts})
    at = {v: i for i, v in enumerate(langs)}
    size = _pieces(vocabulary).size
    prob = np.full((size, max(1, len(langs))), smoothing)
    for r in counts:
        prob[r["piece"], at[r["lang"]]] += r["n"]
    prob /= prob.sum(axis=0)
    model = train.sparkSession.sparkContext.broadcast(prob)
    prob_columns = prob.shape[1]

    def predict(columns):
        pieces, words, held = _pieces(vocabulary), chunks.vocabulary(), 0
        score = np.zeros((0, prob_columns))
        for column in columns:
            best, prec = [], []
            for _, texts in blocks(pa.nulls(len(column)), column):
                if len(words) > KNOWN or held > KNOWN_CHARS:
                    words, score, held = chunks.vocabulary(), np.zeros((0, prob_columns)), 0
                lower = [_lower(t) for t in texts]
                seqs = [chunks.numbers(words, t.split()) for t in lower]
                new = list(words)[len(score):]
                if new:
                    held += sum(map(len, new))
                    score = np.vstack([score, pieces.scores(new, model.value)])
                for t, s in zip(lower, seqs):
                    total = score[s].sum(axis=0)
                    letters = _LETTER.search(t) or any(c.isalpha() for c in set(t))
                    if not letters or not langs:
                        best.append("und")
                        prec.append(0.0)
                    else:
                        k = int(total.argmax())
                        best.append(langs[k])
                        prec.append(float(1 / np.exp(np.maximum(total - total[k], -700)).sum()))
            yield best, prec

    return langs, predict


def identify(docs: DataFrame, train: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", smoothing: float = 0.5) -> DataFrame:
    """One row per input row: id, lang_pred, score (the posterior of the predicted language).

    Learns from ``train``'s text and non-null label only. A null text or one without letters is
    ``und`` with score 0, as is every text if there is nothing to learn from. Ties go to the
    label first in order. Repeated ids and rows are predicted like any others.
    """
    _, predict = _predictor(train, vocabulary, text_col, lang_col, smoothing)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        ids = []

        def texts():
            for batch in batches:
                ids.append(batch.column(0))
                yield batch.column(1)

        for best, prec in predict(texts()):
            yield pa.RecordBatch.from_arrays([ids.pop(), pa.array(best, pa.string()), pa.array(prec, pa.float64())],
                                             [id_col, "lang_pred", "score"])

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(
        run, f"`{id_col}` {id_type}, lang_pred string, score double")


def keep_identified(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose predicted language has a posterior of at least ``least``.

    Texts without letters (``und``) go; where no row has a label there is no model and nothing
    else is rejected. All columns are kept, whatever their names. Each row is judged by its own
    text, whatever its id.
    """
    labelled = docs.filter(F.col(f"`{lang_col}`").isNotNull()).limit(1).count() > 0
    if not labelled:
        return docs
    _, predict = _predictor(docs, vocabulary, text_col, lang_col, 0.5)

    def good(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for best, prec in predict(columns):
            yield pa.array([b != "und" and p >= least for b, p in zip(best, prec)], pa.bool_())

    return docs.filter(F.arrow_udf(good, "boolean")(F.col(f"`{text_col}`")))
