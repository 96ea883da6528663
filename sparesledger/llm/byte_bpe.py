"""Byte-level BPE over distinct words, and decoding by the token-byte table.

Texts are cut into pre-tokens where they are read; their positions stay in the chunk, and each
chunk's distinct pre-tokens are shuffled by hash (see ``chunks``). A bucket encodes each
distinct pre-token once, sends the ids back to the chunks that have it, and there they are put
in order by position. Decoding looks the ids up in the vocabulary's table of token bytes.
The positions are as large as the texts, so they are not stored beside the distinct words: the
texts are read and cut a second time for them.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks

_L, _N, _S = rb"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", rb"0-9\xb2\xb3\xb9\xbc-\xbe", rb"\x09-\x0d\x20\x85\xa0"
#: The public pattern with the character classes spelled out for Latin-1, where bytes are code points.
_LATIN = re.compile(rb"'s|'t|'re|'ve|'m|'ll|'d| ?[" + _L + rb"]+| ?[" + _N + rb"]+| ?[^" + _S + _L + _N + rb"]+|["
                    + _S + rb"]+(?![^" + _S + rb"])|[" + _S + rb"]+")


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PreTokens:
    def __init__(self, pattern: str):
        self.any = regex.compile(pattern)
        # the byte pattern stands for this pattern only
        from public_tokenizers import PATTERN

        self.latin = _LATIN if pattern == PATTERN else None

    def __call__(self, texts: list[bytes], _=None):
        latin, other = chunks.vocabulary(), chunks.vocabulary()
        seqs, kinds = [], []
        for t in texts:
            try:
                plain = t.decode().encode("latin-1") if self.latin else None
            except UnicodeEncodeError:
                plain = None
            if plain is None:
                seqs.append(chunks.numbers(other, self.any.findall(t.decode())))
            else:
                seqs.append(chunks.numbers(latin, self.latin.findall(plain)))
            kinds.append(plain is None)
        words = [w.decode("latin-1").encode() for w in latin] + [w.encode() for w in other]
        seqs = [s + np.uint32(len(latin)) if k else s for s, k in zip(seqs, kinds)]
        return words, seqs, None, None


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_ids: bool = False) -> DataFrame:
    """One row per input row: id, n_tokens, ids_sha256, decoded_sha256 (and ids: array<int>).

    Each match of ``pattern`` is encoded by itself, without special tokens. A null or empty text
    has no tokens; repeated ids and rows are encoded like any others; an empty table gives an
    empty result. A pre-token of any length is one word. ``docs`` is evaluated twice: give a table
    (or a frame read from one), as other frames may be partitioned anew, which raises an error.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    cut: list[PreTokens] = []

    def tokenise(texts, batch):
        if not cut:
            cut.append(PreTokens(pattern))
        return cut[0](texts)

    rows = chunks.cut(docs, [F.col(f"`{id_col}`"), F.col(f"`{text_col}`")], id_type, tokenise, chunks.bucket_count(docs),
                      checked=True)

    def resolve(words_rows):
        import tiktoken

        model = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=load_ranks(ranks_path), special_tokens={})
        piece, known, at = model._core_bpe.encode_single_piece, {}, None
        for chunk, bucket, a, b, c in words_rows:
            if bucket != at:
                known, at = {}, bucket
            found = []
            for w in chunks.words_of(a, b):
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = piece(w)
                found.append(ids)
            yield (chunk, bucket, chunks.packed(np.fromiter((i for x in found for i in x), dtype="<u4")),
                   chunks.packed(np.array([len(x) for x in found], dtype="<u4")), c)

    table: list[tuple] = []

    def finish(_, ids, lengths, numbers, __, found):
        if not table:
            by_rank = sorted(load_ranks(ranks_path).items(), key=lambda x: x[1])
            size = np.zeros(by_rank[-1][1] + 1, dtype=np.int64)
            size[[r for _, r in by_rank]] = [len(w) for w, _ in by_rank]
            table.append((np.frombuffer(b"".join(w for w, _ in by_rank), dtype=np.uint8), np.cumsum(size) - size, size))
        data, start, size = table[0]
        flat = np.concatenate([chunks.unpacked(a, "<u4") for a, _, _ in found]) if found else np.zeros(0, "<u4")
        count = np.concatenate([chunks.unpacked(b, "<u4") for _, b, _ in found]).astype(np.int64) if found else np.zeros(0, np.int64)
        first = np.cumsum(count) - count
        ends = np.cumsum(lengths).tolist()
        n, sha, back, kept = [], [], [], []
        for s, e in zip([0, *ends[:-1]], ends):
            mine = numbers[s:e]
            tokens = chunks.ragged(flat, first[mine], count[mine])
            n.append(len(tokens))
            sha.append(hashlib.sha256(tokens.tobytes()).hexdigest())
            back.append(hashlib.sha256(chunks.ragged(data, start[tokens], size[tokens]).tobytes()).hexdigest())
            kept.append(tokens.astype(np.int32) if with_ids else None)
        out = [ids, pa.array(n, pa.int64()), pa.array(sha), pa.array(back)]
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            out.append(pa.array(kept, pa.list_(pa.int32())))
            names.append("ids")
        yield pa.RecordBatch.from_arrays(out, names)

    schema = f"`{id_col}` {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return chunks.per_chunk_again(rows, chunks.per_bucket(rows, resolve, id_type), finish, schema)
