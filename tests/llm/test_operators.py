"""Each operator against its brute-force version, over hand-made documents with nulls, empty and
long texts, ties, repeated rows, extra columns with clashing names, and over an empty table."""

from __future__ import annotations

import collections
import hashlib
import pathlib
import random
import re
import time
import zlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from sparesledger.llm import (byte_bpe, common, exact_dedup, fingerprints, katz_lm, language_id, near_dedup, packing, queries, sharding,
                              substring_dedup, suffix_dedup)
from sparesledger.llm.common import stored

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, id int, key string, row int"


def make_rows():
    rnd = random.Random(5)
    vocabulary = {"en": [f"{a}{b}" for a in "thesandor" for b in ("ing", "ed", "er")], "fr": [f"{a}é{b}" for a in "lmnpqr" for b in ("aux", "ou", "ère")]}
    sentence = lambda lang, n: " ".join(rnd.choice(vocabulary[lang]) + str(rnd.randint(0, 9)) * (rnd.random() < .6) for _ in range(n)) + "."
    passage = sentence("en", 60)
    docs = [None, "", " \n\t ", "word", "a b", "1234 ---", "x" * 3000, "is " * 400]
    for i in range(60):
        lang = rnd.choice(["en", "en", "fr"])
        docs.append("\n".join(sentence(lang, rnd.randint(3, 30)) for _ in range(rnd.randint(1, 5))))
    for i in range(12):  # exact, case and near copies; a shared passage
        base = docs[10 + i]
        docs += [base, base.upper() if i % 3 == 0 else base, " ".join(w if rnd.random() > .02 else "zz" for w in base.split()),
                 sentence("en", 9) + " " + passage + " " + sentence("en", 7)]
    docs.append(" ".join(sentence("en", 20) for _ in range(150)))
    langs = ["fr" if t and "é" in t else "en" for t in docs]
    return [(i, t, lang, "s", len(t or ""), "k", 1, "c", 2) for i, (t, lang) in enumerate(zip(docs, langs))]


ROWS = make_rows()
DOCS = [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and rows that stand twice."""
    text = " ".join(f"w{i}" for i in range(80))
    return spark.createDataFrame([(None, text, None), (None, "b", "en"), (5, text, "en"), (5, text, "en"), (6, text + " z", None), (7, None, None)],
                                 "doc_id long, text string, lang string")


RUNS = {
    "near": lambda d: near_dedup.components(d, words=3, percent=85),
    "language": lambda d: language_id.identify(d, d, P.path("piece_bpe_32k.model")),
    "fingerprints": fingerprints.fingerprints,
    "bpe": lambda d: byte_bpe.encode(d, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
    "katz": lambda d: katz_lm.score(d, language_id.fold("doc_id") == 1),
    "packing": lambda d: packing.pack(d, P.path("word_bpe_49k.json")),
    "substring": substring_dedup.repeated_words,
    "exact": exact_dedup.copies,
    "suffix": suffix_dedup.repeated_bytes,
    "sharding": lambda d: sharding.shard_rows(d, 40),
}


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(empty, name):
    assert RUNS[name](empty).count() == 0


@pytest.mark.parametrize("name", RUNS)
def test_null_ids_and_repeated_rows(odd, name):
    assert RUNS[name](odd).count() == 6


def test_near(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in RUNS["near"](docs).collect()}
    assert got == brute.op1(DOCS)
    assert near_dedup.drop_near_copies(docs).columns == docs.columns


def test_near_copies_go_by_row(spark):
    """One row of each component stays, whatever ids are null or repeated; unlinked rows all stay."""
    text = lambda k: " ".join(f"{k}w{i}" for i in range(80))
    rows = [(1, text("a")), (None, text("a") + " z"),  # a null id linked to an id,
            (None, text("b")), (None, text("c")), (None, ""), (None, ""),  # unlinked null ids,
            (None, text("d")), (None, text("d") + " z"),  # a component of null ids,
            (5, text("e")), (5, text("e") + " z"), (5, text("f")),  # one of a single id, and an unlinked text of that id,
            (4, text("g")), (5, text("g") + " z"),
            (7, text("h")), (7, text("h")), (8, text("h") + " z")]  # rows alike
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    left = collections.Counter((r.doc_id, (r.text[:1] or "-") + ("" if r.doc_id else "?")) for r in near_dedup.drop_near_copies(docs).collect())
    assert left == {(1, "a"): 1, (None, "b?"): 1, (None, "c?"): 1, (None, "-?"): 2, (None, "d?"): 1, (5, "e"): 1, (5, "f"): 1, (4, "g"): 1, (7, "h"): 1}
    got = near_dedup.components(docs).collect()
    assert len(got) == len(rows) and sum(r.kept for r in got) == sum(left.values())


def test_language_stage_judges_each_row(spark):
    rows = [(None, "the thing is here", "en"), (None, "1234 ---", "en"), (3, "the other thing", "en"), (3, "...", "en"), (3, "the other thing", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    left = language_id.keep_identified(docs, P.path("piece_bpe_32k.model"))
    assert sorted(r.text for r in left.collect()) == ["the other thing"] * 2 + ["the thing is here"]


def test_language(docs):
    got = {r.doc_id: r for r in RUNS["language"](docs).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == got[5].lang_pred == "und"
    right = [got[r[0]].lang_pred == r[2] for r in ROWS if got[r[0]].lang_pred != "und"]
    assert sum(right) >= 0.95 * len(right) and all(0 <= r.score <= 1 for r in got.values())


def test_forward_sums_all_segmentations():
    import numpy as np

    pieces = language_id.Pieces(P.path("piece_bpe_32k.model"))
    rnd = np.random.default_rng(1)
    prob = rnd.random((pieces.size, 2))
    prob /= prob.sum(axis=0)
    table = {pieces.model.id_to_piece(i): i for i in range(pieces.size) if not pieces.model.is_byte(i)}

    def total(word):
        if not word:
            return np.ones(2)
        out = np.zeros(2)
        for n in range(1, len(word) + 1):
            if word[:n] in table:
                out += prob[table[word[:n]]] * total(word[n:])
        if word[0] not in table:
            out += np.prod(prob[pieces.byte[list(word[0].encode())]], axis=0) * total(word[1:])
        return out

    words = ["the", "thing", "été", "a䷿b"]
    assert np.allclose(pieces.scores(words, prob), [np.log(total("▁" + w)) for w in words])


def test_forward_sums_words_of_any_length():
    """Against the full recursion in exact fractions of two: around the switch of methods and far beyond."""
    import math

    import numpy as np

    pieces = language_id.Pieces(P.path("piece_bpe_32k.model"))
    rnd, choose = np.random.default_rng(2), random.Random(3)
    prob = rnd.random((pieces.size, 3))
    prob /= prob.sum(axis=0)
    table = {pieces.model.id_to_piece(i): i for i in range(pieces.size) if not pieces.model.is_byte(i)}

    def total(word):
        """log P by the recursion from the left, each prefix's sum kept as (mantissa, exponent)."""
        out = []
        for lang in range(3):
            sums = [(0.5, 1)]
            for end in range(1, len(word) + 1):
                parts = []
                for start in range(max(0, end - pieces.longest), end):
                    text = word[start:end]
                    if text in table:
                        p = prob[table[text], lang]
                    elif end - start == 1:
                        p = float(np.prod(prob[pieces.byte[list(text.encode())], lang]))
                    else:
                        continue
                    m, e = math.frexp(sums[start][0] * p)
                    parts.append((m, e + sums[start][1]))
                top = max(e for _, e in parts)
                m, e = math.frexp(math.fsum(math.ldexp(m, e - top) for m, e in parts))
                sums.append((m, e + top))
            out.append(math.log(sums[-1][0]) + sums[-1][1] * math.log(2))
        return out

    words = ["thing" * 6 + "a", "thing" * 6 + "ab", "the" * 11, "internationalisation" * 30, "x" * 700, "été日ß" * 40, "日本語のテキスト" * 20, "a䷿b" * 50]
    words += ["".join(choose.choice("thesandorig") for _ in range(n)) for n in (29, 30, 31, 32, 33, 60, 60, 250)]
    assert np.allclose(pieces.scores(words, prob), [total("▁" + w) for w in words], rtol=1e-9)


def test_forward_follows_only_what_begins_a_piece(monkeypatch):
    """Every substring of a word up to the longest piece was looked up: over ten per character."""
    import numpy as np

    pieces, choose, looked_up = language_id.Pieces(P.path("piece_bpe_32k.model")), random.Random(4), []
    prob = np.random.default_rng(4).random((pieces.size, 2))
    prob /= prob.sum(axis=0)
    words = ["".join(choose.choice("thesandorig䷿é日") for _ in range(n)) for n in range(32) for _ in range(4)]
    alone = np.vstack([pieces.scores([w], prob) for w in words])
    find = pieces.find
    monkeypatch.setattr(pieces, "find", lambda h: looked_up.append(h.size) or find(h))
    assert (pieces.scores(words, prob) == alone).all()
    assert 0 < sum(looked_up) < 3 * sum(len(w) + 1 for w in words)
    monkeypatch.setattr(language_id, "CELLS", 100)
    assert (pieces.scores(words, prob) == alone).all()


def test_fingerprints(docs):
    pieces = lambda t: set(re.findall(r"[^.!?\n]{1,100}[.!?\n]*|[.!?\n]+", t))
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got, texts = {r.doc_id: r for r in RUNS["fingerprints"](docs).collect()}, [t or "" for _, t in DOCS]
    for i, t in enumerate(texts):
        nxt, m = texts[(i + 1) % len(texts)], len(t) // 4
        edited = t[:len(t) - m] + nxt[:m]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert got[i].near_edited == pytest.approx(like(pieces(t), pieces(edited)))
        assert got[i].near_next == pytest.approx(like(pieces(t), pieces(nxt)))
    assert len({(texts[i], r.fingerprint) for i, r in got.items()}) == len(set(texts))


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """op3 held the shuffles of all its tables at once."""
    dirs = [str(d) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {str(f) for d in dirs for f in pathlib.Path(d).rglob("shuffle_*.data")}

    rows = spark.range(5000).withColumn("key", F.col("id") % 7)
    before, setting = files(), spark.conf.get(common.CLEAN_SHUFFLES)
    tables = [stored(rows.repartition("key").sortWithinPartitions("id"), f"shuffled-{k}") for k in range(3)]
    for _ in range(50):  # Spark removes them in the background
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert [t.count() for t in tables] == [5000] * 3 and spark.conf.get(common.CLEAN_SHUFFLES) == setting


def test_bpe(docs, spark):
    import tiktoken

    path, rnd = P.path("byte_bpe_multi_50k.tiktoken"), random.Random(2)
    model = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=byte_bpe.load_ranks(path), special_tokens={})
    letters = " \n\t\x1c\x85\xa0\r'sdrtvelmab.,!?é²½ºªµ1234_œ日ß "
    texts = [*DOCS, *((1000 + i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))) for i in range(500))]
    got = {r.doc_id: tuple(r)[1:] for r in RUNS["bpe"](spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    for i, t in texts:
        ids = model.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                          hashlib.sha256((t or "").encode()).hexdigest())


def test_katz(docs):
    got, want = {r.doc_id: tuple(r)[1:] for r in RUNS["katz"](docs).collect()}, brute.op5(DOCS)
    for i, w in want.items():
        assert got[i][:4] == w[:4] and got[i][4:] == pytest.approx(w[4:])


@pytest.mark.parametrize("order", [1, 3, 4])
def test_katz_of_any_order(docs, order):
    got, want = {r.doc_id: r.score for r in katz_lm.score(docs, language_id.fold("doc_id") == 1, order=order).collect()}, brute.katz(DOCS, order)
    assert got == pytest.approx(want)


def test_katz_query_backs_off_from_trigrams(spark, scratch):
    spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3).write.parquet(f"{scratch}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in queries.op5_katz_scoring(spark, scratch).collect()}
    scores, figures = brute.katz(DOCS, 3), brute.op5(DOCS)
    assert {i: r[5] for i, r in got.items()} == pytest.approx(scores)
    for i, r in got.items():
        assert r[:4] == figures[i][:4] and r[4] == pytest.approx(figures[i][4])


def test_katz_chunks_of_many_words_are_small_on_disk(spark):
    """Numbers of four bytes and doubles were packed as they stand; results are the same in planes of bytes."""
    import numpy as np

    from sparesledger.llm import chunks

    rnd = np.random.default_rng(5)
    for x in (np.arange(7, dtype="<u8") << 33, np.zeros(0, "<u4"), rnd.random((3, 4)).T):
        assert (chunks.from_planes(chunks.planes(x), x.dtype).reshape(x.shape) == x).all()
    numbers = rnd.zipf(1.3, 150_000).clip(1, 70_000)
    text = " ".join([*(f"w{i}" for i in range(70_000)), *(f"w{i}" for i in numbers)])
    docs = spark.createDataFrame([(1, text), (2, "w1 w2 w3"), (3, None)], "doc_id long, text string").coalesce(1)

    def sequences(apart):
        rows = chunks.cut(docs, [F.col("doc_id"), F.col("text"), F.lit(True)], "bigint", katz_lm._tokenise, 3, apart=apart)
        return [chunks.sequences(r.a, r.b) + (len(r.b),) for r in rows.filter("bucket < 0").collect()]

    (sizes, plain, before), = sequences(False)
    (lengths, found, after), = sequences(True)
    assert lengths.tolist() == sizes.tolist() == [220_001, 4, 1] and (found == plain).all()
    assert after < 0.9 * before

    words = [b"w%d" % i for i in range(2000)]
    held = (b"".join(words), np.array([len(w) for w in words], "<u4"), rnd.integers(0, 3, 2000).astype("<u4"))
    rows = list(katz_lm._count_words((0, bucket, *map(chunks.packed, arrays)) for bucket, arrays in [(5, held)]))
    ids = (np.uint64(5) << np.uint64(32)) + np.arange(2000, dtype=np.uint64)
    assert (chunks.from_planes(chunks.unpacked(rows[0][2]), "<u8") == ids).all()
    assert len(rows[0][2]) < 0.5 * len(chunks.packed(ids))


def test_packing(docs):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    model.encode_special_tokens = True
    by, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in RUNS["packing"](docs).collect():
        by[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    total = 0
    for i, t in DOCS:
        ids = model.encode(t or "", add_special_tokens=False).ids + [0]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        total += len(ids)
        assert sorted(by[i]) == [(k, s, min(2048, len(ids) - s), zlib.crc32(raw[4 * s:4 * s + 8192])) for k, s in enumerate(range(0, len(ids), 2048))]
    for place in places.values():
        end = 0
        for offset, length in sorted(place):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(places) <= -(-total // 2048) + 1


def test_packed_sequences_hold_the_ids(spark):
    """The sequences' own ids, special tokens as the tokenizer's defaults have them."""
    from tokenizers import Tokenizer

    import numpy as np

    model = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    texts = ["plain words.", "a<|endoftext|>b", "<|startoftext|> Été, <|endoftext|>", "a<|ENDOFTEXT|>b <|EndOfText|>.",
             "a<|ENDOFTEXT|>b <|endoftext|>c", "日本<|endoftext|>語", "<|end oftext|>", "word " * 3000 + "<|endoftext|>", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = packing.pack(docs, P.path("word_bpe_49k.json")).collect()
    sequences = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == len(sequences[r.sequence_id]) and r.ids_crc32 == zlib.crc32(r.ids)
        sequences[r.sequence_id] += np.frombuffer(r.ids, "<u4").tolist()
    for i, t in enumerate(texts):
        got = [x for r in sorted(rows, key=lambda r: r.start) if r.doc_id == i
               for x in sequences[r.sequence_id][r.offset:r.offset + r.length]]
        assert got == model.encode(t or "", add_special_tokens=False).ids + [0]


def test_ids_are_widened():
    import pyarrow as pa

    rows = [b"", b"\x01\x00\xff\xff", None, b"\x02\x00"]
    column = pa.array([b"\x09\x09", *rows], pa.binary()).slice(1)
    assert [x or b"" for x in packing.widened(column, 2).to_pylist()] == [b"", b"\x01\0\0\0\xff\xff\0\0", b"", b"\x02\0\0\0"]
    assert packing.widened(column, 4) is column and packing.id_width(P.path("word_bpe_49k.json")) == 2


def test_substring(docs):
    assert {r.doc_id: tuple(r)[1:] for r in RUNS["substring"](docs).collect()} == brute.op7(DOCS)
    left = {r.doc_id: r for r in substring_dedup.drop_repeated(docs).collect()}
    assert len(left) == len(DOCS) and all(r.n_chars == len(r.text or "") for r in left.values())


def test_suffix(docs):
    want = brute.op9(DOCS)
    assert {r.doc_id: tuple(r)[1:] for r in RUNS["suffix"](docs).collect()} == want
    split = suffix_dedup.repeated_bytes(docs, shard_bytes=1000)  # grams dealt over several shards
    assert {r.doc_id: tuple(r)[1:] for r in split.collect()} == want


def test_exact(docs):
    groups = collections.defaultdict(list)
    for i, t in DOCS:
        groups[hashlib.sha256((t or "").encode().translate(brute.LOW)).hexdigest()].append(i)
    want = {i: (max(g), len(g), i == max(g), h) for h, g in groups.items() for i in g}
    for share in (1 / 256, 0.5):  # with and without winners
        assert {r.doc_id: tuple(r)[1:] for r in exact_dedup.copies(docs, share=share).collect()} == want
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups)


def test_exact_copies_go_by_id_and_text(spark):
    """Repeated and null ids that hold different texts, of which each id wins once."""
    rows = [(None, "n"), (None, "m"), (500, "M")]
    for i in range(30):
        rows += [(i, f"a {i}"), (i, f"b {i}"), (100 + i, f"B {i}")][::1 if i % 2 else -1]
    rows += [(900, "twice"), (900, "TWICE")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string")
    left = collections.Counter((r.doc_id, r.text.lower()) for r in exact_dedup.drop_copies(docs).collect())
    want = {(None, "n"), (500, "m"), (900, "twice")}
    want |= {(i, f"a {i}") for i in range(30)} | {(100 + i, f"b {i}") for i in range(30)}
    assert left == collections.Counter(want)


def test_sharding(docs):
    keys = {r[0]: r[1] for r in docs.select("doc_id", F.xxhash64("doc_id")).collect()}
    slots = collections.defaultdict(list)
    texts = dict(DOCS)
    for r in RUNS["sharding"](docs).collect():
        raw = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.shard, r.grown_shard) == (
            len(raw) + 16, zlib.crc32(raw), brute.jump(keys[r.doc_id], 40), brute.jump(keys[r.doc_id], 41))
        assert r.grown_shard in (r.shard, 40)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pipeline(spark, docs):
    import corpus_pipeline

    stage = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    one = stage["language"](spark, docs, "")
    texts = {r.doc_id: r.text for r in one.collect()}
    assert one.columns == docs.columns and not {0, 1, 2, 5} & set(texts) and {3, 6, 10} <= set(texts)
    two = {r.doc_id for r in stage["exact_dedup"](spark, one, "").collect()}
    best = {}
    for i, t in texts.items():
        best[t.encode().translate(brute.LOW)] = max(i, best.get(t.encode().translate(brute.LOW), i))
    assert two == set(best.values())
    left = one.filter(F.col("doc_id").isin(*two))
    three = {r.doc_id for r in stage["near_dedup"](spark, left, "").collect()}
    assert three == {i for i, v in brute.op1([(i, texts[i]) for i in two], 5, 80).items() if v[2]}
    four = {r.doc_id: r.text for r in stage["substring_dedup"](spark, left, "").collect()}
    for i, (n, removed, sha) in brute.op7([(i, texts[i]) for i in two]).items():
        assert four[i] == texts[i] if not removed else hashlib.sha256(four[i].encode()).hexdigest() == sha
    assert stage["packing"](spark, left, "").count() >= len(two)


def test_a_passage_in_a_third_of_the_documents(spark):
    """One hot passage, whose anchors a third of all texts have, beside ordinary ones; no table is left."""
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    passage = " ".join(word() for _ in range(70))
    texts = []
    for i in range(240):
        own = " ".join(word() for _ in range(rnd.randint(5, 60)))
        texts.append((i, f"{own} {passage} {word()}" if i % 3 == 0 else own))
    texts += [(300 + i, texts[i + 1][1]) for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    before = {t.name for t in spark.catalog.listTables()}
    assert {r.doc_id: tuple(r)[1:] for r in RUNS["substring"](docs).collect()} == brute.op7(texts)
    assert {r.doc_id: tuple(r)[1:] for r in RUNS["suffix"](docs).collect()} == brute.op9(texts)
    assert {t.name for t in spark.catalog.listTables()} == before
