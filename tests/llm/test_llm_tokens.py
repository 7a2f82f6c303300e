"""Byte-level merges, packing and n-gram scores against the public libraries and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN, path
from tokenizers import Tokenizer

import corpus_pipeline
from windrow.llm import byte_bpe, interpolation, packing, words
from windrow.llm.queries import QUERIES

RANKS = path("byte_bpe_50k.tiktoken")
WORDS = path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def word_library():
    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    return tokenizer


TEXTS = st.text(st.sampled_from("abcdefghit THE'sré ñß̸́\n\t\x1c\x85\xa0　😀,.!=<1239Σİ\0"), max_size=200)


def split(flat, at):
    return [flat[a:b] for a, b in zip(at, at[1:], strict=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_merges(library, texts):
    table = byte_bpe.merges(RANKS, PATTERN)
    ids, at = table.encode(texts)
    assert [x.tolist() for x in split(ids, at)] == [library.encode_ordinary(t) for t in texts]
    assert [x.tobytes() for x in split(*table.decode(ids, at))] == [t.encode() for t in texts]


def test_decode_in_steps(library, monkeypatch):
    """Texts are decoded in runs of bounded numbers of ids, a longer one in steps."""
    assert list(byte_bpe.runs(np.array([0, 3, 3, 10, 11]), 4)) == [(0, 2), (2, 3), (3, 4)]
    assert list(byte_bpe.runs(np.array([7]), 4)) == [] and list(byte_bpe.runs(np.array([5, 5, 5]), 4)) == [(0, 2)]
    monkeypatch.setattr(byte_bpe, "DECODED", 7)
    table = byte_bpe.merges(RANKS, PATTERN)
    texts = ["", "a longer text of some words " * 9, "", "é1", ""]
    assert [x.tobytes().decode() for x in split(*table.decode(*table.encode(texts)))] == texts


def test_long_pieces(library):
    table = byte_bpe.merges(RANKS, PATTERN)
    random_ = random.Random(2)
    for n in (63, 64, 65, 1000, 20_000):
        piece = "".join(random_.choice("abcdelnorst") for _ in range(n))
        assert table.encode([piece])[0].tolist() == library.encode_ordinary(piece)
        assert table.merge_one(piece.encode()) == library.encode_ordinary(piece)


def test_encode_odd(spark, odd_docs, no_docs, library, rows_of):
    got = byte_bpe.decode(byte_bpe.encode(odd_docs, RANKS, PATTERN), RANKS, PATTERN)
    want = [(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in odd_docs.select("doc_id", "text").collect()]
    found = [(r.doc_id, list(r.ids), bytes(r.data)) for r in got.collect()]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(found, key=order) == sorted(want, key=order)
    assert byte_bpe.encode(no_docs, RANKS, PATTERN).count() == 0


def test_encode_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = QUERIES["op5_byte_bpe"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, min_size=1, max_size=4))
def test_word_ids(word_library, texts):
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.word_ids(WORDS).encode([t.encode() for t in texts])]
    assert got == [e.ids for e in word_library.encode_batch(texts, add_special_tokens=False)]


SPECIALS = st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "It's", "x", "É", "\u0301", "Σ", "!.", " ", "\n", "\x01"]), max_size=20).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(SPECIALS | TEXTS, min_size=1, max_size=4))
def test_word_ids_special(texts):
    """Ids with special tokens are those of the library's plain call."""
    got = [np.frombuffer(x, "<u4").tolist() for x in packing.word_ids(WORDS, special=True).encode([t.encode() for t in texts])]
    assert got == [e.ids for e in Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)]


def test_pack_special(spark, tmp_path):
    """The query and the stage of the pipeline count and sum the ids of the library's plain call."""
    texts = ["it's <|endoftext|> x", "<|startoftext|>a<|endoftext|>. <|ENDOFTEXT|>", "no such string."]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    library = Tokenizer.from_file(WORDS)
    want = {i: [*library.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert want[0] == [585, 568, 49407, 343, 1]
    staged = corpus_pipeline.pack(spark, spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path))
    for rows in (QUERIES["op7_packing"](spark, str(tmp_path)).collect(), staged.collect()):
        assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {i: (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in want.items()}


def fits(rows, capacity):
    """Every sequence is filled from 0 without gaps and holds at most ``capacity``."""
    bins = defaultdict(list)
    for length, sequence, offset in rows:
        bins[sequence].append((offset, length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_pack_odd(odd_docs, no_docs, word_library):
    rows = packing.pack_documents(odd_docs, WORDS).collect()
    want = Counter()
    for r in odd_docs.select("doc_id", "text").collect():
        ids = [*word_library.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            want[r.doc_id, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    fits([(r.length, r.sequence_id, r.offset) for r in rows], 4096)
    assert packing.pack_documents(no_docs, WORDS).count() == 0


def test_pack_query(spark, word_library):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").collect()
    total = sum(len(word_library.encode(t, add_special_tokens=False).ids) + 1 for t in docs.values())
    assert sum(r.length for r in rows) == total
    assert fits([(r.length, r.sequence_id, r.offset) for r in rows], 4096) <= -(-total // 4096) + 2


@pytest.mark.parametrize("part_rows", [50, 100_000])
@pytest.mark.parametrize("spread", [(1, 64), (20, 45), (33, 64), (64, 65)])
def test_pack_parts(spark, part_rows, spread):
    """Small parts exchange what leaves gaps; the result stays near the bound of the whole."""
    random_ = np.random.default_rng(spread[0])
    lengths = random_.integers(*spread, 600)
    items = spark.createDataFrame([(i, int(x)) for i, x in enumerate(lengths)], "item bigint, length bigint")
    rows = packing.pack(items, capacity=64, part_rows=part_rows).collect()
    assert sorted(r.item for r in rows) == list(range(600))
    n = fits([(int(lengths[r.item]), r.sequence_id, r.offset) for r in rows], 64)
    whole = packing.best_fit(np.sort(lengths)[::-1], 64).max() + 1
    assert packing.lower_bound(np.bincount(lengths, minlength=65), 64) <= n <= whole * 1.05 + 2


def test_bound_and_fit():
    """On small cases the bound is never above the best packing, and best-fit is what the definition says."""
    random_ = np.random.default_rng(3)

    def best(items, capacity):
        done = {tuple(): 0}
        bins = [len(items)]

        def place(k, rooms):
            if len(rooms) >= bins[0]:
                return
            if k == len(items):
                bins[0] = len(rooms)
                return
            for j in range(len(rooms)):
                if rooms[j] >= items[k]:
                    place(k + 1, (*rooms[:j], rooms[j] - items[k], *rooms[j + 1 :]))
            place(k + 1, (*rooms, capacity - items[k]))

        place(0, ())
        return bins[0] or done[()]

    for _ in range(60):
        capacity = int(random_.integers(5, 20))
        lengths = np.sort(random_.integers(1, capacity + 1, random_.integers(1, 8)))[::-1]
        counts = np.bincount(lengths, minlength=capacity + 1)
        assert packing.lower_bound(counts, capacity) <= best(lengths.tolist(), capacity)
        rooms, want = [], []
        for x in lengths.tolist():
            fitting = [(r, b) for b, r in enumerate(rooms) if r >= x]
            if fitting:
                room = min(fitting)[0]
                want.append(room)
                b = max(b for r, b in fitting if r == room)
                rooms[b] -= x
            else:
                want.append(capacity)
                rooms.append(capacity - x)
        got = packing.best_fit(lengths, capacity)
        assert sorted(np.bincount(got, lengths)) == sorted(capacity - r for r in rooms)


def test_word_keys():
    """Equal words have equal keys wherever they stand, different ones differ; texts part words."""
    import pyarrow as pa

    from windrow.llm.common import string_parts

    texts = ["ab c  AB\tc", "", "ab", "c\x0bab", None or "", "ébé ab\x1cb"]
    key, count = words.word_keys(*string_parts(pa.array(texts)))
    plain = [w for t in texts for w in re.findall("[^\x20\x09-\x0d]+", t.lower())]
    assert count.tolist() == [4, 0, 1, 2, 0, 2]
    assert len({(k, w) for k, w in zip(key.tolist(), plain, strict=True)}) == len(set(plain)) == len(set(key.tolist()))


def score_brute(rows, order, steps=interpolation.EM_STEPS):
    tokens = [[*re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), None] for _, t in rows]
    fold = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 for d, _ in rows]
    groups = {"learned": [t for t, f in zip(tokens, fold, strict=True) if f not in (2, 3)], "both": [t for t, f in zip(tokens, fold, strict=True) if f != 2]}

    def grams(text, n):
        padded = ["<s>"] * (n - 1) + text
        return [tuple(padded[i : i + n]) for i in range(len(text))]

    def model(texts):
        counts = [Counter(g for t in texts for g in grams(t, n)) for n in range(1, order + 1)]
        total, distinct = sum(counts[0].values()), len(counts[0])

        def parts(text):
            out = []
            every = [grams(text, n) for n in range(1, order + 1)]
            for i in range(len(text)):
                p = [1 / (distinct + 1), counts[0][(text[i],)] / max(total, 1)]
                context = total
                for n in range(2, order + 1):
                    if i == 0:
                        context = len(texts)
                    else:
                        context = counts[n - 2][every[n - 2][i - 1]]
                    p.append(counts[n - 1][every[n - 1][i]] / context if context else 0.0)
                out.append((min(int(context).bit_length(), interpolation.BUCKETS - 1), p))
            return out

        return parts, counts, total, distinct

    parts = model(groups["learned"])[0]
    weights = [[1 / (order + 1)] * (order + 1) for _ in range(interpolation.BUCKETS)]
    deleted = [x for t, f in zip(tokens, fold, strict=True) if f == 3 for x in parts(t)]
    for _ in range(steps):
        sums = defaultdict(lambda: [0.0] * (order + 1))
        for b, p in deleted:
            total = sum(w * x for w, x in zip(weights[b], p, strict=True))
            for k in range(order + 1):
                sums[b][k] += weights[b][k] * p[k] / total
        new = [list(w) for w in weights]
        for b, s in sums.items():
            new[b] = [x / sum(s) for x in s]
        moved = max(abs(x - y) for a, b in zip(new, weights, strict=True) for x, y in zip(a, b, strict=True))
        weights = new
        if moved < interpolation.EM_TOLERANCE:
            break
    seen = {b for b, _ in deleted}
    weights = [weights[min(seen, key=lambda s: (abs(s - b), s))] if seen and b not in seen else w for b, w in enumerate(weights)]
    parts, counts, total, distinct = model(groups["both"])
    out = []
    for (doc_id, _), text, f in zip(rows, tokens, fold, strict=True):
        known = sum((t,) in counts[0] for t in text)
        base = sum(math.log10((counts[0][(t,)] + 1) / (total + distinct + 1)) for t in text)
        score = sum(math.log10(sum(w * x for w, x in zip(weights[b], p, strict=True))) for b, p in parts(text))
        out.append((doc_id, f == 2, len(text), known, total, base, score))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(corpus, order):
    """Small blocks and buckets, so that counts meet from many blocks."""
    got = interpolation.interpolated_scores(corpus, order=order, block_tokens=2000, bucket_keys=500).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    want = score_brute([tuple(r) for r in corpus.collect()], order)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-8)


def test_scores_odd(odd_docs, no_docs):
    got = interpolation.interpolated_scores(odd_docs).collect()
    got = sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    want = score_brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()], 2)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-8)
    assert interpolation.interpolated_scores(no_docs).count() == 0


def test_scores_beat_base(spark):
    rows = QUERIES["op1_interpolation"](spark, "/root/testdata/sf0.01").filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.95
