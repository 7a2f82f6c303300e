"""Exact duplicates, SimHash components, vector links and connected components against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from windrow.llm import collisions, exact_dedup, simhash
from windrow.llm.components import components


class Sets:
    def __init__(self, n):
        self.up = list(range(n))

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def exact_brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("counters", [16, 4096])
def test_exact(spark, corpus, rows_of, counters):
    """With 16 counters and two candidates most groups go the ordinary way, with many all frequent ones are split off."""
    got = exact_dedup.exact_dedup(corpus, counters=counters, candidates=min(512, counters // 8))
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == exact_brute([tuple(r) for r in corpus.collect()])


def test_exact_odd(odd_docs, no_docs, rows_of):
    got = exact_dedup.exact_dedup(odd_docs)
    assert rows_of(got) == exact_brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert exact_dedup.exact_dedup(no_docs).count() == 0
    kept = exact_dedup.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert len(texts) == len(set(texts)) == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_hot_digests_stay_in_place(corpus):
    plan = exact_dedup.exact_dedup(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Cartesian" not in plan


def fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), 42).intdigest()
        for j in range(64):
            ones[j] += h >> j & 1
    return sum(1 << j for j in range(64) if 2 * ones[j] > len(shingles))


def simhash_brute(rows, radius=4):
    prints = [fingerprint(t) for _, t in rows]
    sets = Sets(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                sets.join(i, j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[sets.find(i)] = min(doc_id, least.get(sets.find(i), doc_id))
    out = [(d, f"{prints[i]:016x}", least.get(sets.find(i))) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def test_simhash(corpus, rows_of):
    got = simhash.simhash_components(corpus)
    assert sorted(map(tuple, simhash.simhash_components(corpus, hot_rows=5).collect())) == sorted(map(tuple, got.collect()))
    assert rows_of(got) == simhash_brute([tuple(r) for r in corpus.collect()])


def test_simhash_odd(odd_docs, no_docs, rows_of):
    got = simhash.simhash_components(odd_docs)
    assert rows_of(got) == simhash_brute([tuple(r) for r in odd_docs.select("doc_id", "text").collect()])
    assert simhash.simhash_components(no_docs).count() == 0
    kept = simhash.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns
    wanted = {c for _, _, c in rows_of(got) if c is not None}
    assert {r.doc_id for r in kept.collect()} == wanted


def test_simhash_keeps_one_row(spark):
    """Of every component one row is kept, with repeated and NULL ids too, however the rows are dealt."""
    words = [f"w{k}" for k in range(400)]
    near = [" ".join(words[:k] + words[k + 1 :]) for k in (100, 200)]
    far = " ".join(words[::-1])
    rows = [(1, " ".join(words)), (1, near[0]), (1, far), (2, near[1]), (None, far + " end"), (None, near[0] + " end"), (1, far), (None, "solitary"), (None, "solitary"), (None, None), (None, "")]
    prints = {t: simhash.fingerprint((t or "").encode()) for _, t in rows}
    groups = components_brute(set(prints.values()))
    want = Counter(groups.values())
    first = {}
    for i, t in rows:
        key = (i is None, i or 0, prints[t] - (1 << 64) if prints[t] >> 63 else prints[t], hashlib.sha1((t or "").encode()).hexdigest())
        first[groups[prints[t]]] = min(first.get(groups[prints[t]], key), key)
    for n in (1, 4):
        docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, n string").repartition(n)
        kept = simhash.keep_first(docs)
        got = kept.collect()
        assert kept.columns == docs.columns and len(got) == len(want)
        assert {(r.doc_id, r.text or "") for r in got} == {(i, t or "") for i, t in rows if any(k[:2] == (i is None, i or 0) and k[3] == hashlib.sha1((t or "").encode()).hexdigest() for k in first.values())}


def components_brute(prints):
    """Component of each fingerprint, by flooding."""
    out = {}
    for p in sorted(prints):
        queue = [] if p in out else [p]
        out.setdefault(p, p)
        while queue:
            a = queue.pop()
            for b in prints:
                if b not in out and (a ^ b).bit_count() <= 4:
                    out[b] = out[a]
                    queue.append(b)
    return out


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover(radius):
    """Any bits within the radius are missing from some mask."""
    masks = simhash.masks(radius)
    random = np.random.default_rng(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for _ in range(3000):
        bits = sum(1 << int(b) for b in random.choice(64, radius, replace=False))
        assert any(m & bits == 0 for m in masks)


@pytest.mark.parametrize("most", [4, 2048])
def test_dense_bucket(spark, monkeypatch, most):
    """A crowd of fingerprints that share buckets, cut into blocks of four or kept whole."""
    monkeypatch.setattr("windrow.llm.blocks.block_pairs.__defaults__", (most,))
    random = np.random.default_rng(1)
    centre = int(random.integers(0, 2**63))
    prints = {centre ^ sum(1 << int(b) for b in random.choice(64, random.integers(0, 7), replace=False)) for _ in range(120)}
    prints |= {int(x) for x in random.integers(0, 2**64, 50, dtype=np.uint64)}
    prints = sorted(prints)
    df = spark.createDataFrame([(simhash.signed(p),) for p in prints], "fp bigint")
    found = {r.node: r.component for r in components(simhash.links(df)).collect()}
    sets = Sets(len(prints))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 4:
                sets.join(i, j)
    by_set = defaultdict(set)
    for i, p in enumerate(prints):
        by_set[sets.find(i)].add(simhash.signed(p))
    for members in by_set.values():
        assert {found.get(m, m) for m in members} == {min(members)}


def test_components(spark):
    """A long path, a star, a loop, repeated links and NULL ends."""
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(50)] + [(7000, 7000), (5000, 5001), (5001, 5000), (None, 3), (9000, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(50)} | {5000: 5000, 5001: 5000}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def vectors_brute(rows, cosine=0.93):
    sets, n = Sets(len(rows)), [0] * len(rows)

    def usable(v, label):
        return label is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            _, w, b = rows[j]
            if usable(v, a) and usable(w, b) and a == b and len(v) == len(w):
                x, y = np.array(v, float), np.array(w, float)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    sets.join(i, j)
                    n[i] += 1
                    n[j] += 1
    members = defaultdict(list)
    for i in range(len(rows)):
        members[sets.find(i)].append(rows[i][0])
    out = []
    for i, (vec_id, _, _) in enumerate(rows):
        least = min((m for m in members[sets.find(i)] if m is not None), default=None)
        out.append((vec_id, n[i], least, vec_id == least))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("most", [16, 2048])
def test_collisions(spark, rows_of, monkeypatch, most):
    """Near copies around the limit, a label with a third of all, copies, in blocks of 16 and whole."""
    monkeypatch.setattr("windrow.llm.collisions.window_groups.__defaults__", (most,))
    random = np.random.default_rng(4)
    rows = []
    for label in (0, 0, 1, 2):
        centres = random.standard_normal((25, 32))
        for c in centres:
            for _ in range(random.integers(1, 5)):
                rows.append((len(rows), (c + random.standard_normal(32) * random.choice([0, 0.15, 0.3])).tolist(), label))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(4)
    got, want = rows_of(collisions.collision_links(df)), vectors_brute(rows)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) > 0
    assert got == want


def test_collisions_odd(spark, rows_of):
    e = [1.0, 0.0, 0.0]
    rows = [
        (0, e, 1), (1, e, 1), (1, e, 1), (2, None, 1), (3, [0.0, 0.0, 0.0], 1), (4, [1.0, None, 0.0], 1), (5, [float("nan"), 1.0, 0.0], 1),
        (6, [float("inf"), 1.0, 0.0], 1), (7, e, None), (8, [], 1), (9, [1.0, 0.0], 1), (10, [1e200, 0.0, 0.0], 1), (11, [-1.0, 0.0, 0.0], 1), (None, e, 1), (None, None, 1), (12, e, 2),
    ]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "vec_id bigint, embedding array<double>, label int, class int, unit int, points int")
    assert rows_of(collisions.collision_links(df)) == vectors_brute(rows)
    assert collisions.collision_links(df.limit(0)).count() == 0


def test_recall_is_calibrated():
    assert collisions.calibrate(12, 3.0, 0.999) == 11
    random = np.random.default_rng(0)
    x = collisions.unit_rows(random.standard_normal((4000, 64)))
    side = random.standard_normal((4000, 64))
    side -= (side * x).sum(1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * collisions.unit_rows(side)
    axes = random.standard_normal((64, collisions.PROJECTIONS))
    width = collisions.HALF_WINDOW * np.sqrt(2 - 2 * 0.93)
    passed = (np.abs(x @ axes - y @ axes) <= width).sum(1) >= 11
    assert passed.mean() >= 0.99


def test_results_outlive_a_batch(spark, corpus, tmp_path):
    """A lazy result reads landed tables; a batch of sensor files in the same application removes its own only."""
    from windrow.plans.convert import run_batch

    lazy = exact_dedup.exact_dedup(corpus)
    head = "a\nb\nc\nU\tV\tW\tSound\tC\tXw\n[m/s]\t[m/s]\t[m/s]\t[m/50s]\t[mV]\t[mV]\n1\t2\t3\t16000\t1500\t1\n"
    (tmp_path / "X970101_00.raw").write_text(head)
    (tmp_path / "X970101_00.aux").write_text("x\nDate\tTime\tPa\tPlic\tTa\tTlic\n\t\t[kPa]\t[kPa]\t[degC]\t[degC]\n01.01.97\t00:00:00\t80\t80\t10\t35\n")
    run_batch(spark, str(tmp_path), str(tmp_path / "out"))
    assert lazy.count() == corpus.count()
