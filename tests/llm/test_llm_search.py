"""Hard negatives and benchmark passages against brute force and SQL."""

import math
import re

import duckdb
import numpy as np
import pytest
from conftest import CLASHES
from pyspark.sql import functions as F

from windrow.llm import queries
from windrow.llm.decontamination import decontaminate
from windrow.llm.hard_negatives import block_of, mine_hard_negatives, vertical_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
VECTORS = "vec_id bigint, embedding array<double>, label int"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_decontamination", "op13_manifest"])
def test_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '/root/testdata/sf0.001/{table}.parquet'")
    expected = connection.execute(queries.ORACLE[name])
    columns = [c[0] for c in expected.description]
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert got.columns == columns
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())


def mined(rows, positives=5, negatives=10):
    sound = [
        (i, k, [math.floor(256 * x) for x in v])
        for i, v, k in rows
        if i is not None and k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (anchor, label, q) in enumerate(sound):
        if anchor % 100:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, n, k) for n, (i, k, v) in enumerate(sound) if len(v) == len(q))
        for score, positive, *_ in [s for s in scored if s[3] == label and s[2] != at][:positives]:
            inside = [s for s in scored if s[3] != label and 30 * -score <= 100 * -s[0] <= 90 * -score][:negatives]
            out += [(anchor, positive, rank, s[1], -score, -s[0]) for rank, s in enumerate(inside, 1)]
    return sorted(out)


@pytest.mark.parametrize("anchor_rows", [7, 10_000])
def test_hard_negatives_odd(spark, anchor_rows):
    random_ = np.random.default_rng(1)
    rows = [(i * 25, random_.standard_normal(4).round(1).tolist(), i % 3) for i in range(200)]
    rows += [(5000 + i * 10, [0.5, 0.5, 0.5, 0.5], 0) for i in range(40)]  # ties
    rows += rows[:10]
    rows += [
        (None, [1.0] * 4, 1), (100, None, 1), (200, [1.0, None, 2.0, 3.0], 1), (300, [float("nan")] * 4, 0), (300, [float("inf")] * 4, 0),
        (500, [], 1), (525, [], 1), (550, [], 2), (600, [1.0, 2.0], 0), (625, [1.0, 2.5], 0), (650, [0.5, 1.0], 1), (700, [1.0] * 4, None),
    ]
    table = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("clash") for c in (*CLASHES, "row", "slot", "scan", "v") if c != "label"})
    assert sorted(map(tuple, mine_hard_negatives(table.repartition(4), anchor_rows=anchor_rows).collect())) == mined(rows)
    assert mine_hard_negatives(table.limit(0)).collect() == []
    assert mine_hard_negatives(table.filter("vec_id % 100 <> 0")).collect() == []


def test_hard_negatives_large_numbers(spark):
    """Sums beyond the exact range of doubles are counted in whole numbers."""
    rows = [(0, [3e6, 1e6, 1.0], 1), (1, [2e6, 1e5, 3.3], 1), (2, [1e6, 1e5, 7.1], 2), (3, [1e6, 1e5, 7.2], 2), (100, [3e6, -1e6, -5.0], 2)]
    got = sorted(map(tuple, mine_hard_negatives(spark.createDataFrame(rows, VECTORS)).collect()))
    assert got == mined(rows) and got[0][4] > 2**53


def test_vertical_scan_prunes():
    """Rows leave the bitmap before all dimensions are read, and none that belongs to the result does."""
    random_ = np.random.default_rng(2)
    x = np.floor(random_.standard_normal((3000, 32)) * np.geomspace(100, 1, 32))
    block = block_of(np.arange(3000), np.arange(3000), np.zeros(3000), x)
    query = np.floor(random_.standard_normal(32) * np.geomspace(100, 1, 32))
    exact = x @ query
    alive = np.arange(3000) % 3 > 0
    places, score = vertical_scan(block, query, alive, -np.inf, np.inf, 5)
    assert len(places) < 20 and (score == exact[places]).all()
    assert set(np.argsort(-np.where(alive, exact, -np.inf))[:5]) <= set(places)
    low, high = np.quantile(exact, [0.6, 0.8])
    places, score = vertical_scan(block, query, alive, low, high, None)
    assert sorted(places) == np.flatnonzero(alive & (exact >= low) & (exact <= high)).tolist()


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def contaminated(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), window)
        for begin in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[begin : begin + size]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(k) for k in windows}:
            for begin in range(len(w) - size + 1):
                if items := windows.get(tuple(w[begin : begin + size])):
                    hit.update(range(begin, begin + size))
                    found |= items
        out.append((doc, len(w), len(hit), sorted(str(i) for i in found if i is not None), bool(hit)))
    return sorted(out, key=str)


ITEMS = [
    (1, "the quick"), (2, "A"), (3, ""), (4, None), (5, "the quick brown fox"), (None, "lazy dog! over"), (5, "the quick brown fox"),
    (6, "x x x x x x x x x x x x"), (7, "é1 2ñ 3 4 5 6"), (8, "the the the"), (9, "a b c d e f g h i j k l"), (10, "K İ ſ"),
]
TEXTS = [
    "The QUICK brown", "a", "x " * 50, "the the the the quick brown fox jumps over the lazy dog over and the quick", None, "", "K k İ ſ s",
    "é1 2Ñ 3 4 5 6 é1 2ñ 3 4 5 6 A", "a b c d e f g h i j k l a b c d e f g h i j m", "lazy dog over lazy dog over", "y " * 30_000 + "a b c d e f g h i j k l",
]


@pytest.mark.parametrize("most", [1, 500_000])
def test_decontaminate_odd(spark, most):
    """Both ways of joining: broadcast, and salted keys."""
    rows = [*enumerate(TEXTS), (None, "the quick"), (3, TEXTS[3])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("clash") for c in (*CLASHES, "words", "at", "row", "win")})
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumns({c: F.lit(1) for c in ("words", "win", "begin", "length")})
    got = decontaminate(docs.repartition(3), items, most=most)
    assert sorted(map(tuple, got.collect()), key=str) == contaminated(rows, ITEMS)
    assert decontaminate(docs.limit(0), items, most=most).collect() == []
    assert sorted(map(tuple, decontaminate(docs, items.limit(0), most=most).collect()), key=str) == contaminated(rows, [])


@pytest.mark.parametrize("most", [1, 500_000])
def test_decontaminate_shared_passages(spark, corpus, most):
    """A third of all documents hold the passage that many items share."""
    texts = [tuple(r) for r in corpus.collect()]
    hot = max((t for _, t in texts), key=[t for _, t in texts].count)
    items = [(i, " ".join(hot.split()[i : i + 30])) for i in range(0, 60, 4)] + [(100 + i, t) for i, t in texts[::37]]
    got = decontaminate(corpus, spark.createDataFrame(items, "item_id bigint, text string"), most=most)
    assert sorted(map(tuple, got.collect()), key=str) == contaminated(texts, items)
