"""The Merkle manifest against brute force."""

import zlib
from hashlib import sha256

import pytest
from conftest import CLASHES
from pyspark.sql import functions as F

from windrow.llm import merkle

COLUMNS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def hashed(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return hashed("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root, and for each node (place, siblings) level by level."""
    paths, level, at = [[] for _ in nodes], nodes, list(range(len(nodes)))
    while len(level) > 1:
        for k, path in enumerate(paths):
            begin = at[k] // 3 * 3
            run, place = level[begin : begin + 3], at[k] - begin
            path.append((place, run[:place] + run[place + 1 :]))
            at[k] //= 3
        level = [hashed("".join(level[b : b + 3])) for b in range(0, len(level), 3)]
    return level[0], paths


def brute(rows):
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    members = [sorted((r for r in rows if r[1] == s), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for s in sources]
    subtrees = [tree([leaf(r) for r in m]) for m in members]
    root, above = tree([subroot for subroot, _ in subtrees])
    out = []
    for rows_, (subroot, paths), path in zip(members, subtrees, above, strict=True):
        for row, below in zip(rows_, paths, strict=True):
            text = row[4]
            if text is not None and zlib.crc32(str("" if row[0] is None else row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf((*row[:4], text))
            for place, siblings in below + path:
                node = hashed("".join([*siblings[:place], node, *siblings[place:]]))
            proof = hashed("".join(s for _, siblings in below + path for s in siblings))
            out.append((row[0], leaf(row), subroot, root, proof, node, node == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r)[:7] for r in df.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, odd_texts, levels):
    """Sources of 1 to 200 rows, one of them NULL, one with a third of all; repeated rows and ids, NULL anywhere."""
    rows = [(i, f"s{i % 11}", "en", i, odd_texts[i % len(odd_texts)]) for i in range(150)]
    rows += [(1000 + i, "hot", None, None, f"line\n{i}") for i in range(200)]
    rows += [(i, None, "en", 3, "a\nb") for i in range(27)] + [(1, "lone", "en", 3, "c"), (2, "", "en", 0, ""), (3, "Ünïcode", "en", 1, "ß\n")]
    rows += rows[:9] + rows[:3] + [(None, "s1", None, None, None), (None, "s1", None, None, None), (4, "s1", "en", None, "other")]
    docs = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit("clash") for c in (*CLASHES, "pos", "grp", "leaf", "claim")})
    got = merkle.verified(docs.repartition(5), merkle.without_line_ends(), levels)
    assert rows_of(got) == brute(rows)


@pytest.mark.parametrize("count", [1, 3, 4])
def test_manifest_small(spark, count):
    rows = [(i, "s", "en", 1, "x\ny") for i in range(count)]
    assert rows_of(merkle.verified(spark.createDataFrame(rows, COLUMNS), merkle.without_line_ends())) == brute(rows)


def test_manifest_empty(spark, no_docs):
    assert merkle.verified(no_docs, merkle.without_line_ends()).collect() == []


def test_frontier_extends_witnesses():
    """Witnesses of early leaves grow as later siblings complete, and lead to the root at every count."""
    leaves = [bytes([i]) * 32 for i in range(1, 30)]
    for count in range(1, 30):
        frontier = merkle.Frontier()
        for k, node in enumerate(leaves[:count]):
            frontier.append(node)
            if k == 2:
                assert [len(w) for w in frontier.witnesses] == [64, 64, 64]
        root = frontier.close(merkle.height(count))
        for position, node in enumerate(leaves[:count]):
            assert merkle.fold(node, merkle.places(position, count), bytes(frontier.witnesses[position])) == root


def test_change_is_found(spark):
    """A changed value breaks the way to the root, whichever column it is in."""
    docs = spark.createDataFrame([(i, f"s{i % 2}", "en", 1, "x") for i in range(10)], COLUMNS)
    for column in ("lang", "source", "text"):
        claimed = {column: F.when(F.col("doc_id") == 4, F.lit("other")).otherwise(F.col(column))}
        assert [r["doc_id"] for r in merkle.verified(docs, claimed).filter("NOT verified").collect()] == [4]
