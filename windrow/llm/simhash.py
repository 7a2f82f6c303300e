"""SimHash fingerprints and all links within a bit distance, by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.blocks import block_pairs, by_group
from windrow.llm.common import land, pick, ship, whole_text
from windrow.llm.components import components

BITS = 64
SEED = 42
WORDS = 4
RADIUS = 4
#: Rows from which a fingerprint is joined by a broadcast.
HOT_ROWS = 100_000
#: Shingles whose bits are counted at once.
CHUNK = 1 << 15


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Bits that are set in over half of the XXH64 values of a text's shingles; zero without a word."""
    parts = text.lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    size = min(words, len(parts))
    total = len(parts) - size + 1
    pairs = zip(begins[:total].tolist(), ends[size - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    hashes = np.fromiter((digest(joined[b:e], SEED) for b, e in pairs), "<u8", total)
    for at in range(0, total, CHUNK):
        part = hashes[at : at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, **more: Column) -> DataFrame:
    """Rows (doc_id, fp): the fingerprint as a signed BIGINT, from the whole text; ``more`` are further columns of text."""
    ship(docs.sparkSession)
    names = ["doc_id", "fp", *more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]], names)

    source = pick(docs, doc_id=doc_id, text=whole_text(text).cast("binary"), **more)
    schema = ", ".join([f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fp bigint", *(f"{name} string" for name in more)])
    return source.mapInArrow(run, schema)


def masks(radius: int, bits: int = BITS) -> list[int]:
    """Covering masks: bit i is in mask v where the parity of ``code(i) & v`` is odd, codes having radius + 1 bits.

    The codes of at most ``radius`` differing bits span less than the whole space, so some v is orthogonal to all of
    them: its mask holds none of these bits, and the pair collides there. Codes run through all non-zero values.
    """
    codes = [i % (2 ** (radius + 1) - 1) + 1 for i in range(bits)]
    return [sum(1 << i for i, code in enumerate(codes) if (code & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def forest(values: np.ndarray, side: np.ndarray, across: bool, radius: int) -> Iterator[tuple[int, int]]:
    """Indices of links that span what is connected: inside the group, or between its two sides only."""
    open_ = np.ones(len(values), bool)
    for root in range(len(values)):
        if not open_[root]:
            continue
        open_[root] = False
        queue = [root]
        while queue:
            node = queue.pop()
            rest = np.flatnonzero(open_ & (side != side[node]) if across else open_)
            near = rest[np.bitwise_count(values[rest] ^ values[node]) <= radius]
            open_[near] = False
            for other in near.tolist():
                queue.append(other)
                yield node, other


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints of column ``fp`` within ``radius`` bits of each other.

    Every table holds each fingerprint once under its masked value. Buckets of two are compared in place. Larger ones
    are cut into blocks when they hold more than a block; each pair of blocks is one bounded group, and only links that
    span what is connected in it leave the group.
    """
    distinct = prints.select("fp").distinct()
    tables = F.explode(
        F.array(*[F.struct(F.lit(v).alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key")) for v, m in enumerate(masks(radius))])
    )
    rows = distinct.select("fp", tables.alias("x")).select("fp", "x.t", "x.key")
    sizes = land(
        rows.groupBy("t", "key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1"),
        "buckets",
    )
    pairs = sizes.filter("n = 2 AND bit_count(a ^ b) <= {}".format(int(radius))).select("a", "b")
    large = rows.join(sizes.filter("n > 2").select("t", "key", "n"), ["t", "key"])
    groups = block_pairs(large, ["t", "key"], "n", F.xxhash64("fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for group in by_group(batches, ["t", "key", "block_a", "block_b"]):
            values = group.column("fp").to_numpy()
            across = group.column("block_a")[0].as_py() != group.column("block_b")[0].as_py()
            for x, y in forest(values.view(np.uint64), group.column("block").to_numpy(), across, radius):
                a.append(int(values[x]))
                b.append(int(values[y]))
            if len(a) > 50_000:
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
                a, b = [], []
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return pairs.unionByName(groups.mapInArrow(run, "a bigint, b bigint")).distinct()


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int = WORDS, radius: int = RADIUS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id.

    Documents link when their fingerprints differ in at most ``radius`` bits; equal fingerprints are one class from the
    start. ``component_id`` is the smallest doc_id that links reach. Every text is read whole; NULL and empty texts
    have fingerprint zero and link like others. A NULL doc_id never names a component unless all its members are NULL.
    Repeated rows come out as often as they go in; no rows give no rows. Fingerprints of more than ``hot_rows`` rows, of
    which there are few (16 bytes each), are broadcast to their rows, others are joined by a shuffle.
    """
    ship(docs.sparkSession)
    rows = land(fingerprints(docs, doc_id, text, words), "fingerprints")
    classes = land(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "classes")
    found = components(links(classes, radius))
    named = classes.join(found, classes.fp == found.node, "left").select("fp", "first", "n", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    classes = land(named.join(least, "component").select("fp", "n", "component_id"), "classes")
    # A fingerprint of very many rows, such as that of empty texts, must not be one key of a shuffle.
    hot = F.broadcast(classes.filter(F.col("n") > hot_rows).select("fp", "component_id"))
    cold = classes.filter(F.col("n") <= hot_rows).select("fp", "component_id")
    met = rows.join(hot, "fp").unionByName(rows.join(hot.select("fp"), "fp", "left_anti").join(cold, "fp"))
    return met.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns.

    It is the one with the smallest doc_id (NULL last), then fingerprint and digest of the text; of rows that are equal
    in id and text any one. Texts are shuffled to their decisions once, at every size.
    """
    ship(docs.sparkSession)
    digest = F.sha1(whole_text(text))
    rows = land(fingerprints(docs, doc_id, text, words, digest=digest), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "digest")
    classes = land(rows.groupBy("fp").agg(F.min(order).alias("first")), "classes")
    found = components(links(classes, radius))
    named = classes.join(found, classes.fp == found.node, "left").select("first", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("first"))
    kept = land(least.select(key_of(F.col("first.digest"), F.col("first.doc_id")).alias("__kept")), "kept")
    keyed = docs.withColumn("__key", key_of(digest, F.col(doc_id)))
    met = keyed.join(kept.hint("merge"), keyed["__key"] == kept["__kept"], "left_semi")
    numbered = met.withColumn("__row", F.row_number().over(Window.partitionBy("__key").orderBy("__key")))
    return numbered.filter("__row = 1").drop("__key", "__row")


def key_of(digest: Column, doc_id: Column) -> Column:
    """One text for an id and a digest, so that a join and a window share a shuffle; a NULL id differs from all others."""
    return F.concat(digest, F.coalesce(F.concat(F.lit(":"), doc_id.cast("string")), F.lit("")))
