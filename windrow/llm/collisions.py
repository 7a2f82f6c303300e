"""Near-duplicate vectors by counting collisions in windows of many one-dimensional projections."""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.llm.blocks import BLOCK_ROWS, by_group
from windrow.llm.common import land, pick, ship
from windrow.llm.components import components

COSINE = 0.93
PROJECTIONS = 12
#: Half a window, in standard deviations of the projected distance of two vectors at the cosine asked for.
HALF_WINDOW = 3.0
#: Share of pairs right at that cosine whose count must pass; closer pairs pass more often.
RECALL = 0.999
SEED = 11
#: Pairs that are verified at once.
VERIFY_ROWS = 50_000


def calibrate(projections: int, half_window: float, recall: float) -> int:
    """Largest count that at least ``recall`` of the pairs reach, each projection colliding by itself."""
    hit = erf(half_window / sqrt(2))
    passing = 0.0
    for count in range(projections, 0, -1):
        passing += comb(projections, count) * hit**count * (1 - hit) ** (projections - count)
        if passing >= recall:
            return count
    return 1


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def matrix(column: pa.ListArray | pa.ChunkedArray, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind, copy=False)


def cell_of(projected: Column, width: float) -> Column:
    return F.floor(projected / F.lit(width)).cast("int")


def linked_pairs(
    vectors: np.ndarray,
    projected: np.ndarray,
    side: np.ndarray,
    across: bool,
    primary: int,
    width: float,
    needed: int,
    cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of one group: those that collide in ``primary``, in none before it, and often enough in all."""
    left = np.flatnonzero(side == 0) if across else np.arange(len(side))
    right = np.flatnonzero(side == 1) if across else left
    near = np.zeros((len(left), len(right)), np.uint8)
    for k in range(projected.shape[1]):
        hit = np.abs(projected[left, k, None] - projected[None, right, k]) <= width
        if k == primary:
            alive = hit & (near == 0)
        near += hit
    passing = alive & (near >= needed)
    if not across:
        passing = np.triu(passing, 1)
    a, b = np.nonzero(passing)
    a, b = left[a], right[b]
    good = np.zeros(len(a), bool)
    for at in range(0, len(a), VERIFY_ROWS):
        good[at : at + VERIFY_ROWS] = np.einsum("ij,ij->i", vectors[a[at : at + VERIFY_ROWS]], vectors[b[at : at + VERIFY_ROWS]]) >= cosine
    return a[good], b[good]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that the pairs connect each index with."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def collision_links(
    rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", *,
    cosine: float = COSINE, projections: int = PROJECTIONS, half_window: float = HALF_WINDOW, recall: float = RECALL, seed: int = SEED,
) -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links, component_id, kept.

    Vectors of one label (and length) link when their cosine is at least ``cosine``. Equal vectors are one class with a
    multiplicity. Unit vectors are projected on ``projections`` random lines; at the cosine asked for, the distance on
    a line is normal with a known spread, and two vectors collide where it is at most ``half_window`` spreads. Pairs
    with at least ``calibrate(...)`` = t collisions are verified in double precision. A pair with t collisions collides
    in one of the first ``projections - t + 1`` lines at least, so only on these are pairs looked for: each line is cut
    into cells as wide as the half window, and a window around a query reaches into the neighbouring cells only. Cells
    are cut into blocks, so a hot label or a dense cell becomes many bounded groups; a pair is taken on the first line
    where it collides. Groups give back degrees and links to the smallest member they connect, never pairs.

    Vectors that are NULL, empty, zero or hold NULL or non-finite numbers, and rows without label, link with nothing:
    no links, and their own id as component. Repeated rows are vectors like others. No rows give no rows.
    """
    ship(rows.sparkSession)
    width = float(half_window * sqrt(2 - 2 * cosine))
    needed = calibrate(projections, half_window, recall)
    lines = projections - needed + 1
    source = pick(rows, vec_id=vec_id, label=label, v=F.col(embedding).cast("array<double>"))
    finite = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    usable = F.expr(f"label IS NOT NULL AND size(v) > 0 AND {finite} AND exists(v, x -> x <> 0)")
    marked = land(source.withColumn("usable", F.coalesce(usable, F.lit(False))), "vectors")
    grouped = marked.filter("usable").groupBy("label", "v").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    kind = marked.schema["label"].dataType.simpleString()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            units, points = [None] * batch.num_rows, [None] * batch.num_rows
            for size in np.unique(sizes).tolist():
                chosen = np.flatnonzero(sizes == size)
                x = unit_rows(matrix(batch.column("v").take(pa.array(chosen)), np.float64))
                axes = np.random.default_rng([seed, size]).standard_normal((size, projections))
                for k, u, p in zip(chosen.tolist(), x, x @ axes, strict=True):
                    units[k], points[k] = u, p
            arrays = [batch.column(c) for c in ("class", "label", "copies")]
            lists = [pa.array(x, pa.list_(pa.float64())) for x in (units, points)]
            names = ["class", "label", "copies", "size", "unit", "points"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sizes, pa.int32()), *lists], names)

    classes = land(grouped.withColumn("class", F.monotonically_increasing_id()), "classes")
    points = land(classes.mapInArrow(project, f"class bigint, label {kind}, copies bigint, size int, unit array<double>, points array<double>"), "points")
    groups = window_groups(points, lines, width)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_group(batches, GROUP):
            across = group.column("shift")[0].as_py() == 1 or group.column("block_a")[0].as_py() != group.column("block_b")[0].as_py()
            names, copies = group.column("class").to_numpy(), group.column("copies").to_numpy()
            a, b = linked_pairs(
                matrix(group.column("unit").combine_chunks(), np.float64), matrix(group.column("points").combine_chunks(), np.float64),
                group.column("side").to_numpy(), across, group.column("line")[0].as_py(), width, needed, cosine,
            )
            if not len(a):
                continue
            n = np.bincount(a, copies[b], len(names)) + np.bincount(b, copies[a], len(names))
            some = np.flatnonzero(n)
            root = roots(len(names), a, b)
            yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(names[root[some]]), pa.array(n[some].astype(np.int64))], ["a", "b", "n"])

    found = land(groups.mapInArrow(compare, "a bigint, b bigint, n bigint"), "links")
    degrees = found.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    reached = components(found.select("a", "b")).withColumnRenamed("node", "class")
    named = classes.select("class", "label", "v", "copies", "first").join(degrees, "class", "left").join(reached, "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = named.join(least, "component").selectExpr("label", "v", "coalesce(n, 0L) + copies - 1 AS n_links", "component_id")
    linked = marked.filter("usable").join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    others = marked.filter("NOT usable").selectExpr("vec_id", "0L AS n_links", "vec_id AS component_id")
    return linked.unionByName(others).withColumn("kept", F.expr("vec_id <=> component_id"))


GROUP = ["line", "label", "size", "cell", "shift", "block_a", "block_b"]


def window_groups(points: DataFrame, lines: int, width: float, most: int = BLOCK_ROWS) -> DataFrame:
    """Rows dealt to the pairs of blocks of each cell with itself (shift 0) and with the next cell (shift 1)."""
    on = ["line", "label", "size", "cell"]
    placed = points.select("*", F.posexplode(F.slice("points", 1, lines)).alias("line", "at")).withColumn("cell", cell_of(F.col("at"), width)).drop("at")
    counts = land(placed.groupBy(on).agg(F.ceil(F.count("*") / F.lit(most)).cast("int").alias("blocks")), "cells")
    beside = placed.join(counts, on)
    for name, step in (("next", -1), ("before", 1)):
        beside = beside.join(counts.withColumn("cell", F.col("cell") + step).withColumnRenamed("blocks", name), on, "left")
    beside = beside.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    dealt = F.expr("""
        explode(concat(
            transform(sequence(0, blocks - 1), j -> struct(cell AS cell, 0 AS shift, least(mine, j) AS block_a, greatest(mine, j) AS block_b, IF(mine <= j, 0, 1) AS side)),
            transform(IF(next > 0, sequence(0, next - 1), array()), j -> struct(cell AS cell, 1 AS shift, mine AS block_a, j AS block_b, 0 AS side)),
            transform(IF(before > 0, sequence(0, before - 1), array()), j -> struct(cell - 1 AS cell, 1 AS shift, j AS block_a, mine AS block_b, 1 AS side))
        )) AS g""")
    rows = beside.select("class", "copies", "unit", "points", "line", "label", "size", dealt)
    rows = rows.select("class", "copies", "unit", "points", "line", "label", "size", "g.*")
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP)
