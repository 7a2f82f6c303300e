"""Hard negatives of anchor vectors by a vertical scan: dimension by dimension, with bounds on what remains."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import floor
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.llm.common import land, pick, ship

POSITIVES = 5
NEGATIVES = 10
SCALE = 256
#: A negative's score times 100 lies between these multiples of the positive's.
LOWEST, HIGHEST = 30, 90
#: Anchors of one scan at most, and bytes of their vectors: what a scan hands to every task.
ANCHOR_ROWS = 16_384
ANCHOR_BYTES = 32 << 20
#: Dimensions that are read between two looks at the bounds.
STEP = 8
#: Sums up to here are exact in double precision; beyond it Python's integers are used.
EXACT = 2**53


def quantized(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole numbers in double precision, or as Python integers where these could be too large."""
    peak = np.abs(vectors).max(initial=0.0)
    if peak * scale < EXACT:
        return np.floor(vectors * scale)
    whole = [[int(x) * scale if abs(x) >= EXACT else floor(x * scale) for x in row] for row in vectors.tolist()]
    return np.array(whole, object).reshape(vectors.shape)


class Block(NamedTuple):
    """Rows of one Arrow batch with vectors of one length, a line of ``columns`` per dimension."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray


def block_of(rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Block:
    columns = np.ascontiguousarray(vectors.T)
    return Block(rows, ids, labels, columns, columns.min(axis=1), columns.max(axis=1))


def in_kind(block: Block, query: np.ndarray) -> tuple[Block, np.ndarray]:
    """Block and query in double precision if no sum can leave its exact range, else in Python's integers."""
    if block.columns.dtype != object and query.dtype != object:
        reach = np.abs(query) @ np.maximum(np.abs(block.low), np.abs(block.high)) if len(query) else 0.0
        if reach < EXACT:
            return block, query
    whole = lambda x: x if x.dtype == object else np.array([int(v) for v in x.ravel()], object).reshape(x.shape)
    return block._replace(columns=whole(block.columns), low=whole(block.low), high=whole(block.high)), whole(query)


def remaining(block: Block, query: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest sum that the dimensions from each place of ``order`` on can add."""
    one, other = query[order] * block.low[order], query[order] * block.high[order]
    zero = np.zeros(1, one.dtype)
    sums = (np.concatenate([np.cumsum(part[::-1])[::-1], zero]) for part in (np.minimum(one, other), np.maximum(one, other)))
    return next(sums), next(sums)


def vertical_scan(block: Block, query: np.ndarray, alive: np.ndarray, least: float, most: float, keep: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of the rows of ``alive`` (a bitmap) that can count.

    Dimensions are read in the order of the query's magnitudes. After each step a row whose score cannot come up to
    ``least`` or down to ``most`` any more leaves the bitmap; with ``keep`` (``most`` without bound) so does one that
    stays below the keep-th largest of the scores that others reach for sure.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    lowest, highest = remaining(block, query, order)
    places = np.flatnonzero(alive)
    score = np.zeros(len(places), block.columns.dtype)
    for begin in range(0, len(order), STEP):
        dims = order[begin : begin + STEP]
        part = block.columns[dims]
        score = score + query[dims] @ (part if len(places) == part.shape[1] else part[:, places])
        end = begin + len(dims)
        if keep is not None and len(score) > keep:
            least = max(least, np.sort(score)[-keep] + lowest[end] if score.dtype == object else np.partition(score, -keep)[-keep] + lowest[end])
        fits = (score + highest[end] >= least) & (score + lowest[end] <= most)
        if not fits.all():
            places, score = places[fits], score[fits]
        if not len(places):
            break
    return places, score


class Firsts:
    """The first ``keep`` rows of every slot: larger scores first, ties by smaller id."""

    def __init__(self, slots: int, keep: int):
        self.keep, self.held = keep, [None] * slots

    def least(self, slot: int) -> float:
        """What a score must reach to come in."""
        held = self.held[slot]
        return held[0][-1] if held is not None and len(held[0]) == self.keep else -np.inf

    def offer(self, slot: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        good = score >= self.least(slot)
        new = (score[good], ids[good], rows[good])
        if not len(new[0]):
            return
        if self.held[slot] is not None:
            new = tuple(np.concatenate(pair) for pair in zip(self.held[slot], new, strict=True))
        if new[0].dtype == object:
            first = sorted(range(len(new[0])), key=lambda i: (-new[0][i], new[1][i], new[2][i]))[: self.keep]
        else:
            first = np.lexsort((new[2], new[1], -new[0]))[: self.keep]
        self.held[slot] = tuple(part[first] for part in new)

    def batch(self, names: list[str]) -> pa.RecordBatch:
        """Rows (slot, id, row, score)."""
        out = [(slot, held) for slot, held in enumerate(self.held) if held is not None]
        slots = [slot for slot, (score, _, _) in out for _ in score]
        parts = [[int(x) for _, held in out for x in held[k]] for k in (1, 2, 0)]
        return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()) for p in (slots, *parts)], names)


class Anchors(NamedTuple):
    """Anchors of one scan. ``windows`` are (slot, least, most) per anchor where negatives are sought."""

    rows: list[int]
    labels: list
    vectors: list[np.ndarray]
    windows: list[list[tuple[int, int, int]]] | None


def blocks_of(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[Block]:
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column("v")
        sizes = np.diff(column.offsets.to_numpy())
        rows, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("row", "vec_id", "label"))
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
            yield block_of(rows[at], ids[at], labels[at], quantized(flat.reshape(len(at), size), scale))


def first_positives(blocks: Iterator[Block], anchors: Anchors, keep: int) -> Firsts:
    """Of each anchor, the first rows with its label; the anchor itself is none."""
    firsts = Firsts(len(anchors.rows), keep)
    for block in blocks:
        own = {label: block.labels == label for label in set(anchors.labels)}
        for k, (row, label, query) in enumerate(zip(anchors.rows, anchors.labels, anchors.vectors, strict=True)):
            if len(query) != len(block.columns):
                continue
            alive = own[label] & (block.rows != row)
            if not alive.any():
                continue
            exact, q = in_kind(block, query)
            places, score = vertical_scan(exact, q, alive, firsts.least(k), np.inf, keep)
            firsts.offer(k, score, block.ids[places], block.rows[places])
    return firsts


def first_negatives(blocks: Iterator[Block], anchors: Anchors, slots: int, keep: int) -> Firsts:
    """Of each window, the first rows inside it whose label is another one."""
    firsts = Firsts(slots, keep)
    for block in blocks:
        others = {label: block.labels != label for label in set(anchors.labels)}
        for label, query, windows in zip(anchors.labels, anchors.vectors, anchors.windows, strict=True):
            if len(query) != len(block.columns) or not windows or not others[label].any():
                continue
            least = min(max(low, firsts.least(slot)) for slot, low, _ in windows)
            exact, q = in_kind(block, query)
            places, score = vertical_scan(exact, q, others[label], least, max(high for _, _, high in windows), None)
            for slot, low, high in windows:
                inside = (score >= low) & (score <= high)
                firsts.offer(slot, score[inside], block.ids[places[inside]], block.rows[places[inside]])
    return firsts


def ranked(rows: DataFrame, by: list[str], keep: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id", "row")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def mine_hard_negatives(
    rows: DataFrame, anchors: Column | str = "vec_id % 100 = 0", vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", *,
    positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE, lowest: int = LOWEST, highest: int = HIGHEST,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components x count as floor(scale * x); scores are inner products. An anchor (a row for which ``anchors`` holds)
    has as positives its first ``positives`` other rows of its label, and for each of them the first ``negatives`` rows
    of other labels are returned whose score times 100 lies between ``lowest`` and ``highest`` times the positive's.
    Larger scores come first, ties by smaller id.

    Anchors are a stated query set against all rows. They are taken in scans of at most ``anchor_rows``, handed to
    every task; rows are not shuffled. A task reads each Arrow batch as a block of columns: for each anchor a bitmap
    starts with the rows of the right labels and shrinks as dimensions are read in the anchor's descending magnitude,
    by the smallest and largest contribution that the dimensions left can make in the block. What is left has exact
    scores; a task returns its first rows of each anchor or window, from which Spark takes the first of all.

    Rows without id, label or vector, or with components that are NULL or not finite, take no part; vectors only meet
    vectors of their length. Rows that repeat an id count one by one, as anchors, positives and negatives. Scores must
    fit into 64 bits (an error otherwise). No rows, or no anchors, give no rows.
    """
    spark = rows.sparkSession
    ship(spark)
    source = pick(rows, vec_id=F.col(vec_id).cast("long"), label=label, v=embedding)
    finite = "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    usable = source.filter(f"vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND {finite}")
    every = land(usable.withColumn("row", F.monotonically_increasing_id()), "vectors")
    queries = every.filter(F.expr(anchors) if isinstance(anchors, str) else anchors)
    count, size = queries.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    most = max(1, min(anchor_rows, ANCHOR_BYTES // (8 * max(1, size or 0))))
    scans = -(-count // most)
    dealt = land(queries.withColumn("scan", F.pmod(F.xxhash64("row"), F.lit(max(scans, 1))).cast("int")), "anchors")
    found = [_mine(every, dealt.filter(F.col("scan") == k), positives, negatives, scale, lowest, highest) for k in range(scans)]
    if not found:
        kinds = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], kinds)
    return reduce(DataFrame.unionByName, found)


def _mine(every: DataFrame, queries: DataFrame, positives: int, negatives: int, scale: int, lowest: int, highest: int) -> DataFrame:
    """The result of one scan's anchors."""
    spark = every.sparkSession
    held = queries.select("row", "vec_id", "label", "v").toArrow()  # at most ``anchor_rows`` rows
    rows, ids, labels = (held.column(c).to_pylist() for c in ("row", "vec_id", "label"))
    vectors = [quantized(np.array([v], np.float64).reshape(1, len(v)), scale)[0] for v in held.column("v").to_pylist()]
    asked = spark.sparkContext.broadcast(Anchors(rows, labels, vectors, None))

    def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield first_positives(blocks_of(batches, scale), asked.value, positives).batch(["slot", "id", "row", "score"])

    kinds = "slot bigint, id bigint, row bigint, score bigint"
    near = ranked(every.mapInArrow(find_positives, kinds), ["slot"], positives)
    pairs = land(near.selectExpr("slot AS anchor", "id AS positive_id", "score AS positive_score"), "positives")
    pair = pairs.toArrow().to_pylist()  # at most ``positives`` for each anchor
    windows: list[list[tuple[int, int, int]]] = [[] for _ in rows]
    for slot, p in enumerate(pair):
        least, high = -(-lowest * p["positive_score"] // 100), highest * p["positive_score"] // 100
        if least <= high:
            windows[p["anchor"]].append((slot, least, high))
    sought = spark.sparkContext.broadcast(Anchors(rows, labels, vectors, windows))

    def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield first_negatives(blocks_of(batches, scale), sought.value, len(pair), negatives).batch(["slot", "id", "row", "score"])

    hard = land(ranked(every.mapInArrow(find_negatives, kinds), ["slot"], negatives), "negatives")
    names = pa.table({
        "slot": pa.array(range(len(pair)), pa.int64()), "anchor_id": pa.array([ids[p["anchor"]] for p in pair], pa.int64()),
        "positive_id": pa.array([p["positive_id"] for p in pair], pa.int64()), "positive_score": pa.array([p["positive_score"] for p in pair], pa.int64()),
    })
    named = hard.join(F.broadcast(spark.createDataFrame(names)), "slot")
    return named.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
