"""Ordered operators on series: fills, row numbers, keep-last, densification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.clock import DAY_US, axis_micros, back_to, from_micros, micros
from windrow.operators.hot import MIN_HOT_ROWS, Blocked, attach, cut_series
from windrow.presets import PERIOD_PS

BEFORE = Window.unboundedPreceding
CHUNK_STEPS = 100_000


@dataclass(frozen=True)
class Carry:
    """Value of ``value`` in the nearest row that has one.

    ``backward`` looks at later rows instead of earlier ones, ``strict`` leaves out the row itself.
    """

    out: str
    value: Column
    backward: bool = False
    strict: bool = False


def _ordering(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.col(c).desc() if descending else F.col(c).asc() for c in order]


def carry(series: Blocked, order: Sequence[str], specs: Sequence[Carry]) -> DataFrame:
    """Add one column per spec. ``order`` must be total within a key for a repeatable result.

    Looking backward is written as a running frame over the reversed order: a frame that reaches to the end of
    the partition costs quadratic time in Spark.
    """
    df = series.df
    windowed = {}
    for spec in specs:
        frame = Window.partitionBy(*series.keys).orderBy(*_ordering(order, spec.backward))
        windowed[spec.out] = F.last(spec.value, ignorenulls=True).over(
            frame.rowsBetween(BEFORE, -1 if spec.strict else 0)
        )
    if not series.cut:
        return df.withColumns(windowed)

    position = F.struct(*order)
    ends = []
    for spec in specs:
        known = F.when(spec.value.isNotNull(), position)
        edge = F.min_by(spec.value, known) if spec.backward else F.max_by(spec.value, known)
        ends.append(edge.alias(spec.out))
    block = series.keys[-1]
    # Block 0 holds the rows of ordinary keys, which have one block and nothing to hand over.
    per_block = df.where(F.col(block) > 0).groupBy(*series.keys).agg(*ends)
    handed = {}
    for spec in specs:
        frame = Window.partitionBy(*series.by).orderBy(*_ordering([block], spec.backward)).rowsBetween(BEFORE, -1)
        handed[f"_from_{spec.out}"] = F.last(spec.out, ignorenulls=True).over(frame)
    handed_over = per_block.withColumns(handed).select(*series.keys, *handed)
    joined = series.hand_over(df.withColumns(windowed), handed_over)
    filled = {spec.out: F.coalesce(F.col(spec.out), F.col(f"_from_{spec.out}")) for spec in specs}
    return joined.withColumns(filled).drop(*handed, block)


def _fill(df, by, order, cols, directions, min_hot_rows):
    series = cut_series(df, by, order, min_hot_rows)
    specs = [Carry(f"_{d}_{c}", F.col(c), backward=d == "next") for d in directions for c in cols]
    carried = carry(series, order, specs)
    filled = {c: F.coalesce(*[F.col(f"_{d}_{c}") for d in directions]) for c in cols}
    return carried.withColumns(filled).select(*df.columns)


def ffill(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], min_hot_rows: int = MIN_HOT_ROWS):
    """NULLs take the last earlier value. ``min_hot_rows=0`` skips the probe for oversized keys."""
    return _fill(df, by, order, cols, ("last",), min_hot_rows)


def bfill(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], min_hot_rows: int = MIN_HOT_ROWS):
    """NULLs take the next later value."""
    return _fill(df, by, order, cols, ("next",), min_hot_rows)


def bffill(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], min_hot_rows: int = MIN_HOT_ROWS):
    """NULLs take the next later value; those after the last value take that one.

    Filling forward after filling backward only reaches rows with no later value, so both passes can read the
    original column.
    """
    return _fill(df, by, order, cols, ("next", "last"), min_hot_rows)


def row_index(df: DataFrame, by: Sequence[str], order: Sequence[str], out: str = "row_idx", min_hot_rows: int = MIN_HOT_ROWS):
    """Position of a row within its key, from 0."""
    series = cut_series(df, by, order, min_hot_rows)
    frame = Window.partitionBy(*series.keys).orderBy(*order)
    position = (F.row_number().over(frame) - 1).cast("bigint")
    if not series.cut:
        return df.withColumn(out, position)
    block = series.keys[-1]
    earlier = Window.partitionBy(*series.by).orderBy(block).rowsBetween(BEFORE, -1)
    offsets = (
        series.df.where(F.col(block) > 0)
        .groupBy(*series.keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*series.keys, F.sum("_rows").over(earlier).alias("_offset"))
    )
    numbered = series.hand_over(series.df.withColumn(out, position), offsets)
    return numbered.withColumn(out, F.col(out) + F.coalesce("_offset", F.lit(0))).drop("_offset", block)


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], cols: Sequence[str], min_hot_rows: int = MIN_HOT_ROWS):
    """Whole-numbered ``cols`` replaced by their sums over the rows of a key up to each row; ``order`` must be total."""
    series = cut_series(df, by, order, min_hot_rows)
    frame = Window.partitionBy(*series.keys).orderBy(*order).rowsBetween(BEFORE, 0)
    sums = {c: F.sum(c).over(frame) for c in cols}
    if not series.cut:
        return series.df.withColumns(sums)
    block = series.keys[-1]
    earlier = Window.partitionBy(*series.by).orderBy(block).rowsBetween(BEFORE, -1)
    per_block = series.df.where(F.col(block) > 0).groupBy(*series.keys).agg(*[F.sum(c).alias(c) for c in cols])
    offsets = per_block.select(*series.keys, *[F.sum(c).over(earlier).alias(f"_before_{c}") for c in cols])
    summed = series.hand_over(series.df.withColumns(sums), offsets)
    return summed.withColumns({c: F.col(c) + F.coalesce(f"_before_{c}", F.lit(0)) for c in cols}).select(*df.columns)


def assign_time_axis(
    df: DataFrame, start: str = "start_ts", row: str = "row_idx", out: str = "ts", period_ps: int = PERIOD_PS
) -> DataFrame:
    """Time of every row from the start of its file and its position; a projection, nothing moves."""
    return df.withColumn(out, from_micros(axis_micros(micros(F.col(start)), F.col(row), period_ps)))


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row by ``order`` of every key.

    Spark cuts ``row_number() = 1`` down to one row per key and task before the shuffle, so a key with very many
    copies is no burden.
    """
    latest = Window.partitionBy(*keys).orderBy(*_ordering(order, True))
    return df.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def densify(df: DataFrame, by: Sequence[str], on: str, step_us: int = DAY_US) -> DataFrame:
    """One row per step between the first and the last ``on`` of each key, NULLs in the new rows; no row is lost.

    ``on`` is a date or a time. Rows between two steps (counted from the first of their key) and rows without ``on``
    come through as they are, and so do several rows of one step. A NULL key is a key like others. Long ranges are cut
    into chunks that spread over tasks before their steps are written out.
    """
    by = list(by)
    kind = df.schema[on].dataType
    if isinstance(kind, T.DateType):
        step, position = max(1, step_us // DAY_US), F.unix_date(F.col(on)).cast("bigint")
        back = F.date_from_unix_date(F.col("_step").cast("int"))
    else:
        step, position = step_us, micros(F.col(on))
        back = back_to(F.col("_step"), kind)
    placed = df.withColumn("_position", position)
    ends = placed.groupBy(*by).agg(F.min("_position").alias("_first"), F.max("_position").alias("_last"))
    width = F.lit(step * CHUNK_STEPS).cast("bigint")
    chunks = ends.where("_first is not null").select(
        *by, "_last", F.explode(F.sequence("_first", "_last", width)).alias("_chunk")
    )
    spread = chunks.repartition(*by, "_chunk")
    until = F.least(F.col("_last"), F.col("_chunk") + width - F.lit(step))
    steps = spread.select(*by, F.explode(F.sequence("_chunk", until, F.lit(step).cast("bigint"))).alias("_step"))
    firsts = ends.drop("_last")
    given = attach(placed, firsts if by else F.broadcast(firsts), by)  # without keys: one row
    on_step = F.pmod(F.col("_position") - F.col("_first"), F.lit(step)) == 0
    flagged = given.withColumn("_on", F.coalesce(on_step, F.lit(False)))
    regular = flagged.where("_on").withColumn("_step", F.col("_position"))
    dense = attach(steps.withColumn("_new", back), regular.drop("_first", "_on", "_position"), [*by, "_step"])
    dense = dense.withColumn(on, F.coalesce(F.col(on), F.col("_new"))).select(*df.columns)
    return dense.unionByName(flagged.where("NOT _on").select(*df.columns))
