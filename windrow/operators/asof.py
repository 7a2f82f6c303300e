"""Joins in time: nearest row, linear interpolation.

Both put the rows of the two sides into one series per key and let every left row pick up the right row before
it in a running window. What lies after that right row travels inside it, so one pass over the union is enough
and the sort of the large side happens once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow.functions.clock import back_to, micros, snap
from windrow.functions.numeric import lerp
from windrow.operators.fill import Carry, carry
from windrow.operators.hot import MIN_HOT_ROWS, Blocked, Cut, Deal, apply_cut, plan_cut, row_hash

LEFT, RIGHT, SENTINEL = 2, 1, 0
BEGINNING = -(2**62)


def _known_keys(by: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in by:
        condition = condition & F.col(key).isNotNull()
    return condition


def _plan(left: DataFrame, points: DataFrame, on: str, by: Sequence[str], min_hot_rows: int) -> Cut | None:
    """One cut for both sides, so that a block holds the left and right rows of the same time."""
    if not min_hot_rows:
        return None
    times = left.select(*by, micros(F.col(on)).alias("_k")).unionByName(points.select(*by, "_k"))
    return plan_cut(times, by, min_hot_rows)


def _in_blocks(left: DataFrame, marks: DataFrame, by: Sequence[str], cut: Cut | None) -> Blocked:
    """Left rows and marks of the right side in one series; left rows of one time are dealt to several blocks."""
    if cut is None:
        return Blocked(left.unionByName(marks, allowMissingColumns=True), list(by))
    union = left.withColumn("_tie", row_hash(left)).unionByName(marks, allowMissingColumns=True)
    deal = Deal(F.col("_side") == LEFT, F.col("_tie"), F.lit(False))
    return apply_cut(union, by, F.col("_k").cast("double"), cut, deal)


def _with_lead_in(df: DataFrame, by: Sequence[str], row: dict[str, Column], first: dict[str, Column]) -> DataFrame:
    """Right rows with the columns ``row``, and one more with ``first`` ahead of the earliest row of each key.

    The extra row lets left rows before the first right row see it.
    """
    own = F.struct(F.col("_k"), F.lit(RIGHT).alias("_side"), *[c.alias(n) for n, c in row.items()])
    ahead = F.struct(
        F.lit(BEGINNING).cast("bigint").alias("_k"), F.lit(SENTINEL).alias("_side"), *[c.alias(n) for n, c in first.items()]
    )
    rows = F.when(F.col("_earlier").isNull(), F.array(ahead, own)).otherwise(F.array(own))
    return df.select(*by, F.inline(rows))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    cols: Sequence[str] = (),
    direction: str = "nearest",
    tolerance_us: int | None = None,
    matched: str | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add to every left row the ``cols`` of one right row with the same ``by``.

    ``backward`` takes the last right row at or before the time ``on``, ``forward`` the first at or after it,
    ``nearest`` the closer of the two and the later one on a tie. Right rows further away than ``tolerance_us``
    do not count. Right times are unique per key (see ``dedupe_last``). ``matched`` names a column for the time
    of the right row.
    """
    if direction not in ("nearest", "backward", "forward"):
        raise ValueError(f"unknown direction {direction!r}")
    by = list(by)
    points = right.where(_known_keys(by) & F.col(on).isNotNull()).select(
        *by, micros(F.col(on)).alias("_k"), F.struct(micros(F.col(on)).alias("t"), *cols).alias("_cur")
    )
    cut = _plan(left, points, on, by, min_hot_rows)
    if direction == "backward":
        marks = points.withColumns({"_side": F.lit(RIGHT), "_mark": F.struct("_cur")})
    else:
        following = carry(
            apply_cut(points, by, F.col("_k").cast("double"), cut),
            ["_k"],
            [
                Carry("_next", F.col("_cur"), backward=True, strict=True),
                Carry("_earlier", F.col("_k"), strict=True),
            ],
        )
        nothing = F.lit(None).cast(points.schema["_cur"].dataType)
        marks = _with_lead_in(
            following,
            by,
            {"_mark": F.struct("_cur", "_next")},
            {"_mark": F.struct(nothing.alias("_cur"), F.col("_cur").alias("_next"))},
        )
    rows = left.withColumns({"_k": micros(F.col(on)), "_side": F.lit(LEFT)})
    series = _in_blocks(rows, marks.select(*by, "_k", "_side", "_mark"), by, cut)
    picked = carry(series, ["_k", "_side"], [Carry("_seen", F.col("_mark"))]).where(F.col("_side") == LEFT)

    before = F.col("_seen._cur")
    if direction == "backward":
        chosen = before
    else:
        after = F.when(F.col("_seen._cur.t") == F.col("_k"), before).otherwise(F.col("_seen._next"))
        if direction == "forward":
            chosen = after
        else:
            closer = (F.col("_k") - F.col("_seen._cur.t")) < (F.col("_seen._next.t") - F.col("_k"))
            chosen = (
                F.when(F.col("_seen._next").isNull() | (F.col("_seen._cur.t") == F.col("_k")) | closer, before)
                .otherwise(F.col("_seen._next"))
            )
    found = picked.withColumn("_hit", F.when(F.col("_k").isNotNull(), chosen))
    if tolerance_us is not None:
        near = F.abs(F.col("_k") - F.col("_hit.t")) <= tolerance_us
        found = found.withColumn("_hit", F.when(near, F.col("_hit")))
    out = [F.col(f"_hit.{c}").alias(c) for c in cols]
    if matched:
        out.append(back_to(F.col("_hit.t"), right.schema[on].dataType).alias(matched))
    return found.select(*left.columns, *out)


def interpolate_linear(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    cols: Sequence[str],
    tolerance_us: int | None = None,
    grid_us: int | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add ``cols`` of the slow side ``right``, linear in time between its known values, to every left row.

    With ``grid_us`` a left row reads the nearest point of that grid, as if the slow side had been upsampled to it;
    the grid itself is never built. Before the first known value the result is NULL, after the last one it stays
    constant. Left rows outside the time range of the slow side read its first or last row if that lies within
    ``tolerance_us`` (no limit if None), else NULL. Times of the slow side are unique per key; with a grid they are
    multiples of it.
    """
    by = list(by)
    points = right.where(_known_keys(by) & F.col(on).isNotNull()).select(*by, micros(F.col(on)).alias("_k"), *cols)
    names = {c: f"_p_{c}" for c in cols}
    cut = _plan(left, points, on, by, min_hot_rows)
    known = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_k").alias("t"), F.col(c).alias("v"))) for c in cols}
    ahead = [Carry(f"_ahead_{c}", known[c], backward=True, strict=True) for c in cols]
    ahead += [
        Carry("_ahead", F.col("_k"), backward=True, strict=True),
        Carry("_earlier", F.col("_k"), strict=True),
    ]
    following = carry(apply_cut(points, by, F.col("_k").cast("double"), cut), ["_k"], ahead)

    def segment(c: str, to_time: Column, to_value: Column) -> Column:
        line = F.struct(F.col("_k").alias("t0"), F.col(c).alias("v0"), to_time.alias("t1"), to_value.alias("v1"))
        return F.when(F.col(c).isNotNull(), line)

    def edge(last: Column, lead_in: bool) -> Column:
        return F.struct(F.col("_k").alias("t"), last.alias("last"), F.lit(lead_in).alias("lead_in"))

    row = {"_edge": edge(F.col("_ahead").isNull(), False)}
    first = {"_edge": edge(F.lit(False), True)}
    for c, n in names.items():
        to = F.col(f"_ahead_{c}")
        row[n] = segment(c, to["t"], to["v"])
        first[n] = segment(c, F.lit(None).cast("bigint"), F.lit(None).cast(right.schema[c].dataType))
    marks = _with_lead_in(following, by, row, first)
    us = micros(F.col(on))
    rows = left.withColumns({"_us": us, "_k": snap(us, grid_us) if grid_us else us, "_side": F.lit(LEFT)})
    seen = [Carry(f"_s{n}", F.col(n)) for n in names.values()] + [Carry("_seen_edge", F.col("_edge"))]
    picked = carry(_in_blocks(rows, marks, by, cut), ["_k", "_side"], seen).where(F.col("_side") == LEFT)
    inside = F.col("_us").isNotNull()
    if tolerance_us is not None:
        at = F.col("_seen_edge")
        too_early = at["lead_in"] & (at["t"] - F.col("_us") > tolerance_us)
        too_late = at["last"] & (F.col("_us") - at["t"] > tolerance_us)
        inside = inside & ~too_early & ~too_late
    out = []
    for c, n in names.items():
        line = F.col(f"_s{n}")
        value = lerp(F.col("_k"), line["t0"], line["v0"], line["t1"], line["v1"])
        out.append(F.when(inside, value).alias(c))
    return picked.select(*left.columns, *out)
