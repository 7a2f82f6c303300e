"""Cut the series of oversized keys into blocks, so that no key has to fit one task.

A window over a series normally puts all rows of a key into one task. Keys with more rows than a limit are cut at
quantiles of their own ordering column into consecutive blocks; windows then run per (key, block), and what must cross
a block border travels through a table with one row per block.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow.functions.clock import micros
from windrow.session import landed

BLOCK = "_block"
MIN_HOT_ROWS = 2_000_000
#: Rows of a block table up to which it is marked for broadcast (a few hundred bytes each).
MAX_BROADCAST_BLOCKS = 20_000


@dataclass(frozen=True)
class Blocked:
    """A DataFrame with its window keys; ``blocks`` bounds the number of blocks, 0 if no key is cut."""

    df: DataFrame
    by: list[str]
    blocks: int = 0

    @property
    def cut(self) -> bool:
        return self.blocks > 0

    @property
    def keys(self) -> list[str]:
        return [*self.by, BLOCK] if self.cut else self.by

    def hand_over(self, df: DataFrame, per_block: DataFrame) -> DataFrame:
        """Join a table with one row per block of the cut keys."""
        return attach(df, F.broadcast(per_block) if self.blocks <= MAX_BROADCAST_BLOCKS else per_block, self.keys)


def same_keys(keys: Sequence[str], prefix: str = "_key_") -> Column:
    """Condition that each key equals its prefixed twin, NULL equal to NULL."""
    return reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys], F.lit(True))


def twins(df: DataFrame, keys: Sequence[str], prefix: str = "_key_") -> DataFrame:
    return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], *[c for c in df.columns if c not in keys])


def attach(df: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join of ``small`` on ``keys`` with NULL matching NULL; the key columns of ``small`` are dropped.

    Without keys both sides are global results of one row.
    """
    return df.join(twins(small, keys), same_keys(keys), how).drop(*[f"_key_{k}" for k in keys])


def sortable_double(df: DataFrame, name: str) -> Column:
    """The ordering column as a double with the same order, for quantile cuts."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(F.col(name)).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("double")
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    raise TypeError(f"cannot cut a series ordered by {kind.simpleString()} column {name!r}; order by a number or a time")


#: Plans whose rows are counted without reading their columns, from the footers of files.
PLAIN_NODES = {"Project", "Filter", "Relation"}


def few_rows(df: DataFrame, most: int) -> bool:
    """Whether a plain scan has at most so many rows; other plans, which cost more to count, do not say."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = set(re.findall(r"(?m)^[ :+\-]*([A-Z][A-Za-z]*)", plan))
    return nodes <= PLAIN_NODES and df.count() <= most


def hot_keys(df: DataFrame, by: Sequence[str], min_rows: int) -> tuple[DataFrame, int, int] | None:
    """Keys with more than ``min_rows`` rows and their row counts ``_rows``, how many they are, and the largest count.

    One job over the key columns, spared where a scan has no more rows than that; None if there are none.
    """
    if few_rows(df, min_rows):
        return None
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    found = counts.agg(F.max("_rows").alias("largest"), F.count_if(F.col("_rows") > min_rows).alias("n")).first()
    if not found["n"]:
        return None
    return landed(counts.where(F.col("_rows") > min_rows), "hot-keys"), found["n"], found["largest"]


def settle(min_rows: int, by: Sequence[str], *tables: DataFrame) -> DataFrame | None:
    """The oversized keys of these tables together, or None: the census that later steps can be handed."""
    if not min_rows:
        return None
    together = reduce(DataFrame.unionByName, [t.select(*by, F.lit(1).alias("_one")) for t in tables])
    found = hot_keys(together, by, min_rows)
    return found[0] if found else None


@dataclass(frozen=True)
class Cut:
    """Where to cut: for each oversized key its increasing ``_borders``, and bounds of their numbers.

    ``_runs`` are positions that so many rows share that they have blocks of their own, with the number of blocks that
    such a run may be dealt to; ``_own`` is the number of blocks that the key's rows without position may be dealt to.
    """

    borders: DataFrame
    slices: int
    blocks: int


@dataclass(frozen=True)
class Deal:
    """Rows that see others but are seen by none: of one position, they may be in any order, so a run of them is dealt.

    ``rows`` says which rows these are and ``tie`` parts them. Other rows of the position come before them all, or
    behind them where ``late`` holds.
    """

    rows: Column
    tie: Column
    late: Column


def row_hash(df: DataFrame) -> Column:
    """What parts rows that share a position; maps have no hash."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def plan_cut(positions: DataFrame, by: Sequence[str], min_rows: int = MIN_HOT_ROWS) -> Cut | None:
    """Find oversized keys in a table of ``by`` and one more column, the position in the series, and their borders.

    Borders are quantiles of the key's own positions, twice as many as blocks of ``min_rows`` rows need. A position that
    several of them name is a run: it is cut off on both sides. ``min_rows=0`` skips the probe for keys known to be
    small. None means that nothing needs to be cut.
    """
    by = list(by)
    found = hot_keys(positions, by, min_rows) if min_rows else None
    if found is None:
        return None
    keys, n_hot, largest = found
    (name,) = [c for c in positions.columns if c not in by]
    slices = max(2, math.ceil(2 * largest / min_rows))
    shares = F.array(*[F.lit(i / slices) for i in range(1, slices)])
    points = F.percentile_approx(F.col(name).cast("double"), shares, F.lit(max(10_000, 8 * slices)))
    members = attach(positions, keys, by, "inner")
    own = F.ceil(F.col("_rows") * 2 / F.lit(min_rows))
    # A key with fewer rows keeps as many of the borders as it needs.
    kept = F.filter("_points", lambda _, i: F.floor((i + 1) * own / slices) > F.floor(i * own / slices))
    none = F.array().cast("array<double>")
    measured = members.groupBy(*by).agg(points.alias("_points"), F.first("_rows").alias("_rows"), F.count(name).alias("_placed"))
    named = measured.withColumns({"_kept": F.coalesce(F.filter(kept, lambda b: ~F.isnan(b)), none), "_own": own.cast("int")})
    # Points stand at shares of the placed rows; each stands for that many of its blocks.
    wide = F.greatest(F.ceil(F.col("_placed") * 2 / F.lit(min_rows) / (F.size("_kept") + 1)), F.lit(1))
    repeats = F.transform(F.array_distinct("_kept"), lambda b: F.struct(b.alias("at"), F.size(F.filter("_kept", lambda x: x == b)).alias("n")))
    runs = F.transform(F.filter(repeats, lambda r: r["n"] > 1), lambda r: F.struct(r["at"].alias("at"), ((r["n"] + 1) * wide).cast("int").alias("n")))
    before = F.transform("_runs", lambda r: r["at"] - F.greatest(F.abs(r["at"]) * F.lit(2.0**-53), F.lit(5e-324)))
    borders = named.withColumn("_runs", runs).select(*by, "_own", "_runs", F.array_sort(F.array_distinct(F.concat("_kept", before))).alias("_borders"))
    return Cut(landed(borders, "borders"), slices, n_hot * (5 * slices + 5))


def slice_of(position: Column, slices: int) -> Column:
    """How many of the row's ``_borders`` lie below ``position`` (0 for NULL): first by strides, then within one."""
    stride = max(1, math.isqrt(slices))
    borders = F.col("_borders")
    heads = F.filter(borders, lambda b, i: (i % stride == 0) & (b < position))
    start = F.greatest(F.size(heads) - 1, F.lit(0)) * stride
    within = F.filter(F.slice(borders, start + 1, F.lit(stride)), lambda b: b < position)
    return F.when(position.isNull(), 0).otherwise(start + F.size(within))


def apply_cut(df: DataFrame, by: Sequence[str], position: Column, cut: Cut | None, deal: Deal | None = None) -> Blocked:
    """Number the blocks of the oversized keys from 1; rows of other keys are in block 0.

    With ``deal``, runs of one position and rows without position, which match nothing, are dealt to several blocks.
    """
    by = list(by)
    if cut is None:
        return Blocked(df, by)
    joined = attach(df.withColumn("_position", position), cut.borders, by)
    slice_ = slice_of(F.col("_position"), cut.slices).cast("bigint")
    if deal is not None:
        run = F.get(F.filter("_runs", lambda r: r["at"] == F.col("_position")), F.lit(0))["n"]
        placed = F.when(deal.rows, 1 + F.pmod(deal.tie, run)).when(deal.late, run + 1).otherwise(0)
        lost = F.when(deal.rows, 1 + F.pmod(deal.tie, F.col("_own"))).otherwise(0)
        within = F.when(F.col("_position").isNull(), lost).when(run.isNotNull(), placed).otherwise(0)
        slice_ = slice_ * F.lit(4 * cut.slices + 4) + within.cast("bigint")
    block = F.when(F.col("_borders").isNotNull(), slice_ + 1).otherwise(0)
    return Blocked(joined.withColumn(BLOCK, block).drop("_borders", "_runs", "_own", "_position"), by, cut.blocks)


def cut_series(df: DataFrame, by: Sequence[str], order: Sequence[str], min_rows: int = MIN_HOT_ROWS, deal: Deal | None = None) -> Blocked:
    """Give every row a block number if some key of ``by`` is oversized; blocks follow the first column of ``order``."""
    if not min_rows:
        return Blocked(df, list(by))
    position = sortable_double(df, order[0])
    cut = plan_cut(df.select(*by, position.alias("_position")), by, min_rows)
    return apply_cut(df, by, position, cut, deal)
