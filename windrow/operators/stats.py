"""Summary statistics per group and what is derived from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrow.functions.numeric import decode_number
from windrow.operators.hot import BLOCK, apply_cut, attach, hot_keys, plan_cut
from windrow.presets import MISSING_NUMBER

QUANTILES = {"q01": 0.01, "q05": 0.05, "median": 0.5, "q95": 0.95, "q99": 0.99}
BASIC = ("count", "min", "max", "mean", "std")
STATS = ("count", "min", "max", "mean", "std", "median", "q01", "q05", "q95", "q99")
MAX_PERCENTILE_ROWS = 5_000_000
#: Size of the quantile sketches, and the rank error that 99 of 100 quantiles stay below.
SKETCH_K, SKETCH_ERROR = 200, 0.0133
#: Parts of a summary that can be merged beside count, min, max and mean: squared deviations from the mean, a sketch.
MERGEABLE: dict[str, Callable[[Column], Column]] = {
    "m2": lambda c: F.var_pop(c) * F.count(c),
    "sketch": lambda c: F.kll_sketch_agg_double(F.when(~F.isnan(c), c), SKETCH_K),
}


def _basic(c: str) -> dict[str, Column]:
    return {
        "count": F.count(c),
        "min": F.min(c),
        "max": F.max(c),
        "mean": F.avg(c),
        "std": F.stddev_samp(c),
    }


def _name(col: str, stat: str) -> str:
    return f"{col}__{stat}"


def ranked_quantiles(df: DataFrame, by: Sequence[str], probabilities: Sequence[float], min_rows: int) -> DataFrame:
    """Exact interpolated quantiles of the column ``_v`` of groups too large for one task, as an array ``_quantiles``.

    Equal values are counted before the shuffle. The counted values of a group are cut at quantiles of that group;
    totals per slice tell which slices hold the wanted ranks, and only those are sorted.
    """
    by = list(by)
    values = df.where(F.col("_v").isNotNull()).select(*by, "_v")
    cut = plan_cut(values, by, min_rows)
    counted = values.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    series = apply_cut(counted, by, F.col("_v"), cut)
    sliced = series.df if series.cut else series.df.withColumn(BLOCK, F.lit(0))

    totals = sliced.groupBy(*by, BLOCK).agg(F.sum("_n").alias("_m"))
    everything = Window.partitionBy(*by)
    earlier = everything.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    placed = totals.withColumns(
        {"_before": F.coalesce(F.sum("_m").over(earlier), F.lit(0)), "_total": F.sum("_m").over(everything)}
    )
    targets = F.array(
        *[
            F.struct(
                F.lit(i).alias("i"),
                F.lit(side).alias("side"),
                getattr(F, side)(F.lit(p) * (F.col("_total") - 1)).cast("bigint").alias("rank"),
            )
            for i, p in enumerate(probabilities)
            for side in ("floor", "ceil")
        ]
    )
    in_slice = F.filter(
        targets, lambda t: (t["rank"] >= F.col("_before")) & (t["rank"] < F.col("_before") + F.col("_m"))
    )
    wanted = placed.select(*by, BLOCK, "_before", "_total", in_slice.alias("_targets")).where(F.size("_targets") > 0)
    rows = attach(sliced, wanted, [*by, BLOCK], "inner")
    running = Window.partitionBy(*by, BLOCK).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    reached = rows.withColumn("_upto", F.col("_before") + F.sum("_n").over(running))
    hits = F.filter(
        "_targets", lambda t: (t["rank"] < F.col("_upto")) & (t["rank"] >= F.col("_upto") - F.col("_n"))
    )
    picked = reached.select(*by, "_v", "_total", F.explode(hits).alias("_t"))
    ends = {}
    for i, p in enumerate(probabilities):
        low, high = (
            F.max(F.when((F.col("_t.i") == i) & (F.col("_t.side") == side), F.col("_v"))) for side in ("floor", "ceil")
        )
        position = F.lit(p) * (F.max("_total") - 1)
        # The same sum as in the built-in percentile, so that infinite values give the same too.
        between = (F.ceil(position) - position) * low + (position - F.floor(position)) * high
        ends[p] = F.when(low == high, low).otherwise(between)
    return picked.groupBy(*by).agg(F.array(*ends.values()).alias("_quantiles"))


def _with_ranked(base: DataFrame, df: DataFrame, by, cols, keys, max_rows) -> DataFrame:
    """Fill the quantiles of the groups listed in ``keys`` into the summary ``base``; all columns in one pass."""
    members = attach(df, keys.select(*by), by, "left_semi") if by else df
    pairs = F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).alias("_v")) for c in cols])
    ranked = ranked_quantiles(members.select(*by, F.inline(pairs)), [*by, "_c"], list(QUANTILES.values()), max_rows)
    wide = ranked.groupBy(*by).agg(*[F.max(F.when(F.col("_c") == c, F.col("_quantiles"))).alias(f"_ranked_{c}") for c in cols])
    joined = attach(base, wide, by)
    filled = {f"_q_{c}": F.coalesce(f"_ranked_{c}", f"_q_{c}") for c in cols}
    return joined.withColumns(filled).drop(*[f"_ranked_{c}" for c in cols])


def summarize(
    df: DataFrame,
    by: Sequence[str],
    cols: Sequence[str],
    extra: Mapping[str, Callable[[Column], Column]] | None = None,
    groups: DataFrame | None = None,
    missing: Sequence[float] = (MISSING_NUMBER,),
    exact: bool = True,
    max_percentile_rows: int | None = MAX_PERCENTILE_ROWS,
) -> DataFrame:
    """Ten statistics of every column per group, one row per group with columns named ``col__stat``.

    ``extra`` adds statistics: a callable gets the column and returns an aggregate. ``groups`` lists groups that
    shall appear even if ``df`` has no row for them; groups that are not listed stay. Quantiles interpolate linearly; ``exact=False`` uses sketches.
    Groups above ``max_percentile_rows`` get their exact quantiles by ranked slices, since the built-in percentile
    would hold all their values in one task; None skips the probe when group sizes are known to be small.
    """
    by, cols, extra = list(by), list(cols), dict(extra or {})
    clean = df.select(*by, *[decode_number(F.col(c).cast("double"), missing).alias(c) for c in cols])
    found = hot_keys(clean, by, max_percentile_rows) if exact and max_percentile_rows else None

    shares = F.array(*[F.lit(p) for p in QUANTILES.values()])
    measured, source = [], clean
    if found is not None:
        flags = found[0].select(*by, F.lit(True).alias("_hot"))
        source = attach(clean, flags, by).withColumn("_hot", F.coalesce("_hot", F.lit(False)))
    for c in cols:
        measured += [agg.alias(_name(c, s)) for s, agg in _basic(c).items()]
        measured += [make(F.col(c)).alias(_name(c, s)) for s, make in extra.items()]
        if not exact:
            measured.append(F.percentile_approx(c, shares, F.lit(10_000)).alias(f"_q_{c}"))
        else:
            small = F.col(c) if found is None else F.when(~F.col("_hot"), F.col(c))
            measured.append(F.percentile(small, shares).alias(f"_q_{c}"))
    base = source.groupBy(*by).agg(*measured)
    if found is not None:
        base = _with_ranked(base, clean, by, cols, found[0], max_percentile_rows)

    out = []
    for c in cols:
        parts = {s: F.get(F.col(f"_q_{c}"), F.lit(i)).alias(_name(c, s)) for i, s in enumerate(QUANTILES)}
        out += [parts[s] if s in parts else F.col(_name(c, s)) for s in (*STATS, *extra)]
    wide = base.select(*by, *out)
    if groups is None:
        return wide
    counts = [_name(c, "count") for c in cols]
    empty = attach(groups.select(*by).distinct(), wide.select(*by), by, "left_anti")
    return wide.unionByName(empty.withColumns({c: F.lit(0).cast("bigint") for c in counts}), allowMissingColumns=True)


def merge_summaries(parts: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Summaries of larger groups from those of smaller ones (``summarize`` with ``extra=MERGEABLE``), without their rows.

    Count, min, max, mean and deviation are those of the rows: squared deviations of the parts are added, and those of
    their means from the common mean, which is known first. Quantiles come from merged sketches; their rank is off by
    ``SKETCH_ERROR`` or less in 99 of 100 cases, and they are not interpolated. The result has the parts that a further
    merge needs, so days can be merged to months. Parts without values count as none; a NULL group is one like others.
    """
    by, cols = list(by), list(cols)
    n = {c: F.coalesce(_name(c, "count"), F.lit(0)) for c in cols}
    totals = [F.sum(n[c]).alias(f"_n_{c}") for c in cols]
    totals += [F.sum(n[c] * F.col(_name(c, "mean"))).alias(f"_sum_{c}") for c in cols]
    means = parts.groupBy(*by).agg(*totals)
    means = means.select(*by, *[F.when(F.col(f"_n_{c}") > 0, F.col(f"_sum_{c}") / F.col(f"_n_{c}")).alias(f"_mean_{c}") for c in cols])
    met = attach(parts, means, by)
    merged = []
    for c in cols:
        apart = F.col(_name(c, "mean")) - F.col(f"_mean_{c}")
        merged += [
            F.sum(n[c]).alias(_name(c, "count")),
            F.min(_name(c, "min")).alias(_name(c, "min")),
            F.max(_name(c, "max")).alias(_name(c, "max")),
            F.first(f"_mean_{c}", ignorenulls=True).alias(_name(c, "mean")),
            F.sum(F.col(_name(c, "m2")) + n[c] * apart * apart).alias(_name(c, "m2")),
            F.kll_merge_agg_double(_name(c, "sketch")).alias(_name(c, "sketch")),
        ]
    return finish_summaries(met.groupBy(*by).agg(*merged), by, cols)


def without_parts(wide: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Only the ten statistics."""
    return wide.select(*by, *[_name(c, s) for c in cols for s in STATS])


def finish_summaries(merged: DataFrame, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The ten statistics of merged parts, and the parts."""
    out = []
    for c in cols:
        count, known = F.col(_name(c, "count")), F.col(_name(c, "count")) > 0
        out += [F.col(_name(c, s)) for s in ("count", "min", "max", "mean")]
        out.append(F.when(count > 1, F.sqrt(F.col(_name(c, "m2")) / (count - 1))).alias(_name(c, "std")))
        quantile = {s: F.when(known, F.kll_sketch_get_quantile_double(_name(c, "sketch"), F.lit(p))) for s, p in QUANTILES.items()}
        out += [quantile[s].alias(_name(c, s)) for s in STATS if s in quantile]
        out += [F.col(_name(c, s)) for s in MERGEABLE]
    return merged.select(*by, *out)


def to_long(wide: DataFrame, by: Sequence[str], cols: Sequence[str], units: Mapping[str, str] | None = None, extra: Sequence[str] = ()) -> DataFrame:
    """One row per group and variable from the wide summary."""
    units = units or {}
    stats = (*STATS, *extra)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.lit(units.get(c, "[-]")).alias("unit"),
                *[F.col(_name(c, s)).alias(s) for s in stats],
            )
            for c in cols
        ]
    )
    return wide.select(*by, F.inline(rows))


def bin_summarize(df: DataFrame, ts: str, width: str, cols: Sequence[str], by: Sequence[str] = (), out: str = "bin", **options):
    """Summary per time bin of a fixed width, such as ``30 minutes``."""
    binned = df.withColumn(out, F.window(ts, width)["start"])
    return summarize(binned, [*by, out], cols, **options)


def annotations(long: DataFrame, by: Sequence[str]) -> DataFrame:
    """The five figures shown next to a plotted series."""
    return long.select(*by, "variable", "unit", "count", "median", "mean", "min", "max")


def robust_bounds(long: DataFrame) -> DataFrame:
    """Axis range per variable that outliers of single files do not widen."""
    return long.groupBy("variable", "unit").agg(F.min("q01").alias("lower"), F.max("q99").alias("upper"))


def trend_bands(long: DataFrame, time: str, by: Sequence[str] = ()) -> DataFrame:
    """Median, percentile band, mean with its spread and count over time, per variable."""
    return long.select(
        *by,
        "variable",
        "unit",
        time,
        "median",
        "q05",
        "q95",
        "mean",
        (F.col("mean") - F.col("std")).alias("mean_minus_std"),
        (F.col("mean") + F.col("std")).alias("mean_plus_std"),
        "count",
    )


def distinct_variables(long: DataFrame) -> DataFrame:
    return long.select("variable", "unit").distinct()
