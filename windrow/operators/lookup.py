"""Small dimension tables: intervals, dated factors, ramps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from windrow import presets
from windrow.functions.clock import day_of_year_date, micros
from windrow.functions.numeric import finite_or_null, lerp, to_number_strict
from windrow.operators.columns import update_non_null
from windrow.operators.fill import Carry, carry, running_sums
from windrow.operators.hot import MIN_HOT_ROWS, Deal, cut_series, row_hash
from windrow.session import landed

MAX_BROADCAST_INTERVALS = 1_000


def era_table(spark: SparkSession, eras: Sequence[tuple] = tuple(presets.ERAS)) -> DataFrame:
    rows = spark.createDataFrame(list(eras), "after string, until string, co2_mult double, h2o_mult double")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("after", "until")})


def period_table(spark: SparkSession, periods: Sequence[tuple] = tuple(presets.H2O_PERIODS)) -> DataFrame:
    rows = spark.createDataFrame(list(periods), "start string, end string, slope double, intercept double")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


def lookup_by_interval(
    df: DataFrame,
    table: DataFrame,
    on: str,
    start: str,
    end: str,
    bounds: str = "(]",
    defaults: Mapping[str, float] | None = None,
    max_broadcast: int | None = MAX_BROADCAST_INTERVALS,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add the other columns of ``table`` for the interval that holds ``on``; NULL ends are open.

    One row per row of ``df``. An interval counts up to its end or to where the next one starts; of intervals with one
    start, the one that ends last counts. A NULL ``on`` lies in no interval. Numbers, dates and times are compared in
    their own type. ``defaults`` apply where no interval matches; columns without one become NULL.

    Up to ``max_broadcast`` intervals (counted) are broadcast and compared with every row; more are put in line with
    the rows, and each row takes the last start before it. The result is the same. ``None`` says that the table is a
    short parameter table and spares the count.
    """
    if len(bounds) != 2 or bounds[0] not in "[(" or bounds[1] not in "])":
        raise ValueError(f"unknown bounds {bounds!r}")
    values = [c for c in table.columns if c not in (start, end)]
    named = table.select(F.col(start).alias("_start"), F.col(end).alias("_end"), F.struct(F.lit(1).alias("_one"), *values).alias("_row"))
    longest = Window.partitionBy("_start").orderBy(F.col("_end").desc_nulls_first())
    single = named.withColumn("_rank", F.row_number().over(longest)).where("_rank = 1").drop("_rank")
    below = F.col("_end") >= F.col("_on") if bounds[1] == "]" else F.col("_end") > F.col("_on")
    begun = F.col("_start") <= F.col("_on") if bounds[0] == "[" else F.col("_start") < F.col("_on")
    rows = df.withColumn("_on", F.col(on))
    if max_broadcast is None or single.limit(max_broadcast + 1).count() <= max_broadcast:
        following = single.withColumn("_next", F.lead("_start").over(Window.orderBy(F.col("_start").asc_nulls_first())))
        ended = F.col("_next") <= F.col("_on") if bounds[0] == "[" else F.col("_next") < F.col("_on")
        inside = F.coalesce(begun, F.lit(True)) & ~F.coalesce(ended, F.lit(False)) & F.col("_on").isNotNull()
        joined = rows.join(F.broadcast(following), inside, "left").withColumn("_seen", F.struct("_end", "_row"))
    else:
        # Starts stand before the rows of their own value where they are part of the interval, else after them.
        starts = single.select(F.col("_start").alias("_at"), F.lit(0 if bounds[0] == "[" else 2).alias("_side"), F.struct("_end", "_row").alias("_mark"))
        union = rows.withColumns({"_at": F.col("_on"), "_side": F.lit(1), "_tie": row_hash(df)}).unionByName(starts, allowMissingColumns=True)
        # An open start stands before everything; a NULL value is last of all NULLs and drops out below.
        deal = Deal(F.col("_side") == 1, F.col("_tie"), F.col("_side") == 2)
        joined = carry(cut_series(union, [], ["_at"], min_hot_rows, deal), ["_at", "_side"], [Carry("_seen", F.col("_mark"))]).where("_side = 1")
    held = F.when(F.col("_on").isNotNull() & F.col("_seen._row").isNotNull(), F.col("_seen"))
    found = joined.withColumn("_hit", held).withColumn("_end", F.col("_hit._end"))
    found = found.withColumn("_hit", F.when(F.coalesce(below, F.lit(True)), F.col("_hit")))
    filled = [F.coalesce(F.col(f"_hit._row.{c}"), F.lit(defaults[c])).alias(c) if c in (defaults or {}) else F.col(f"_hit._row.{c}").alias(c) for c in values]
    return found.select(*df.columns, *filled)


#: Rows and bytes (as text) up to which a table of intervals is broadcast by ``join_intervals``.
MAX_BROADCAST_BINNED, MAX_BROADCAST_BYTES = 100_000, 32 << 20


def whole_position(df: DataFrame, name: str) -> Column:
    """A time, date or whole number as a count of its smallest unit."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return micros(F.col(name))
    if isinstance(kind, T.DateType):
        return F.unix_date(F.col(name)).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return F.col(name).cast("bigint")
    raise TypeError(f"{kind.simpleString()} column {name!r} has no whole positions; use a time, a date or a whole number")


def half_open(table: DataFrame, start: str, end: str, bounds: str) -> DataFrame:
    """Intervals with ``_from`` (included) and ``_to`` (excluded) in whole units; NULL ends stay open, empty ones drop out."""
    if len(bounds) != 2 or bounds[0] not in "[(" or bounds[1] not in "])":
        raise ValueError(f"unknown bounds {bounds!r}")
    placed = table.withColumns({"_from": whole_position(table, start) + int(bounds[0] == "("), "_to": whole_position(table, end) + int(bounds[1] == "]")})
    return placed.where("_from IS NULL OR _to IS NULL OR _from < _to")


def _bin_join(rows: DataFrame, ends: DataFrame, most_rows: int) -> DataFrame:
    """Rows (with ``_at``) and the intervals (``_from``, ``_to``) that hold them, by equality of bins and a condition.

    An interval of up to 2**n units stands in the one or two bins of 2**n units that it touches. A row looks into its
    bin of each width in use, of which there are 63 at most, whatever the lengths.
    """
    low, high = (F.col("_from"), F.col("_to"))
    if ends.where(low.isNull() | high.isNull()).limit(1).count():
        first, last = rows.agg(F.min("_at"), F.max("_at")).first()
        ends = ends.withColumns({"_from": F.coalesce(low, F.lit(first or 0)), "_to": F.coalesce(high, F.lit((last or 0) + 1))}).where("_from < _to")
    levelled = ends.withColumn("_level", F.char_length(F.bin(F.col("_to") - F.col("_from") - 1)))
    levels = sorted(r[0] for r in levelled.select("_level").distinct().collect())
    of = lambda position: F.call_function("shiftright", position, F.col("_level"))
    placed = levelled.withColumn("_bin", F.explode(F.array_distinct(F.array(of(F.col("_from")), of(F.col("_to") - 1)))))
    looked = rows.where("_at IS NOT NULL").withColumn("_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    n, size = placed.limit(most_rows + 1).agg(F.count(F.lit(1)), F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()
    small = F.broadcast(placed) if n <= most_rows and (size or 0) <= MAX_BROADCAST_BYTES else placed
    return looked.withColumn("_bin", of(F.col("_at"))).join(small, ["_level", "_bin"]).where("_from <= _at AND _at < _to").drop("_level", "_bin")


def join_intervals(
    df: DataFrame, table: DataFrame, on: str, start: str, end: str, bounds: str = "(]", max_broadcast: int = MAX_BROADCAST_BINNED,
    totals: Mapping[str, str | None] | None = None, min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Every row of ``df`` once for each interval of ``table`` that holds ``on``, with all columns of both.

    Intervals may overlap in any way; NULL ends are open; rows in no interval, and those without ``on``, drop out. The
    position is a time, a date or a whole number. Up to ``max_broadcast`` entries (and a bound on bytes) are broadcast,
    more are shuffled by bin; neither compares all rows with all intervals.

    With ``totals`` a row comes once, with what its pairs come to: under each name the sum of a whole-numbered column of
    ``table`` over the intervals that hold the row, or their number where None is given. Pairs grow with the square of
    dense tables and are not written out for that: totals change at the ends of intervals only, so they are summed along
    these, and rows look up the piece between two ends that they are in.
    """
    placed = df.withColumn("_at", whole_position(df, on))
    ends = half_open(table, start, end, bounds)
    if totals is not None:
        return _join_totals(placed, ends, totals, max_broadcast, min_hot_rows).select(*df.columns, *totals)
    clash = set(df.columns) & set(table.columns)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    return _bin_join(placed, ends, max_broadcast).select(*df.columns, *table.columns)


def _join_totals(rows: DataFrame, ends: DataFrame, totals: Mapping[str, str | None], max_broadcast: int, min_hot_rows: int) -> DataFrame:
    """Rows (with ``_at``) that lie in intervals (``_from``, ``_to``), and the totals of those."""
    clash = set(rows.columns) & set(totals)
    if clash:
        raise ValueError(f"there are columns {sorted(clash)} already")
    summed = [c for c in dict.fromkeys(totals.values()) if c is not None]
    for c in summed:
        if not isinstance(ends.schema[c].dataType, T.IntegralType):
            raise TypeError(f"{ends.schema[c].dataType.simpleString()} column {c!r} has no exact running sum; use a whole number")
    # What an interval adds where it starts, and takes away where it ends: one, each column, and one where that is known.
    parts = {"_n": F.lit(1).cast("bigint")}
    for i, c in enumerate(summed):
        parts |= {f"_sum{i}": F.coalesce(F.col(c).cast("bigint"), F.lit(0)), f"_known{i}": F.col(c).isNotNull().cast("bigint")}
    starts = ends.select(F.col("_from").alias("_begin"), *[x.alias(k) for k, x in parts.items()])
    stops = ends.where("_to IS NOT NULL").select(F.col("_to").alias("_begin"), *[(-x).alias(k) for k, x in parts.items()])
    changes = landed(starts.unionByName(stops).groupBy("_begin").agg(*[F.sum(k).alias(k) for k in parts]), "interval-ends")
    pieces = running_sums(changes, [], ["_begin"], list(parts), min_hot_rows)
    n = changes.count()
    # A piece stands in two bins at most, and a number takes up to 24 bytes of text with its name.
    if n <= max_broadcast and n * 2 * 24 * (len(parts) + 4) <= MAX_BROADCAST_BYTES:
        following = F.lead("_begin").over(Window.orderBy(F.col("_begin").asc_nulls_first()))
        closed = pieces.select(F.col("_begin").alias("_from"), following.alias("_to"), *parts).where("_n > 0")
        found = _bin_join(rows, closed, 2 * max_broadcast)
    else:
        whole = landed(pieces.withColumn("_until", F.lit(None).cast("bigint")), "interval-pieces")
        most = min(max_broadcast, MAX_BROADCAST_INTERVALS)
        found = lookup_by_interval(rows, whole, "_at", "_begin", "_until", "[)", None, most, min_hot_rows).where("_n > 0")
    of = {c: F.when(F.col(f"_known{i}") > 0, F.col(f"_sum{i}")) for i, c in enumerate(summed)} | {None: F.col("_n")}
    return found.withColumns({name: of[c] for name, c in totals.items()})


def lookup_first(
    df: DataFrame, table: DataFrame, on: str, start: str, end: str, order: Sequence[str], bounds: str = "(]",
    defaults: Mapping[str, float] | None = None, max_broadcast: int | None = MAX_BROADCAST_INTERVALS, min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Add the other columns of the first interval, by ``order``, of those that hold ``on``; one row per row of ``df``.

    The table is resolved first: between two neighbouring ends the same interval is first everywhere. The rows then
    look up these pieces, which do not overlap, as in ``lookup_by_interval``.
    """
    values = [c for c in table.columns if c not in (start, end)]
    pieces = landed(_first_pieces(half_open(table, start, end, bounds), values, order), "first-pieces")
    found = lookup_by_interval(df.withColumn("_whole", whole_position(df, on)), pieces, "_whole", "_begin", "_until", "[)", defaults, max_broadcast, min_hot_rows)
    return found.drop("_whole")


#: Intervals that are cut into nodes in one task; each is some dozens of nodes at most in practice, 124 in any case.
SPANS_PER_TASK = 50_000


def _first_pieces(ends: DataFrame, values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first interval by ``order`` from each end to the next, as ``_begin``, an open ``_until``, and its values.

    Ends are not compared with the intervals that hold them, whose number grows with the square of dense tables. An
    interval is the disjoint union of at most two nodes of each width 2**n, [k * 2**n, (k + 1) * 2**n). Every node keeps
    the first of its intervals, and an end takes the first of the nodes that it lies in, one of each width.
    """
    low, high = F.col("_from"), F.col("_to")
    known = (F.min(F.least(low, high)), F.max(F.greatest(low, high)), F.max(high - low), F.count(F.lit(1)), F.count_if(low.isNull() | high.isNull()))
    first, last, longest, n, n_open = ends.agg(*known).first()
    first, last = first or 0, last or 0
    # Open intervals start before the first end, or last beyond the last one.
    closed = ends.withColumns({"_from": F.coalesce(low, F.lit(first - 1)), "_to": F.coalesce(high, F.lit(last + 1))})
    points = closed.select(F.col("_from").alias("_at")).unionByName(ends.where(high.isNotNull()).select(high.alias("_at"))).distinct()
    widest = (max(longest or 1, last - first + 2) if n_open else longest or 1).bit_length()
    shift = lambda x, by: F.call_function("shiftright", x, by)

    def nodes(level: Column) -> Column:
        """Those of one width: a left one and a right one where the rest of the interval begins or ends within the next wider node."""
        left, right = -shift(-low, level), shift(high, level)
        is_left, is_right = F.pmod(left, F.lit(2)) == 1, F.pmod(right, F.lit(2)) == 1
        node = lambda k, there: F.when(there & (left < right), F.struct(level.alias("_level"), k.alias("_bin")))
        # One node that is both counts once.
        return F.array(node(left, is_left), node(right - 1, is_right & ~(is_left & (left == right - 1))))

    # Hashed first, into so many tasks that none has to sort more than a bounded number of nodes.
    spread = closed.repartition(max(1, -(-n // SPANS_PER_TASK)), "_from", "_to", *order)
    levels = F.sequence(F.lit(0), F.char_length(F.bin(high - low)) - 1)
    cut = spread.withColumn("_node", F.explode(F.filter(F.flatten(F.transform(levels, nodes)), lambda x: x.isNotNull())))
    best = (F.min_by(F.struct(*values), F.struct(*order)).alias("_first"), F.min(F.struct(*order)).alias("_order"))
    kept = cut.groupBy(F.col("_node._level").alias("_level"), F.col("_node._bin").alias("_bin")).agg(*best)
    looked = points.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(widest - 1))))
    held = looked.withColumn("_bin", shift(F.col("_at"), F.col("_level"))).join(kept, ["_level", "_bin"])
    found = points.join(held.groupBy("_at").agg(F.min_by("_first", "_order").alias("_first")), "_at", "left")
    begin = F.when(F.col("_at") >= first, F.col("_at")).alias("_begin")
    return found.select(begin, F.lit(None).cast("bigint").alias("_until"), *[F.col(f"_first.{c}").alias(c) for c in values])


def period_linear(
    df: DataFrame, table: DataFrame, on: str, col: str, bounds: str = "[]", max_broadcast: int | None = MAX_BROADCAST_INTERVALS
) -> DataFrame:
    """``slope * col + intercept`` with the parameters of the period that holds ``on``, unchanged in gaps."""
    joined = lookup_by_interval(df, table, on, "start", "end", bounds, {"slope": 1.0, "intercept": 0.0}, max_broadcast)
    corrected = F.col("slope") * F.col(col) + F.col("intercept")
    return update_non_null(joined, {col: corrected}).select(*df.columns)


def segment_dates(df: DataFrame) -> DataFrame:
    """First and last day of factor segments given as year and day-of-year offset; the end day is excluded."""
    return df.withColumns(
        {
            "start_date": day_of_year_date(F.col("year_from"), F.col("doy_from")),
            "end_date": F.date_add(day_of_year_date(F.col("year_to"), F.col("doy_to")), F.lit(-1)),
        }
    )


def expand_ramp(
    segments: DataFrame,
    out: str = "factor",
    start: str = "start_date",
    end: str = "end_date",
    first: str = "factor_from",
    last: str = "factor_to",
    by: Sequence[str] = (),
) -> DataFrame:
    """One value per day on the line through the two ends of each segment.

    Segments are a parameter table (tens of rows). Gaps between them are bridged by a line too; on a day that ends
    one segment and starts another, the later segment counts, and its end before its start.
    """
    anchors = segments.select(
        *by,
        F.explode(
            F.array(
                F.struct(F.col(start).alias("date"), F.col(start).alias("seg"), F.lit(0).alias("is_end"),
                         F.col(first).alias("value")),
                F.struct(F.col(end).alias("date"), F.col(start).alias("seg"), F.lit(1).alias("is_end"),
                         F.col(last).alias("value")),
            )
        ).alias("a"),
    )
    unique = anchors.groupBy(*by, F.col("a.date").alias("date")).agg(
        F.max_by("a.value", F.struct("a.seg", "a.is_end")).alias("value")
    )
    w = Window.partitionBy(*by).orderBy("date")
    lines = unique.withColumns({"_date1": F.lead("date").over(w), "_value1": F.lead("value").over(w)})
    until = F.coalesce(F.date_add("_date1", F.lit(-1)), F.col("date"))
    days = lines.withColumn("_day", F.explode(F.sequence("date", until, F.expr("interval 1 day"))))
    at, start_day, end_day = (F.unix_date(F.col(c)) for c in ("_day", "date", "_date1"))
    value = lerp(at, start_day, F.col("value"), end_day, F.col("_value1"))
    return days.select(*by, F.col("_day").alias("date"), value.alias(out))


def daily_factors(table: DataFrame, scalar: str) -> DataFrame:
    """Daily factors of one gas from its segment table, numbers checked strictly."""
    numbers = ("year_from", "doy_from", "year_to", "doy_to", "factor_from", "factor_to")
    checked = {c: to_number_strict(F.col(c)) for c in numbers if table.schema[c].dataType.simpleString() == "string"}
    return expand_ramp(segment_dates(table.withColumns(checked)), f"{scalar}_factor")


def combine_factors(left: DataFrame, right: DataFrame, on: str = "date") -> DataFrame:
    """Both factor tables side by side, days of either one kept."""
    return left.join(right, on, "full_outer")


def apply_dated_factor(
    df: DataFrame, factors: DataFrame, date: str, cols: Mapping[str, str], on: str = "date", on_missing: str = "flag"
) -> DataFrame:
    """Multiply each column of ``cols`` by its factor column on the day ``date``.

    A NULL product leaves the old value. ``on_missing`` is ``flag`` (boolean column ``factor_missing`` for days
    outside the table) or ``error``.
    """
    wanted = factors.select(F.col(on).alias("_date"), F.lit(True).alias("_found"), *dict.fromkeys(cols.values()))
    joined = df.join(wanted, F.col(date) == F.col("_date"), "left")
    missing = F.col("_found").isNull()
    if on_missing == "error":
        message = F.concat(F.lit("no factor for "), F.coalesce(F.col(date).cast("string"), F.lit("NULL")))
        joined = joined.withColumn("factor_missing", F.when(missing, F.raise_error(message).cast("boolean")).otherwise(False))
    else:
        joined = joined.withColumn("factor_missing", missing)
    updated = update_non_null(joined, {c: finite_or_null(F.col(c) * F.col(f)) for c, f in cols.items()})
    return updated.select(*df.columns, "factor_missing")
