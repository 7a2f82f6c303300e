"""The operators on the shared test tables.

An hour of ``events`` plays a file, its ``signup`` rows the slow channel, the others the fast one; the texts of
``documents`` play file contents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow import presets
from windrow.functions import clock, numeric, physics
from windrow.functions.escapes import decode_escapes
from windrow.operators import asof, columns, fill, lookup, quality, stats
from windrow.operators.hot import MIN_HOT_ROWS, settle
from windrow.plans import convert
from windrow.session import new_path
from windrow.sources import factors, files, sinks

LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_UNITS = {"l_quantity": "[pcs]", "l_extendedprice": "[usd]", "l_discount": "[1]", "l_tax": "[1]"}
# Sample period of the played series: about two minutes, not a whole number of microseconds.
PLAYED_PERIOD_PS = 120_000_000_768_000
PLAYED_TOLERANCE_US = 600_000_000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Statistics that come from sums; counts, minima and maxima do not.
SUMMED = ("mean", "std", "median", "q01", "q05", "q95", "q99")


def steady(df: DataFrame, *cols: str) -> DataFrame:
    """Columns that come from sums, whose order engines choose, cut to 28 binary digits (8 decimal ones).

    Sums differ by about 2**-52 with their order; at 28 digits one value in 10**7 falls on the other side of a cut. A
    binary cut, since means of prices often lie exactly between two decimal numbers. Everything else is compared whole.
    """
    return df.withColumns({c: F.col(c) * 33554433.0 - (F.col(c) * 33554433.0 - F.col(c)) for c in cols})


def steady_wide(df: DataFrame, *variables: str) -> DataFrame:
    return steady(df, *[f"{v}__{s}" for v in variables for s in SUMMED])


HOUR_US = 3_600_000_000


def hour(ts: str = "ts"):
    return clock.truncated(F.col(ts), HOUR_US)


def hourly(spark, sf):
    return table(spark, sf, "events").withColumn("hour", hour())


def gappy(spark, sf):
    """Events with three of five values missing."""
    value = F.when(F.col("event_id") % 5 >= 3, F.col("value"))
    return table(spark, sf, "events").select("event_type", "ts", "event_id", value.alias("value"))


# Statistics


def hour_summary(spark, sf):
    return stats.summarize(hourly(spark, sf), ["hour"], ["value"])


def hour_long(spark, sf):
    return stats.to_long(hour_summary(spark, sf), ["hour"], ["value"], {"value": "[V]"})


def summary_by_hour(spark, sf):
    return steady_wide(hour_summary(spark, sf), "value")


def summary_by_type(spark, sf):
    return steady_wide(stats.summarize(table(spark, sf, "events"), ["event_type"], ["value"]), "value")


def summary_empty_groups(spark, sf):
    events = hourly(spark, sf)
    ends = events.agg(F.min("hour").alias("a"), F.max("hour").alias("b"))
    hours = ends.select(F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("hour"))
    types = F.array(*[F.lit(t) for t in ("view", "click", "signup", "error", "purchase", "refund")])
    grid = hours.select("hour", F.explode(types).alias("event_type"))
    return steady_wide(stats.summarize(events, ["hour", "event_type"], ["value"], groups=grid), "value")


def merged_summary(spark, sf):
    """Statistics per day from those per hour, and whether the sketches' quantiles have the right rank among the values.

    Twice the usual rank error is allowed, which chance does not reach.
    """
    events = hourly(spark, sf)
    hours = stats.summarize(events, ["hour"], ["value"], stats.MERGEABLE).withColumn("day", F.to_date("hour"))
    merged = stats.merge_summaries(hours, ["day"], ["value"])
    dated = events.select(F.to_date("hour").alias("day"), "value").where("value IS NOT NULL")
    placed = dated.join(merged.select("day", *[f"value__{q}" for q in stats.QUANTILES]), "day")
    ranks = []
    for q, p in stats.QUANTILES.items():
        below, upto = (F.count_if(c) / F.count(F.lit(1)) for c in (F.col("value") < F.col(f"value__{q}"), F.col("value") <= F.col(f"value__{q}")))
        ranks.append(((below - p <= 2 * stats.SKETCH_ERROR) & (p - upto <= 2 * stats.SKETCH_ERROR)).alias(f"{q}_in_rank"))
    found = merged.join(placed.groupBy("day").agg(*ranks), "day")
    basic = {s: F.col(f"value__{s}").alias(s) for s in stats.BASIC}
    return steady(found.select("day", *basic.values(), *[f"{q}_in_rank" for q in stats.QUANTILES]), "mean", "std")


def line_wide(spark, sf):
    extra = {"spread": lambda c: F.max(c) - F.min(c)}
    return stats.summarize(table(spark, sf, "lineitem"), ["l_returnflag"], list(LINE_COLUMNS), extra)


def line_long(spark, sf):
    return stats.to_long(line_wide(spark, sf), ["l_returnflag"], list(LINE_COLUMNS), LINE_UNITS, ["spread"])


def summary_lineitem(spark, sf):
    return steady(line_long(spark, sf), *SUMMED)


def halfhour_summary(spark, sf):
    return steady_wide(stats.bin_summarize(table(spark, sf, "events"), "ts", "30 minutes", ["value"]), "value")


def robust_bounds(spark, sf):
    return steady(stats.robust_bounds(hour_long(spark, sf)), "lower", "upper")


def trend_bands(spark, sf):
    return steady(stats.trend_bands(hour_long(spark, sf), "hour"), "median", "q05", "q95", "mean", "mean_minus_std", "mean_plus_std")


def annotations(spark, sf):
    return steady(stats.annotations(line_long(spark, sf), ["l_returnflag"]), "median", "mean")


def distinct_variables(spark, sf):
    return stats.distinct_variables(line_long(spark, sf))


# Columns and formulas


def sonic_temperature(spark, sf):
    raw = F.col("value") * 30.0 + 9000.0
    return table(spark, sf, "events").select("event_id", physics.sonic_temperature(raw).alias("t_sonic"))


def convert_units(spark, sf):
    sensors = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").alias("U"), F.col("l_discount").alias("V"), F.col("l_tax").alias("W"),
        (F.col("l_quantity") * 100.0 + 14000.0).alias("T_SONIC"), F.col("l_extendedprice").alias("CO2"),
        F.col("l_extendedprice").alias("H2O"), F.lit(0.33425).alias("co2_mult"), F.lit(0.335).alias("h2o_mult"),
    )
    return columns.convert_units(sensors).drop("co2_mult", "h2o_mult")


def calibrate_gas(spark, sf):
    """Analyser readings made from events; one user in forty reports no pressure at all, one a zero."""
    user = F.col("user_id") % 40
    readings = table(spark, sf, "events").select(
        "event_id",
        (F.col("value") * 4.0).alias("H2O"),
        (F.col("value") * 10.0 + 500.0).alias("CO2"),
        F.when(user == 7, 0.0).when(user != 9, user + 60.0).alias("Plic"),
        (F.col("event_id") % 25 + 10.0).alias("Tlic"),
    )
    return columns.calibrate_gas(readings).select("event_id", "H2O", "CO2", "calibrated")


def update_non_null(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    nan = F.lit(float("nan"))
    new = F.when(F.col("event_id") % 3 == 0, F.col("value") * 2).when(F.col("event_id") % 3 == 1, nan)
    return columns.update_non_null(events, {"value": new})


def era_multiplier(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    at = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    timed = orders.withColumn("start_ts", at.cast("timestamp_ntz"))
    defaults = {"co2_mult": 1.0, "h2o_mult": 1.0}
    return lookup.lookup_by_interval(timed, lookup.era_table(spark), "start_ts", "after", "until", "(]", defaults, None)


def period_linear(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    corrected = lookup.period_linear(orders, lookup.period_table(spark), "o_orderdate", "o_totalprice", max_broadcast=None)
    return corrected


def sentinel_roundtrip(spark, sf):
    marked = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 17 == 0, presets.MISSING_NUMBER).otherwise(F.col("value")).alias("reading"),
        F.when(F.col("event_id") % 13 == 0, presets.MISSING_TEXT).otherwise(F.col("event_type")).alias("mark"),
    )
    decoded = columns.decode_missing(marked, ["reading", "mark"])
    both = decoded.withColumn("written", F.col("reading"))
    return columns.encode_missing(both, ["written"])


def number_text():
    """Values as text, damaged in the ways files are."""
    text = F.col("value").cast("string")
    return (
        F.when(F.col("event_id") % 10 == 0, F.concat(F.col("event_type"), text))
        .when(F.col("event_id") % 10 == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(F.col("event_id") % 10 == 2, F.concat(text, F.lit("f")))
        .when(F.col("event_id") % 10 == 3, F.lit("NaN"))
        .when(F.col("event_id") % 10 == 4, F.replace(text, F.lit("."), F.lit(",")))
        .when(F.col("event_id") % 10 == 5, F.concat(text, F.lit("e1")))
        .otherwise(text)
    )


def coerce_numeric(spark, sf):
    texts = table(spark, sf, "events").select("event_id", number_text().alias("reading"))
    return columns.coerce_numeric(texts, ["reading"])


def strict_numeric(spark, sf):
    text = F.concat(F.lit(" "), F.col("value").cast("string"))
    return table(spark, sf, "events").select("event_id", numeric.to_number_strict(text).alias("reading"))


def sorted_columns(spark, sf):
    return columns.sort_columns(table(spark, sf, "lineitem"))


# Series


def row_index(spark, sf):
    return fill.row_index(hourly(spark, sf), ["hour"], ["ts", "event_id"]).select("event_id", "hour", "row_idx")


def time_axis(spark, sf):
    return fill.assign_time_axis(row_index(spark, sf), "hour", "row_idx", "axis_ts")


def ffill(spark, sf):
    return fill.ffill(gappy(spark, sf), ["event_type"], ["ts", "event_id"], ["value"])


def bfill(spark, sf):
    return fill.bfill(gappy(spark, sf), ["event_type"], ["ts", "event_id"], ["value"])


def bffill(spark, sf):
    return fill.bffill(gappy(spark, sf), ["event_type"], ["ts", "event_id"], ["value"])


def dedupe_last(spark, sf):
    return fill.dedupe_last(hourly(spark, sf), ["user_id", "hour"], ["ts", "event_id"]).drop("props")


def channels(spark, sf):
    """Fast and slow events of each day; the slow ones unique per second."""
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    fast = events.where("event_type <> 'signup'").select("event_id", "day", "ts", "value")
    slow = (
        events.where("event_type = 'signup'")
        .withColumn("at", clock.truncated(F.col("ts"), 1_000_000))
        .select("day", "at", "event_id", F.when(F.col("event_id") % 4 > 0, F.col("value")).alias("slow_value"),
                F.when(F.col("event_id") % 7 < 3, F.col("user_id").cast("double")).alias("slow_user"))
    )
    return fast, fill.dedupe_last(slow, ["day", "at"], ["event_id"]).withColumnRenamed("at", "ts")


def _asof(direction):
    def run(spark, sf):
        fast, slow = channels(spark, sf)
        right = slow.withColumnRenamed("event_id", "slow_id")
        return asof.asof_join(fast, right, "ts", ["day"], ["slow_id", "slow_value"], direction, 1_800_000_000, "slow_ts")

    return run


def interp_linear(spark, sf):
    fast, slow = channels(spark, sf)
    return asof.interpolate_linear(fast, slow, "ts", ["day"], ["slow_value", "slow_user"])


def align_slow(spark, sf):
    """Upsampled to 10 ms, read within half an hour of the slow range, then filled."""
    fast, slow = channels(spark, sf)
    cols = ["slow_value", "slow_user"]
    aligned = asof.interpolate_linear(fast, slow, "ts", ["day"], cols, 1_800_000_000, presets.GRID_US)
    return fill.bffill(aligned, ["day"], ["ts", "event_id"], cols)


# Factors


def monthly_segments(spark, sf):
    """One factor segment per order priority and month: from the mean to the largest price."""
    orders = table(spark, sf, "orders")
    return (
        orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("start_date"))
        .agg(
            (F.avg("o_totalprice") / 250_000).alias("factor_from"),
            (F.max("o_totalprice") / 250_000).alias("factor_to"),
        )
        .withColumn("end_date", F.last_day("start_date"))
    )


def ramp_daily(spark, sf):
    return steady(lookup.expand_ramp(monthly_segments(spark, sf), by=["o_orderpriority"]), "factor")


def factor_outer(spark, sf):
    """Two gases whose segments cover different priorities: days of either one stay."""
    ramps = lookup.expand_ramp(monthly_segments(spark, sf), by=["o_orderpriority"])
    upper = ramps.where("o_orderpriority < '3'").groupBy("date").agg(F.max("factor").alias("co2_factor"))
    lower = ramps.where("o_orderpriority >= '3'").groupBy("date").agg(F.min("factor").alias("h2o_factor"))
    return steady(lookup.combine_factors(upper, lower), "co2_factor", "h2o_factor")


def factor_join(spark, sf):
    ramps = lookup.expand_ramp(monthly_segments(spark, sf), by=["o_orderpriority"])
    factors = ramps.groupBy("date").agg(F.max("factor").alias("f"))
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("day"), "l_quantity"
    )
    return steady(lookup.apply_dated_factor(lines, factors, "day", {"l_quantity": "f"}), "l_quantity")


def lookup_long(spark, sf):
    """Each shipment in the two days from the last day of orders before it: more intervals than are broadcast."""
    days = table(spark, sf, "orders").groupBy(F.col("o_orderdate").alias("start")).agg(F.count("*").alias("n_orders"))
    days = days.withColumn("end", F.col("start") + F.expr("INTERVAL 2 DAYS"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return lookup.lookup_by_interval(lines, days, "l_shipdate", "start", "end", "[)", {"n_orders": 0})


def intervals_all(spark, sf):
    """How many order windows of up to eight hours, which overlap, hold each shipment, and the sum of their keys."""
    orders = table(spark, sf, "orders")
    begin = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    windows = orders.select("o_orderkey", begin.alias("begin")).withColumn("until", F.col("begin") + F.make_dt_interval(hours=(F.col("o_orderkey") % 9).cast("int")))
    at = F.col("l_shipdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", at.alias("at"))
    held = lookup.join_intervals(lines, windows, "at", "begin", "until", "(]", totals={"n_windows": None, "key_sum": "o_orderkey"})
    return held.groupBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "at").agg(F.sum("n_windows").alias("n_windows"), F.sum("key_sum").alias("key_sum"))


def lookup_first(spark, sf):
    """Each order with the customer of smallest key whose period of up to four months, one of many, holds its day."""
    start = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("c_custkey") * 7 % 2400).cast("int"))
    periods = table(spark, sf, "customer").select("c_custkey", start.alias("begin"), F.date_add(start, F.col("c_nationkey") * 5).alias("until"))
    orders = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return lookup.lookup_first(orders, periods, "day", "begin", "until", ["c_custkey"], "[]", {"c_custkey": -1})


def segment_dates(spark, sf):
    day = F.col("o_orderdate")
    segments = table(spark, sf, "orders").select(
        "o_orderkey",
        (F.year(day) + F.dayofyear(day) / 400).alias("year_from"),
        (F.dayofyear(day) - 1).alias("doy_from"),
        (F.year(day) + 0.5).alias("year_to"),
        (F.dayofyear(day) + 10).alias("doy_to"),
    )
    return lookup.segment_dates(segments).select("o_orderkey", "start_date", "end_date")


def factor_tables(spark, sf):
    """Monthly segments written as a text table of factors, read back, checked and spread over their days."""
    months = table(spark, sf, "orders").groupBy(F.trunc("o_orderdate", "month").alias("a"))
    segments = months.agg((F.avg("o_totalprice") / 250_000).alias("factor_from"), (F.max("o_totalprice") / 250_000).alias("factor_to"))
    given = segments.select(
        F.year("a").cast("double").alias("year_from"), (F.dayofyear("a") - 1).alias("doy_from"), F.year("a").cast("double").alias("year_to"),
        F.dayofyear(F.last_day("a")).alias("doy_to"), "factor_from", "factor_to",
    )
    path = new_path(spark, "factors")
    given.write.csv(path, header=True)
    return steady(lookup.daily_factors(factors.read_segments(spark, path), "h2o"), "h2o_factor")


# Sinks


def series_text(spark, sf):
    """Hourly files written as text with their unit line, read back line by line."""
    rows = row_index(spark, sf).join(table(spark, sf, "events").select("event_id", "user_id", "value"), "event_id")
    series = rows.select(F.concat(F.lit("h"), clock.label(F.col("hour"))).alias("file_id"), "row_idx", "event_id", F.when(F.col("event_id") % 9 > 0, F.col("value")).alias("x"))
    path = new_path(spark, "series")
    sinks.write_series(series, path, "csv", units={"x": "[V]"})
    return spark.read.csv(path, header=True, schema="event_id string, x string, file_id string")


def stats_text(spark, sf):
    """Statistics per hour written as text, read back."""
    wide = hour_summary(spark, sf).withColumnRenamed("hour", "start_ts")
    path = new_path(spark, "stats")
    sinks.write_stats(wide, path, units={"value": "[V]"})
    back = spark.read.csv(path, header=True, inferSchema=False)
    titles = {t: "bigint" if t == "count" else "double" for t in stats.STATS}
    read = back.select(F.col("TIMESTAMP").cast("timestamp_ntz").alias("hour"), *[F.col(f"value [V] {t}").cast(k).alias(t) for t, k in titles.items()])
    return steady(read, *SUMMED)


# Names, dates, texts


def file_names(events, kind, extension):
    """One file name per hour with an event of the kind."""
    stamp = F.date_format("hour", "yyMMdd_HH")
    named = events.where(F.col("event_type") == kind).select(F.concat(F.lit("Site"), stamp, F.lit(extension)).alias("name"))
    return named.distinct().withColumn("stem", files.stem(F.col("name")))


def pair_files(spark, sf):
    events = hourly(spark, sf)
    raw = file_names(events, "click", ".raw").withColumnRenamed("name", "raw_name")
    aux = file_names(events, "purchase", ".aux").withColumnRenamed("name", "aux_name")
    return files.pair_files(raw, aux).withColumn("start_ts", clock.file_time(F.col("raw_name")))


def filename_time(spark, sf):
    at = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    name = F.concat(F.lit("Site"), F.date_format(at, "yyMMdd_HH"), F.lit(".raw"))
    start = clock.file_time(F.col("name"))
    return table(spark, sf, "orders").select("o_orderkey", name.alias("name")).select(
        "o_orderkey", "name", start.alias("start_ts"), clock.file_date(F.col("name")).alias("file_date"),
        clock.label(start).alias("start_label"),
    )


def parse_dates(spark, sf):
    """Dates with two- and four-digit years and stray blanks, times with and without damage."""
    key = F.col("o_orderkey")
    short, full = F.date_format("o_orderdate", "dd.MM.yy"), F.date_format("o_orderdate", "d.M.yyyy")
    date = F.when(key % 3 == 0, short).when(key % 3 == 1, full).otherwise(F.concat(F.lit(" "), short, F.lit(" ")))
    clock_text = F.format_string("%02d:%02d:%02d", key % 26, key % 60, key % 7)
    texts = table(spark, sf, "orders").select("o_orderkey", date.alias("d"), clock_text.alias("t"))
    return texts.select(
        "o_orderkey", clock.date_from_text(F.col("d")).alias("parsed_date"),
        clock.timestamp_from_text(F.col("d"), F.col("t")).alias("parsed_ts"),
    )


def date_labels(spark, sf):
    return columns.date_labels(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


def document_tables(spark, sf, header_rows=2):
    """Documents read as blank-separated files with a header on top."""
    texts = table(spark, sf, "documents").select("doc_id", "text")
    return files.read_header(texts, "text", 0, header_rows, " ")


def parse_table(spark, sf):
    rows = files.explode_rows(document_tables(spark, sf), " ")
    return rows.select("doc_id", "row_idx", F.size("cells").alias("n_cells"), F.array_join("cells", "|").alias("row_cells"))


def reconcile_width(spark, sf):
    header = document_tables(spark, sf)
    generated = F.filter("header", lambda h: F.startswith(h["name"], F.lit("unknown_")))
    return header.select(
        "doc_id", F.size("header").alias("n_header"), F.size(generated).alias("n_generated"),
        F.size("lines").alias("n_lines"),
    )


def header_map(spark, sf):
    named = document_tables(spark, sf).select("doc_id", F.inline(files.named_columns(F.col("header"))))
    return named.select("doc_id", "pos", "name", "unit")


def split_malformed(spark, sf):
    """Rows of each document that fit its header, and those that do not."""
    good, bad = files.split_malformed(files.explode_rows(document_tables(spark, sf), " "))
    both = good.withColumn("kind", F.lit("good")).unionByName(bad.withColumn("kind", F.lit("bad")))
    return both.select("doc_id", "row_idx", "kind", F.array_join("cells", "|").alias("row_cells"))


def quarantine(spark, sf):
    """Lines with surplus cells keep their place and first cells, and are listed whole."""
    rows = files.explode_rows(document_tables(spark, sf), " ", keep_lines=True)
    first = F.slice("cells", 1, F.size("header"))
    return rows.select("doc_id", "row_idx", "malformed", F.array_join(first, " ").alias("row_text"), F.col("line").alias("rejected"))


def blank_lines(spark, sf):
    """Blank lines put between all lines, then skipped."""
    texts = table(spark, sf, "documents").select("doc_id", F.regexp_replace("text", "\n", "\n\n  \r\n").alias("text"))
    rows = files.explode_rows(files.read_header(texts, "text", 0, 1, "\t"))
    return rows.select("doc_id", "row_idx", F.get("cells", F.lit(0)).alias("line"))


def strip_nul(spark, sf):
    damaged = F.replace(F.col("text"), F.lit("e"), F.lit("\x00e"))
    clean = files.clean_text(damaged)
    return table(spark, sf, "documents").select("doc_id", F.length(clean).alias("n"), F.md5(clean).alias("digest"))


def decode_escaped(spark, sf):
    """Text with every kind of escape, two of which cannot be decoded."""
    key, code = F.col("event_id") % 13, F.col("event_id") % 400 + 161
    written = (
        F.when(key == 0, F.concat(F.lit("\\x"), F.lower(F.hex(code % 94 + 161)), F.lit("1")))
        .when(key == 1, F.concat(F.lit("a\\u"), F.lpad(F.hex(code), 4, "0"), F.lit("f")))
        .when(key == 2, F.concat(F.lit("\\U"), F.lpad(F.hex(code + 128000), 8, "0")))
        .when(key == 3, F.concat(F.lit("\\"), F.conv(code % 300 + 64, 10, 8), F.lit("9")))
        .when(key == 4, F.lit("a\\tb\\nc\\a\\b\\f\\r\\v"))
        .when(key == 5, F.lit("\\q\\8\\'\\\""))
        .when(key == 6, F.lit("\\\\x41\\\\"))
        .when(key == 7, F.lit("\\x4 cut off"))
        .when(key == 8, F.lit("\\ud800"))
        .when(key == 9, F.lit("joined \\\nlines"))
        .when(key == 10, F.lit("at the end \\"))
        .when(key == 11, F.lit("\\U00110000"))
        .otherwise(F.col("event_type"))
    )
    return table(spark, sf, "events").select("event_id", decode_escapes(written).alias("decoded"))


def ragged_rows(spark, sf):
    """Rows with a missing, a surplus or no cell next to complete ones."""
    cells = ["event_type", F.col("value").cast("string"), F.col("user_id").cast("string"), F.lit("surplus")]
    key = F.col("event_id") % 9
    line = (
        F.when(key == 0, F.concat_ws("\t", *cells[:2]))
        .when(key == 1, F.concat_ws("\t", *cells))
        .when(key == 2, F.lit("\t\t"))
        .otherwise(F.concat_ws("\t", *cells[:3]))
    )
    header = files.header_cells(F.lit("kind\treading\tuser"), F.lit("\t[V]\t"))
    rows = table(spark, sf, "events").select("event_id", header.alias("header"), F.lit(0).alias("row_idx"), line.alias("line"))
    mapping = {("kind", "[-]"): ("kind", "[-]"), ("reading", "[V]"): ("reading", "[V]"), ("user", "[-]"): ("user", "[-]")}
    located = files.locate_columns(files.as_cells(rows), mapping)
    return files.canonical_columns(located, ("kind",), ("reading", "user")).select(
        "event_id", "kind", "reading", "user", "malformed"
    )


def row_validity(spark, sf):
    events = hourly(spark, sf)
    key = F.col("event_id") % 13
    late = F.when(key == 3, F.make_dt_interval(hours=F.lit(1))).otherwise(F.make_dt_interval(hours=F.lit(0)))
    texts = events.select(
        "event_id",
        (F.col("ts") + late).alias("ts"),
        "hour",
        F.when(key == 1, F.concat(F.date_format("ts", "dd.MM."), F.lit("yy"))).otherwise(F.date_format("ts", "dd.MM.yy")).alias("d"),
        F.when(key == 2, F.date_format("ts", "H:mm")).otherwise(F.date_format("ts", "HH:mm:ss")).alias("t"),
    )
    return columns.valid_rows(texts, "d", "t", "ts", "hour").select("event_id", "ts")


# Availability and quality


def sized_days(spark, sf):
    """Size of the properties per day."""
    events = table(spark, sf, "events").withColumns({"date": F.to_date("ts"), "n_bytes": F.length("props")})
    return quality.daily_sizes(events, "date", ["n_bytes", "user_id"])


def daily_sizes(spark, sf):
    return steady(sized_days(spark, sf), "mb")


def densify_days(spark, sf):
    """Days of orders, with days without one in between on small tables."""
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.sum("o_totalprice").alias("mb"))
    return steady(quality.densify_days(daily), "mb")


def densify_nulls(spark, sf):
    """Hours of a user group, one of them unknown; some rows lie between the hours, some have no time."""
    key = F.col("event_id")
    at = F.when(key % 11 == 0, F.col("ts")).when(key % 17 != 0, hour())
    events = table(spark, sf, "events").select(F.when(key % 5 > 0, F.col("user_id") % 7).alias("k"), at.alias("at"), "event_id", "value")
    return fill.densify(events, ["k"], "at", HOUR_US)


def densify_users(spark, sf):
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    daily = events.groupBy("user_id", "day").agg(F.sum("value").alias("total"))
    return steady(fill.densify(daily, ["user_id"], "day"), "total")


def availability_matrix(spark, sf):
    daily = table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("mb"))
    return quality.availability_matrix(daily)


def column_quality(spark, sf):
    texts = table(spark, sf, "events").select(
        "event_type", F.col("value").cast("string").alias("value"), "props",
        F.lit(None).cast("string").alias("nothing"), F.lower(F.hex("user_id")).alias("code"), number_text().alias("mixed"),
    )
    return quality.profile_columns(texts, texts.columns, {"code": "[hexadecimal_value]", "value": "[V]"})


# Whole conversion


def played_lines(spark, sf, limit):
    """Events written as the lines of hourly fast and slow files, with the damage real files have."""
    events = hourly(spark, sf)
    stamp = F.concat(F.lit("Site"), F.date_format("hour", "yyMMdd_HH"), F.lit(".raw"))
    # Rows grow many times when they are written as lines, so the parts of this exchange must not be merged by their size.
    named = events.withColumn("file_id", stamp).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file_id")
    key = F.col("event_id")

    fast = fill.row_index(named.where("event_type <> 'signup'"), ["file_id"], ["ts", "event_id"], min_hot_rows=limit)

    def number(column):
        return column.cast("string")

    fast_cells = (
        F.date_format("ts", "dd.MM.yy"),
        F.date_format("ts", "HH:mm:ss"),
        number(F.col("row_idx") + 1),
        F.when(key % 11 == 0, F.lit("")).otherwise(number(F.col("value"))),
        number(F.col("user_id") - 75),
        F.when(key % 29 == 0, F.lit("None")).otherwise(number(key % 100)),
        number(F.col("value") + 16000),
        F.when(key % 23 == 0, F.concat(F.lit("x"), number(F.col("value")))).otherwise(number(F.col("value") + 1000)),
        F.when(key % 17 == 0, F.lit("-9999")).otherwise(number(F.col("value") * 2)),
        F.when(key % 13 == 0, F.lit("")).otherwise(F.concat(F.lit('"'), number(F.col("user_id") * 2), F.lit('"'))),
    )
    fast_lines = fast.select("event_id", "file_id", "row_idx", F.concat_ws("\t", *fast_cells).alias("line"))

    slow = fill.row_index(named.where("event_type = 'signup'"), ["file_id"], ["ts", "event_id"], min_hot_rows=limit)
    slow_cells = (
        F.when(F.col("row_idx") % 3 == 0, F.date_format("ts", " dd.MM.yyyy")).otherwise(F.lit("")),
        F.date_format("ts", "HH:mm:ss"),
        number(F.col("value") / 10 + 80),
        F.when(key % 5 == 0, F.lit("")).otherwise(number(F.col("user_id") % 10 + 75)),
        number(F.col("value") / 20),
        F.when(key % 7 == 0, F.lit("-9999")).otherwise(number(F.col("value") / 10 + 20)),
        number(F.col("user_id") % 7 + 0.5),
        F.when(key % 6 == 0, F.lit("")).otherwise(number(F.col("value") / 8)),
    )
    slow_lines = slow.select("file_id", "row_idx", F.concat_ws("\t", *slow_cells).alias("line"))
    return fast_lines, slow_lines


def played_limit(spark, sf):
    """Row limit for the operators on the played files: 0 if no hour is oversized. One census for all of them."""
    return MIN_HOT_ROWS if settle(MIN_HOT_ROWS, ["hour"], hourly(spark, sf)) is not None else 0


#: Columns of the played files that are known to nobody.
RAW_EXTRA, SLOW_EXTRA = ("Q [q]",), ("Hx [%]",)
PLAYED = (*convert.FAST, *RAW_EXTRA, *(c for c in convert.SLOW if c != "Rhoa"), *SLOW_EXTRA)


def played_series(spark, sf, limit):
    fast_lines, slow_lines = played_lines(spark, sf, limit)
    names = "Date\tTime\tIndex\tU\tV\tW\tSound\tC\tXw\tQ", "Date\tTime\tPa\tPlic\tTa\tTlic\tXa\tHx"
    units = "\t\t\t[m/s]\t[m/s]\t[m/s]\t[m/50s]\t[µmol/mol]\t[mmol/mol]\t[q]", "\t\t[kPa]\t[kPa]\t[degC]\t[degC]\t[mmol / mol]\t[%]"
    fast_files, slow_files = (
        lines.select("file_id").distinct().withColumn("header", files.header_cells(F.lit(n), F.lit(u)))
        for lines, n, u in zip((fast_lines, slow_lines), names, units)
    )
    started = convert.with_era(fast_files.withColumn("start_ts", clock.file_time(F.col("file_id"))))
    fast_places = files.locate_columns(started, presets.RAW_COLUMNS, presets.RAW_HELPERS)
    slow_places = files.locate_columns(slow_files, convert.AUX_MAPPING)
    # Both sides are partitioned by file already; without a hint the lines, small in tests, would be broadcast to the files.
    fast = files.as_cells(fast_lines.join(fast_places.hint("shuffle_hash"), "file_id"))
    slow = files.as_cells(slow_lines.join(slow_places.hint("shuffle_hash"), "file_id"))
    raw = files.canonical_columns(fast, (), convert.FAST)
    aux = files.canonical_columns(slow, ("Date", "Time"), [c for c in convert.SLOW if c != "Rhoa"])
    return convert.convert_series(
        convert.accepted(raw), convert.prepare_slow(convert.accepted(aux), limit), raw_extra=RAW_EXTRA, slow_extra=SLOW_EXTRA,
        period_ps=PLAYED_PERIOD_PS, tolerance_us=PLAYED_TOLERANCE_US, min_hot_rows=limit,
    )


def convert_series(spark, sf):
    series = played_series(spark, sf, played_limit(spark, sf))
    return series.select("event_id", "file_id", "row_idx", "ts", *PLAYED, "calibrated")


def series_summary(spark, sf):
    limit = played_limit(spark, sf)
    rows = stats.MAX_PERCENTILE_ROWS if limit else None
    wide = stats.summarize(played_series(spark, sf, limit), ["file_id", "start_ts"], PLAYED, max_percentile_rows=rows)
    units = convert.UNITS | convert.extra_units([*RAW_EXTRA, *SLOW_EXTRA])
    return steady(stats.to_long(wide, ["file_id", "start_ts"], PLAYED, units), *SUMMED)


def file_manifest(spark, sf):
    series = fill.assign_time_axis(row_index(spark, sf).withColumn("bad", F.col("event_id") % 13 == 0), "hour")
    return quality.file_manifest(series, "hour", "ts", "bad")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        summary_by_hour, summary_by_type, summary_empty_groups, summary_lineitem, merged_summary, halfhour_summary, robust_bounds,
        trend_bands, annotations, distinct_variables, sonic_temperature, convert_units, calibrate_gas, update_non_null,
        era_multiplier, lookup_long, lookup_first, intervals_all, period_linear, sentinel_roundtrip, coerce_numeric, strict_numeric, sorted_columns, row_index,
        time_axis, ffill, bfill, bffill, dedupe_last, interp_linear, align_slow, ramp_daily, factor_outer, factor_join, factor_tables,
        series_text, stats_text,
        segment_dates, pair_files, filename_time, parse_dates, date_labels, parse_table, reconcile_width, header_map,
        split_malformed, quarantine, blank_lines, strip_nul, decode_escaped, ragged_rows, row_validity, daily_sizes, densify_days, densify_nulls, densify_users,
        availability_matrix, column_quality, convert_series, series_summary, file_manifest,
    )
}
QUERIES.update({f"asof_{d}": _asof(d) for d in ("nearest", "backward", "forward")})
