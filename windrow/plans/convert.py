"""From pairs of files to calibrated series and their statistics."""

from __future__ import annotations

from collections.abc import Sequence
from copy import copy
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from windrow import presets
from windrow.functions.clock import file_time, timestamp_from_text
from windrow.operators import columns, fill, lookup, quality, stats
from windrow.operators.asof import interpolate_linear
from windrow.operators.hot import MIN_HOT_ROWS, attach, settle
from windrow.session import landed, own_folder
from windrow.sources import files, sinks

FAST = ("U", "V", "W", "T_SONIC", "CO2", "H2O")
SLOW = ("Pa", "Plic", "Ta", "Tlic", "Xa", "Rhoa")
UNITS = dict([*presets.RAW_COLUMNS.values(), *presets.AUX_COLUMNS.values()])
AUX_MAPPING = {**presets.AUX_COLUMNS, ("Date", "[-]"): ("Date", "[-]"), ("Time", "[-]"): ("Time", "[-]")}


def dated_slow(aux: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Slow rows with their time: date and time texts filled forward."""
    dated = fill.ffill(aux, ["file_id"], ["row_idx"], ["Date", "Time"], min_hot_rows)
    return dated.withColumn("ts", timestamp_from_text(F.col("Date"), F.col("Time"))).drop("Date", "Time")


def prepare_slow(aux: DataFrame, min_hot_rows: int = MIN_HOT_ROWS) -> DataFrame:
    """Slow rows with a time, the last of several rows of a second kept.

    Rows whose time cannot be read are left out here; ``run_batch`` lists them among the rejects.
    """
    return fill.dedupe_last(dated_slow(aux, min_hot_rows).where("ts is not null"), ["file_id", "ts"], ["row_idx"])


def extra_units(names: Sequence[str]) -> dict[str, str]:
    """Unit of unknown columns, which are called by header name and unit."""
    return {n: n[n.rindex("[") :] if n.endswith("]") and "[" in n else "[-]" for n in names}


def spread_extras(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Unknown columns as columns of their own in place of the map ``extras``."""
    if "extras" not in rows.columns:
        return rows.drop("header", "header_id")
    rows = rows.drop("header", "header_id")
    return rows.withColumns({n: F.element_at("extras", F.lit(n)) for n in names}).drop("extras")


def convert_series(
    raw: DataFrame,
    slow: DataFrame,
    slow_cols: Sequence[str] | None = None,
    raw_extra: Sequence[str] = (),
    slow_extra: Sequence[str] = (),
    late_decode: bool = False,
    on_missing: str = "keep",
    factors: DataFrame | None = None,
    period_ps: int = presets.PERIOD_PS,
    tolerance_us: int | None = presets.TOLERANCE_US,
    grid_us: int | None = presets.GRID_US,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Fast rows on their exact time axis with slow columns, gaps filled, gases calibrated.

    ``raw`` has file_id, start_ts, row_idx, the six measured columns as read and, if its files are not those of the
    preset eras, co2_mult and h2o_mult; ``slow`` has file_id, ts and its values (``slow_cols``; by default all
    known ones that it has). ``raw_extra`` and ``slow_extra`` name
    unknown columns (of the maps ``extras`` or columns of their own) that are filled, and interpolated, like others.
    After the first shuffle by file all work on the fast side stays in that partitioning. Files with more than
    ``min_hot_rows`` rows (0: there are none) are converted apart, cut into blocks. ``late_decode`` treats -9999 as a
    number until calibration, as older outputs did. ``factors`` (date, co2_factor, h2o_factor) are applied last, by the
    start day of the file.
    """
    known = [c for c in SLOW if c in slow.columns] if slow_cols is None else slow_cols
    slow_cols = [*known, *slow_extra]
    raw, slow = spread_extras(raw, raw_extra), spread_extras(slow, slow_extra)
    measured = [*FAST, *raw_extra, *slow_cols]

    def convert(raw: DataFrame, slow: DataFrame, limit: int) -> DataFrame:
        timed = fill.assign_time_axis(raw, period_ps=period_ps)
        if "co2_mult" not in timed.columns:
            timed = with_era(timed)
        if not late_decode:
            timed = columns.decode_missing(timed, [*FAST, *raw_extra])
            slow = columns.decode_missing(slow, slow_cols)
        converted = columns.convert_units(timed).drop("co2_mult", "h2o_mult")
        if limit:
            # Cut series are read again for what crosses their blocks; keep that from repeating all steps before.
            converted, slow = landed(converted, "converted"), landed(slow, "slow")
        merged = interpolate_linear(converted, slow, "ts", ["file_id"], slow_cols, tolerance_us, grid_us, limit)
        if limit:
            merged = landed(merged, "merged")
        filled = fill.bffill(merged, ["file_id"], ["row_idx"], measured, limit)
        if late_decode:
            filled = columns.decode_missing(filled, measured)
        return columns.calibrate_gas(filled, on_missing=on_missing)

    oversized = settle(min_hot_rows, ["file_id"], raw, slow)
    if oversized is None:
        calibrated = convert(raw, slow, 0)
    else:
        few = oversized.select("file_id")
        ordinary = convert(*(attach(side, few, ["file_id"], "left_anti") for side in (raw, slow)), 0)
        calibrated = ordinary.unionByName(convert(*(attach(side, few, ["file_id"], "left_semi") for side in (raw, slow)), min_hot_rows))
    if factors is not None:
        dated = calibrated.withColumn("_day", F.to_date("start_ts"))
        gases = {"CO2": "co2_factor", "H2O": "h2o_factor"}
        calibrated = lookup.apply_dated_factor(dated, factors, "_day", gases).drop("_day")
    units = UNITS | extra_units([*raw_extra, *slow_extra])
    return columns.with_units(calibrated, {c: units[c] for c in measured})


def with_era(files_df: DataFrame) -> DataFrame:
    """Files with the amplifier multipliers of their start time."""
    defaults = {"co2_mult": 1.0, "h2o_mult": 1.0}
    eras = lookup.era_table(files_df.sparkSession)
    return lookup.lookup_by_interval(files_df, eras, "start_ts", "after", "until", "(]", defaults, max_broadcast=None)


def _named(df: DataFrame) -> DataFrame:
    stem = files.stem(files.basename(F.col("path")))
    return df.withColumn("file_id", files.file_id_of(stem))


def _started(df: DataFrame) -> DataFrame:
    return with_era(_named(df).withColumn("start_ts", file_time(F.col("file_id"))))


class Folder:
    """A folder of paired files: its listing (one per side, landed), its pairs, what no pair uses, and its rows.

    ``root`` may be several folders. ``start``, ``end`` (excluded) and ``layout`` limit the listing, see ``find_files``.
    """

    uris: dict[str, list[str]] | None = None  # the files to read, if not all

    def __init__(
        self, spark: SparkSession, root: str | Sequence[str], max_bytes: int = files.MAX_WHOLE_FILE,
        start: datetime | None = None, end: datetime | None = None, layout: str | None = None,
    ):
        self.spark, self.root, self.max_bytes = spark, root, max_bytes
        self.span = {"start": start, "end": end, "layout": layout}
        self.found = {side: files.find_files(spark, root, side, **self.span) for side in ("raw", "aux")}
        self.listed = {side: landed(files.listing(found), f"{side}-files") for side, found in self.found.items()}
        pairs = files.pairs_of(self.listed["raw"], self.listed["aux"])
        for column, limit, sign in (("start_ts", start, ">="), ("start_ts", end, "<")):
            if limit is not None:
                pairs = pairs.where(f"{column} {sign} timestamp_ntz'{limit}'")
        self.pairs = landed(pairs, "pairs")
        self.unusable = landed(files.unusable(self.listed["raw"], self.listed["aux"]), "unusable")
        self.split = self._has_large(self.pairs)

    def _has_large(self, pairs: DataFrame) -> bool:
        return bool(pairs.where(F.greatest("raw_len", "aux_len") > self.max_bytes).limit(1).count())

    def only(self, pairs: DataFrame) -> Folder:
        """The same folder with some of its pairs, so few that their URIs can be named in a scan."""
        part = copy(self)
        part.pairs = pairs
        named = pairs.select("raw_uri", "aux_uri").toArrow()
        part.found = {side: files.chosen(found, named.column(f"{side}_uri").to_pylist()) for side, found in self.found.items()}
        part.split = self._has_large(pairs)
        part.uris = {side: named.column(f"{side}_uri").to_pylist() for side in self.found}
        return part

    def rows(self) -> tuple[DataFrame, DataFrame]:
        """Fast rows and slow rows of all pairs, values as read; lines with surplus cells have their ``line``."""

        def lines(side: str) -> DataFrame:
            found = files.find_files(self.spark, self.root, side, **self.span, fmt="text")
            return files.chosen(found, self.uris and self.uris[side])

        raw, aux = (
            files.read_rows(
                self.found[side], describe, mapping, helpers=helpers, max_bytes=self.max_bytes, large=lines(side) if self.split else None,
                unwanted=None if self.uris else self.unusable, **layout,
            )
            for side, describe, mapping, helpers, layout in (
                ("raw", _started, presets.RAW_COLUMNS, presets.RAW_HELPERS, presets.RAW_LAYOUT),
                ("aux", _named, AUX_MAPPING, (), presets.AUX_LAYOUT),
            )
        )
        return files.canonical_columns(raw, (), FAST), files.canonical_columns(aux, ("Date", "Time"), SLOW)


def accepted(rows: DataFrame, surplus: str = "keep") -> DataFrame:
    """Rows without the marks of lines with surplus cells; these are kept with their first cells, or dropped.

    Dropped ones leave a gap in ``row_idx``, so the time of other rows does not depend on them.
    """
    if surplus not in ("keep", "drop"):
        raise ValueError(f"surplus must be keep or drop, not {surplus!r}")
    return (rows if surplus == "keep" else rows.where("NOT malformed")).drop("line", "malformed", "fault")


def convert_pairs(
    spark: SparkSession, root: str | Sequence[str], max_bytes: int = files.MAX_WHOLE_FILE, raw_extra: Sequence[str] = (), slow_extra: Sequence[str] = (),
    start: datetime | None = None, end: datetime | None = None, layout: str | None = None, surplus: str = "keep", **options,
) -> DataFrame:
    """All pairs below ``root``, or those that start in a range of time, as one lazy DataFrame of calibrated rows.

    Unknown columns are carried if they are named (as ``name unit``); ``run_batch`` finds their names by itself. As
    long as every file is read whole, a file bounds its own group and no probe for oversized groups is run.
    """
    folder = Folder(spark, root, max_bytes, start, end, layout)
    raw, aux = (accepted(rows, surplus) for rows in folder.rows())
    limit = options.pop("min_hot_rows", MIN_HOT_ROWS if folder.split else 0)
    return convert_series(raw, prepare_slow(aux, limit), raw_extra=raw_extra, slow_extra=slow_extra, min_hot_rows=limit, **options)


REJECTS = {"file_id": "string", "path": "string", "row_idx": "bigint", "line": "string"}


def _rejected(df: DataFrame, side: Column, reason: Column, given: Sequence[str]) -> DataFrame:
    columns = [(F.col(c) if c in given else F.lit(None)).cast(kind).alias(c) for c, kind in REJECTS.items()]
    return df.select(side.alias("side"), *columns, reason.alias("reason"))


def rejected_rows(raw: DataFrame, aux: DataFrame, dated: DataFrame) -> DataFrame:
    """Lines with a fault, whole, and slow rows without time, as (side, file_id, path, row_idx, line, reason)."""
    place = ("file_id", "row_idx", "line")
    lines = [_rejected(rows.where("fault IS NOT NULL"), F.lit(side), F.col("fault"), place) for side, rows in (("raw", raw), ("aux", aux))]
    timeless = _rejected(dated.where("ts is null"), F.lit("aux"), F.lit("no readable time"), place[:2])
    return lines[0].unionByName(lines[1]).unionByName(timeless)


def rejected_files(folder: Folder) -> DataFrame:
    """Files that no pair uses, in the same columns."""
    return _rejected(folder.unusable, F.lower(F.element_at(F.split("path", r"\."), -1)), F.col("reason"), ("path",))


def run_batch(
    spark: SparkSession, indir: str | Sequence[str], outdir: str, csv: bool = False, max_bytes: int = files.MAX_WHOLE_FILE,
    start: datetime | None = None, end: datetime | None = None, layout: str | None = None, surplus: str = "keep", **options,
) -> DataFrame:
    """Convert a folder, or a range of time of it: series as Parquet (and text), units, statistics, trends, rejects, manifest.

    Returns the wide statistics per file. The texts are read once: parsed rows are landed first, and unknown columns,
    rejects and the conversion read that table. Unknown columns that few files have go to a long table (``extras``),
    each distinct header is listed once (``headers``). Statistics read the written series, trends the written statistics.
    What is landed meanwhile has a folder of its own, which is removed at the end.
    """
    with own_folder(spark, "batch"):
        folder = Folder(spark, indir, max_bytes, start, end, layout)
        done = Converted(folder, surplus, **options)
        rejected_rows(done.raw, done.aux, done.dated).unionByName(rejected_files(folder)).write.parquet(f"{outdir}/rejects")
        done.rare_extras().write.parquet(f"{outdir}/extras")
        done.headers().write.parquet(f"{outdir}/headers")
        with sinks.bucketed(done.observed(), f"{outdir}/series") as series:
            done.audit(series)
            if csv:
                done.write_text(series, f"{outdir}/series_csv")
            sinks.write_units(done.series, done.units, f"{outdir}/units")
            done.summaries(series).write.parquet(f"{outdir}/summaries")
            manifest(folder, series, done.raw, done.aux, done.dated).write.parquet(f"{outdir}/manifest")
        parts = spark.read.parquet(f"{outdir}/summaries")
        names = sorted(done.units)
        stats.without_parts(parts, BY_FILE, names).write.parquet(f"{outdir}/stats")
        for period in ("day", "month"):
            longer = stats.merge_summaries(with_period(parts, period), [period], names)
            stats.without_parts(longer, [period], names).write.parquet(f"{outdir}/stats_{period}")
        wide = spark.read.parquet(f"{outdir}/stats")
        sinks.write_stats(wide, f"{outdir}/stats_csv", units=done.units)
        long = stats.to_long(wide, BY_FILE, sorted(done.units), done.units)
        stats.trend_bands(long, "start_ts", ["file_id"]).write.parquet(f"{outdir}/trends")
        stats.robust_bounds(long).write.parquet(f"{outdir}/bounds")
    return wide


BY_FILE = ["file_id", "start_ts"]


def with_period(parts: DataFrame, period: str) -> DataFrame:
    """Files with the ``day`` or ``month`` that they start in, or the beginning of their ``era``."""
    if period == "era":
        eras = lookup.era_table(parts.sparkSession).select("after", "until", F.col("after").alias("era"))
        return lookup.lookup_by_interval(parts, eras, "start_ts", "after", "until", "(]", max_broadcast=None)
    if period not in ("day", "month"):
        raise ValueError(f"unknown period {period!r}")
    day = F.to_date("start_ts")
    return parts.withColumn(period, day if period == "day" else F.trunc(day, "month"))


class Converted:
    """A folder's parsed rows (landed), its series (lazy), and what is written from them.

    ``known`` are names of unknown columns that are columns of the series in any case, ``files_before`` the files that
    were converted before these.
    """

    def __init__(self, folder: Folder, surplus: str = "keep", known: Sequence[str] = (), files_before: int = 0, **options):
        self.folder, self.surplus = folder, surplus
        self.lines, self.rows = Observation(), Observation()
        raw, aux = folder.rows()
        self.raw = landed(raw.observe(self.lines, F.count(F.lit(1)).alias("n"), F.count_if("malformed").alias("bad")), "parsed")
        self.aux = landed(aux, "parsed")
        found = {side: files.common_extras(rows, known, files_before) for side, rows in (("raw_extra", self.raw), ("slow_extra", self.aux))}
        # A name that both sides have would be two columns of one name.
        found["slow_extra"] = [c for c in found["slow_extra"] if c not in found["raw_extra"]]
        again = [c for c in known if c not in found["slow_extra"]]  # NULL columns, if no file has them
        self.extra = {"raw_extra": sorted({*found["raw_extra"], *again}), "slow_extra": sorted(found["slow_extra"])}
        limit = options.pop("min_hot_rows", MIN_HOT_ROWS if folder.split else 0)
        self.dated = landed(dated_slow(accepted(self.aux, surplus), limit), "dated")
        slow = fill.dedupe_last(self.dated.where("ts is not null"), ["file_id", "ts"], ["row_idx"])
        self.series = convert_series(accepted(self.raw, surplus), slow, min_hot_rows=limit, **self.extra, **options)
        self.units = columns.units_of(self.series)

    def observed(self) -> DataFrame:
        """The series with a count of its rows, taken while they are written."""
        return self.series.observe(self.rows, F.count(F.lit(1)).alias("n"))

    def audit(self, written: DataFrame) -> None:
        """Fail unless all lines but the dropped ones have been written.

        The counts come from the writes themselves. Tasks that ran twice may count twice, so before a batch fails
        both tables are counted.
        """
        def expected(n: int, bad: int) -> int:
            return n - bad if self.surplus == "drop" else n

        if expected(self.lines.get["n"], self.lines.get["bad"]) == self.rows.get["n"]:
            return
        n, bad = self.raw.agg(F.count(F.lit(1)), F.count_if("malformed")).first()
        if expected(n, bad) != (there := written.count()):
            raise RuntimeError(f"{n} lines were read, {bad} of them with surplus cells, but {there} rows were written")

    def summaries(self, series: DataFrame) -> DataFrame:
        """Ten statistics per file and variable, and the parts from which those of longer periods are merged."""
        rows = stats.MAX_PERCENTILE_ROWS if self.folder.split else None  # a file that is read whole bounds its own group
        return stats.summarize(series, BY_FILE, sorted(self.units), stats.MERGEABLE, groups=self.folder.pairs, max_percentile_rows=rows)

    def rare_extras(self) -> DataFrame:
        """Values of unknown columns that few files have."""
        raw = files.rare_extras(self.raw, "raw", self.extra["raw_extra"])
        return raw.unionByName(files.rare_extras(self.aux, "aux", self.extra["slow_extra"]))

    def headers(self) -> DataFrame:
        """The distinct headers of both sides."""
        sides = [files.distinct_headers(rows).withColumn("side", F.lit(side)) for side, rows in (("raw", self.raw), ("aux", self.aux))]
        return sides[0].unionByName(sides[1])

    def write_text(self, series: DataFrame, path: str) -> None:
        text = series.select("file_id", "row_idx", "ts", *self.units)
        sinks.write_series(text, path, "csv", units=self.units, files=self.folder.pairs, drop_ts=True)


def manifest(folder: Folder, series: DataFrame, raw: DataFrame, aux: DataFrame, dated: DataFrame) -> DataFrame:
    """One row per pair: multipliers, sizes, rows of both sides in and out, and unknown columns.

    ``n_ambiguous`` counts rows of files where several header entries mean the same column.
    """
    written = quality.file_manifest(series, flags=("ambiguous", "calibrated"))
    listed = folder.pairs.select("file_id", "start_ts", "raw_path", "aux_path", "raw_len", "aux_len")
    facts = with_era(listed).join(written, "file_id", "left").drop("n_malformed")
    for side, rows in (("raw", raw), ("aux", aux)):
        counted = rows.groupBy("file_id").agg(
            F.count(F.lit(1)).alias(f"{side}_lines"),
            F.count_if("malformed").alias(f"{side}_malformed"),
            F.coalesce(F.first(F.when(F.col("row_idx") == 0, F.array_sort(F.map_keys("extras"))), True), F.array().cast("array<string>")).alias(f"{side}_unknown"),
            F.first("header_id").alias(f"{side}_header"),
        )
        facts = facts.join(counted, "file_id", "left")
    timeless = dated.groupBy("file_id").agg(F.count_if(F.col("ts").isNull()).alias("aux_without_time"))
    return facts.join(timeless, "file_id", "left")
