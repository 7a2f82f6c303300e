"""A folder that grows: each run converts what is new or changed, and is committed to a ledger as a whole."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.functions.clock import file_time
from windrow.operators import stats
from windrow.plans import convert
from windrow.session import landed, matching, own_folder, remove
from windrow.sources import files, sinks

#: Tables that hold rows of single files, below ``<table>/run=<n>/date=<start day>``.
TABLES = ("series", "summaries", "manifest", "rejects", "extras")
#: Pairs of one run at most; their URIs are named in the scan.
PAIRS_PER_RUN = 20_000
FACTS = ("raw_path", "aux_path", "raw_len", "aux_len", "raw_time", "aux_time")
LEDGER = "file_id string, start_ts timestamp_ntz, raw_path string, aux_path string, raw_len bigint, aux_len bigint, raw_time timestamp, aux_time timestamp, replaces int, run int"

EXTRAS = "side string, row_idx bigint, name string, unit string, value double, date date, run int"
REJECTED = "side string, path string, row_idx bigint, line string, reason string, date date, run int"


class Store:
    """The tables of all runs below a folder, and the ledger that says which runs count.

    A run writes folders of its own and then one ledger file: that file is the commit. Folders of a run without it are
    what an interrupted run has left; readers do not see them, and the next run removes them and takes their number.
    Where a file has changed, the other files of its day and earlier run move to the new run with it, and the earlier
    folder of that day no longer counts; it is removed after the commit, or by the next run.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _runs(self, pattern: str) -> list[int]:
        found = matching(self.spark, f"{self.root}/{pattern}")
        return sorted({int(path.split("/run=")[1].split("/")[0]) for path in found})

    def last_run(self) -> int:
        return max(self._runs("ledger/run=*/part-*"), default=0)

    def ledger(self) -> DataFrame:
        """All commits: the files of each run with their paths, sizes and times, and the run that a file was in before."""
        runs = self._runs("ledger/run=*/part-*")
        if not runs:
            return self.spark.createDataFrame([], LEDGER)
        paths = [f"{self.root}/ledger/run={n}" for n in runs]
        return self.spark.read.schema(LEDGER).option("basePath", f"{self.root}/ledger").parquet(*paths)

    def committed(self) -> DataFrame:
        """One row per file: its latest commit."""
        columns = [c for c in self.ledger().columns if c != "file_id"]
        latest = self.ledger().groupBy("file_id").agg(F.max_by(F.struct(*columns), "run").alias("x"))
        return latest.select("file_id", "x.*")

    def superseded(self) -> list[tuple[str, int]]:
        """Days of earlier runs that the last run has replaced, as (date, run)."""
        last = self.ledger().where((F.col("run") == self.last_run()) & F.col("replaces").isNotNull())
        days = last.select(F.to_date("start_ts").cast("string").alias("date"), "replaces").distinct()
        return sorted((r["date"], r["replaces"]) for r in days.collect())  # at most the pairs of one run

    def recover(self) -> None:
        """Remove what interrupted runs have left, and the days that the last run has replaced."""
        last = self.last_run()
        for name in (*TABLES, "series_csv", "ledger"):
            for run in self._runs(f"{name}/run=*"):
                if run > last:
                    remove(self.spark, f"{self.root}/{name}/run={run}")
        self.drop(self.superseded())

    def drop(self, days: Sequence[tuple[str, int]]) -> None:
        for date, run in days:
            for name in TABLES:
                remove(self.spark, f"{self.root}/{name}/run={run}/date={date}")

    def table(self, name: str) -> DataFrame:
        """The rows that count of one of ``TABLES``, with ``date`` and ``run``; columns are those of all runs together."""
        last = self.last_run()
        runs = [n for n in self._runs(f"{name}/run=*/date=*") if n <= last]
        if not runs:
            kinds = {"rejects": f"file_id string, {REJECTED}", "extras": f"file_id string, {EXTRAS}"}
            return self.spark.createDataFrame([], kinds.get(name, "file_id string, date date, run int"))
        paths = [f"{self.root}/{name}/run={n}" for n in runs]
        rows = self.spark.read.option("mergeSchema", "true").option("basePath", f"{self.root}/{name}").parquet(*paths)
        for date, run in self.superseded():
            rows = rows.where(f"NOT (run = {run} AND date = date'{date}')")
        if name == "summaries":  # a variable that other runs have brought has no values here
            rows = rows.withColumns({c: F.coalesce(c, F.lit(0).cast("bigint")) for c in rows.columns if c.endswith("__count")})
        return rows

    def units(self) -> dict[str, str]:
        """Variables of all runs and their units."""
        names = sorted(c.removesuffix("__count") for c in self.table("summaries").columns if c.endswith("__count"))
        known = convert.extra_units(names) | convert.UNITS
        return {c: known[c] for c in names}

    def stats(self) -> DataFrame:
        """Ten statistics of every file and variable."""
        return stats.without_parts(self.table("summaries"), convert.BY_FILE, list(self.units()))

    def period_stats(self, period: str) -> DataFrame:
        """Ten statistics per ``day``, ``month`` or ``era``, merged from those of the files; the series is not read."""
        names = list(self.units())
        merged = stats.merge_summaries(convert.with_period(self.table("summaries"), period), [period], names)
        return stats.without_parts(merged, [period], names)

    def long_stats(self) -> DataFrame:
        units = self.units()
        return stats.to_long(self.stats(), convert.BY_FILE, list(units), units)

    def trends(self) -> DataFrame:
        return stats.trend_bands(self.long_stats(), "start_ts", ["file_id"])

    def bounds(self) -> DataFrame:
        return stats.robust_bounds(self.long_stats())

    def commit(self, files_: DataFrame, run: int) -> None:
        """One file, which appears as a whole."""
        columns = [c.split()[0] for c in LEDGER.split(", ") if not c.startswith("run ")]
        files_.select(*columns).coalesce(1).write.parquet(f"{self.root}/ledger/run={run}")


def new_pairs(store: Store, pairs: DataFrame) -> DataFrame:
    """Pairs that are not committed as they are now; ``replaces`` is the run that holds an earlier version."""
    known = store.committed().select("file_id", *[F.col(c).alias(f"_{c}") for c in FACTS], F.col("run").alias("replaces"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FACTS]
    unchanged = same[0]
    for part in same[1:]:
        unchanged = unchanged & part
    joined = pairs.join(known, "file_id", "left")
    return joined.where(F.col("replaces").isNull() | ~unchanged).drop(*[f"_{c}" for c in FACTS])


def update_batch(
    spark: SparkSession, indir: str | Sequence[str], outdir: str, csv: bool = False, max_bytes: int = files.MAX_WHOLE_FILE,
    start: datetime | None = None, end: datetime | None = None, layout: str | None = None, surplus: str = "keep",
    pairs_per_run: int = PAIRS_PER_RUN, **options,
) -> Store:
    """Bring the tables below ``outdir`` up to date with a folder: convert pairs that are new or have changed.

    The folder is listed once per side. Pairs are taken in runs of at most ``pairs_per_run``, by start time; a run opens
    only its own files and is committed as a whole, so after a stop the next call goes on with the first run that was
    not. A file counts as changed if its path, size or time of change differ. Files that are no longer there keep their
    rows. Files that no pair uses are listed anew (``unpaired``). With ``csv`` each run writes the text of its own files;
    of a file that has changed the text of the last run counts.
    """
    store = Store(spark, outdir)
    store.recover()
    with own_folder(spark, "update"):
        folder = convert.Folder(spark, indir, max_bytes, start, end, layout)
        while True:
            with own_folder(spark, "run"):
                todo = landed(new_pairs(store, folder.pairs).orderBy("start_ts", "file_id").limit(pairs_per_run), "todo")
                if todo.isEmpty():
                    break
                _run(store, folder.only(todo), store.last_run() + 1, csv, surplus, options)
        convert.rejected_files(folder).write.mode("overwrite").parquet(f"{store.root}/unpaired")
    return store


def _run(store: Store, folder: convert.Folder, run: int, csv: bool, surplus: str, options: dict) -> None:
    spark, todo = store.spark, folder.pairs
    date = F.to_date("start_ts")
    days = sorted((r[0], r[1]) for r in todo.where("replaces is not null").select(date.cast("string"), "replaces").distinct().collect())
    committed = store.committed()
    known = [c for c in store.units() if c not in convert.UNITS]
    done = convert.Converted(folder, surplus, known, committed.count(), **options)
    facts = ["file_id", "start_ts", *FACTS]
    series, commits, moved = done.observed(), todo.select(*facts, "replaces"), {}
    if days:
        listed = F.array(*[F.lit(f"{day} {earlier}") for day, earlier in days])
        replaced = committed.where(F.array_contains(listed, F.concat_ws(" ", date.cast("string"), F.col("run").cast("string"))))
        stay = landed(replaced.join(todo, "file_id", "left_anti").select(*facts, F.col("run").alias("replaces")), "stay")
        moved = {name: _others(store, name, listed, todo) for name in TABLES}
        commits = commits.unionByName(stay)
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        series = series.unionByName(moved["series"].drop("date"), allowMissingColumns=True).repartition(buckets, "file_id")
    commits = landed(commits, "commits")

    def write(df: DataFrame, name: str) -> None:
        rows = df.unionByName(moved[name], allowMissingColumns=True) if days else df
        rows.hint("rebalance", "date").write.partitionBy("date").parquet(f"{store.root}/{name}/run={run}")

    with sinks.bucketed(series, f"{store.root}/series/run={run}") as written:
        own = (written.join(stay.select("file_id"), "file_id", "left_anti") if days else written).drop("date")
        done.audit(own)
        if csv:
            done.write_text(own, f"{store.root}/series_csv/run={run}")
        write(done.summaries(own).withColumn("date", date), "summaries")
        write(convert.manifest(folder, own, done.raw, done.aux, done.dated).withColumn("date", date), "manifest")
        rejected = convert.rejected_rows(done.raw, done.aux, done.dated)
        for name, rows in (("rejects", rejected), ("extras", done.rare_extras())):
            write(rows.withColumn("date", F.to_date(file_time(F.col("file_id")))), name)
    store.commit(commits, run)
    store.drop(days)


def _others(store: Store, name: str, listed: Column, todo: DataFrame) -> DataFrame:
    """Rows of the other files in the days of earlier runs that a run replaces (``listed``, as texts)."""
    rows = store.table(name)
    there = rows.where(F.array_contains(listed, F.concat_ws(" ", F.col("date").cast("string"), F.col("run").cast("string"))))
    return there.join(F.broadcast(todo.select("file_id")), "file_id", "left_anti").drop("run")  # at most the pairs of a run
