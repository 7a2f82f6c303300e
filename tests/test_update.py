"""A folder that grows: runs, the ledger, stops in between, changed files."""

import datetime as dt
import os

import numpy as np
import pandas as pd
import pytest
from test_sources import write_pair

from windrow.operators import stats
from windrow.plans import convert, update
from windrow.session import matching

#: Two pairs of one day, one of the next, one with a column of its own, and one with long lines.
PAIRS = {
    "Site981001_10": {}, "Site981001_11": {"damage": "long"}, "Site981002_10": {"damage": "nul", "latin": False},
    "Site981002_11": {"extra": True}, "Site990615_23": {"damage": "dates"},
}


@pytest.fixture(scope="module", autouse=True)
def few_parts(spark):
    """Many small jobs: two parts are enough."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def put(folder, names, seed=5):
    for name in names:
        write_pair(folder, name, pd.Timestamp(dt.datetime.strptime(name, "Site%y%m%d_%H")), 60, np.random.default_rng([seed, *map(ord, name)]), **PAIRS[name])


def rows_of(df):
    """Rows as sorted texts, whatever the order of columns; numbers of runs left out."""
    df = df.drop("run", *[c for c in df.columns if c.endswith("_path") or c == "path"])
    return sorted(str([(c, r[c]) for c in sorted(df.columns)]) for r in df.collect())


def contents(store):
    """All that a store holds; sketches keep other samples in other runs."""
    tables = {name: store.table(name) for name in update.TABLES}
    summaries = tables.pop("summaries")
    tables["summaries"] = summaries.drop(*[c for c in summaries.columns if c.endswith("__sketch")])
    tables |= {"stats": store.stats(), "trends": store.trends(), "bounds": store.bounds()}
    return {name: rows_of(df) for name, df in tables.items()} | {"units": store.units()}


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """All pairs in one run."""
    root = tmp_path_factory.mktemp("whole")
    put(root / "in", PAIRS)
    return root / "in", contents(update.update_batch(spark, str(root / "in"), str(root / "out")))


def test_statistics_of_periods(spark, whole):
    """Days, months and eras from the files' summaries equal those of the series; quantiles stay within the sketch's error."""
    store = update.Store(spark, str(whole[0].parent / "out"))
    names = sorted(store.units())
    series = store.table("series").drop("date", "run")
    for period, count in (("day", 3), ("month", 2), ("era", 2)):
        got = {r[period]: r for r in store.period_stats(period).collect()}
        want = stats.summarize(convert.with_period(series, period), [period], names).collect()
        assert len(got) == len(want) == count
        for row in want:
            merged = got[row[period]]
            for c in names:
                assert merged[f"{c}__count"] == row[f"{c}__count"]
                for s in ("min", "max", "mean", "std"):
                    a, b = merged[f"{c}__{s}"], row[f"{c}__{s}"]
                    assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9, abs=1e-9)), (period, c, s)


def spoil(folder, names):
    """Other content of the same size and time of change: found out by whoever reads it."""
    for path in (p for name in names for p in folder.glob(f"{name}.*")):
        facts = path.stat()
        path.write_bytes(b"\xff" * facts.st_size)
        os.utime(path, ns=(facts.st_atime_ns, facts.st_mtime_ns))


def test_update_equals_batch(spark, whole, tmp_path):
    source, tables = whole
    convert.run_batch(spark, str(source), str(tmp_path / "out"))
    series = spark.read.parquet(str(tmp_path / "out" / "series"))
    assert rows_of(series) == tables["series"] and len(tables["series"]) == 300
    for name in ("trends", "stats"):
        assert rows_of(spark.read.parquet(str(tmp_path / "out" / name))) == tables[name]
    daily = spark.read.parquet(str(tmp_path / "out" / "stats_day")).orderBy("day").collect()
    assert [r["U__count"] for r in daily] == [120, 120, 60] and daily[1]["Z [z]__count"] == 60


def test_two_runs_equal_one(spark, whole, tmp_path):
    """Three pairs, then two more: the second update reads only these, and all tables are those of one run."""
    first, *rest = [list(PAIRS)[:3], *list(PAIRS)[3:]]
    put(tmp_path / "in", first)
    store = update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), pairs_per_run=2)
    assert store.last_run() == 2 and store.table("series").count() == 180
    spoil(tmp_path / "in", first)
    put(tmp_path / "in", rest)
    store = update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert store.last_run() == 3 and contents(store) == whole[1]
    update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert store.last_run() == 3


@pytest.mark.parametrize("stop", ["before", "after"])
def test_stopped_runs(spark, whole, tmp_path, stop, monkeypatch):
    """A run that stops before its commit leaves no rows; one that stops behind it is complete."""
    put(tmp_path / "in", list(PAIRS)[:3])
    store = update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    before = contents(store)
    put(tmp_path / "in", list(PAIRS)[3:])
    put(tmp_path / "in", list(PAIRS)[:1], seed=6)  # a changed file: its day moves to the next run

    def fail(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(update.Store, "commit" if stop == "before" else "drop", fail)
        if stop == "after":  # called by recover too, when there is nothing to remove yet
            patch.setattr(update.Store, "recover", lambda _: None)
        with pytest.raises(KeyboardInterrupt):
            update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert matching(spark, f"{tmp_path}/out/series/run=2") and matching(spark, f"{tmp_path}/out/series/run=1/date=1998-10-01")
    if stop == "before":
        assert contents(store) == before
    else:
        assert store.table("series").count() == 300
    store = update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    again = update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "new"))
    assert store.last_run() == 2 and contents(store) == contents(again) and contents(store)["series"] != whole[1]["series"]
    assert not matching(spark, f"{tmp_path}/out/series/run=1/date=1998-10-01")
    raw = spark.read.parquet(str(tmp_path / "out" / "series"))
    assert raw.count() == 300  # also for readers that do not know of runs


def test_partner_that_comes_later(spark, tmp_path):
    put(tmp_path / "in", ["Site981001_10"])
    aux = tmp_path / "in" / "Site981001_10.aux"
    held = aux.read_bytes()
    aux.unlink()
    store = update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert store.last_run() == 0 and [r.reason for r in spark.read.parquet(str(tmp_path / "out" / "unpaired")).collect()] == ["no partner"]
    assert store.table("series").count() == 0 and store.table("rejects").count() == 0
    aux.write_bytes(held)
    store = update.update_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), csv=True)
    assert store.table("series").count() == 60 and spark.read.parquet(str(tmp_path / "out" / "unpaired")).count() == 0
    assert len(list((tmp_path / "out" / "series_csv" / "run=1").glob("file_id=*"))) == 1


def test_damaged_headers_do_not_widen(spark, tmp_path):
    """Names that few files have go to a long table; no value is lost, and the series keeps its columns."""
    names = [f"Site99{1 + n // 28:02d}{1 + n % 28:02d}_00" for n in range(120)]
    head = "a\nb\nc\nU\tV\tW\tSound\tC\tXw\tZ\t{}\n[m/s]\t[m/s]\t[m/s]\t[m/50s]\t[mV]\t[mV]\t[z]\t{}\n"
    for n, name in enumerate(names):
        entry = ("Q", "[q]") if n % 2 else (f"Q#{n} x", "[q q]" if n % 4 else "")
        rows = "".join(f"1\t2\t3\t16000\t1500\t1\t7\t{n}.{i}\n" for i in range(2))
        (tmp_path / f"{name}.raw").write_text(head.format(*entry) + rows)
        (tmp_path / f"{name}.aux").write_text("x\nDate\tTime\tPa\tPlic\tTa\tTlic\n\t\t[kPa]\t[kPa]\t[degC]\t[degC]\n01.01.99\t00:00:00\t80\t80\t10\t35\n")
    store = update.update_batch(spark, str(tmp_path), str(tmp_path / "out"))
    columns = store.table("series").columns
    assert {"Z [z]", "Q [q]"} <= set(columns) and not [c for c in columns if c.startswith("Q#")]
    rare = {(r.file_id, r.row_idx): (r.side, r.name, r.unit, r.value) for r in store.table("extras").collect()}
    assert len(rare) == 120
    assert rare["Site990101_00.raw", 1] == ("raw", "Q#0 x", "[-]", 0.1) and rare["Site990103_00.raw", 0] == ("raw", "Q#2 x", "[q q]", 2.0)
    assert store.table("series").where("`Q [q]` IS NOT NULL").count() == 120 and store.table("series").where("`Z [z]` = 7").count() == 240
    folder = convert.Folder(spark, str(tmp_path))
    headers = convert.Converted(folder).headers().collect()
    assert sorted(h.n_files for h in headers) == [1] * 60 + [60, 120]
    assert len({r.raw_header for r in store.table("manifest").collect()}) == 61
