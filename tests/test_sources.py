"""Reading, pairing, converting and writing of generated files."""

import datetime as dt
import gzip

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrow import presets
from windrow.operators import lookup
from windrow.plans import convert
from windrow.sources import factors, files, sinks


def parse(spark, text, skip=0, header_rows=2, sep="\t"):
    df = spark.createDataFrame([("f", text)], "file_id string, text string")
    return files.read_header(df, "text", skip, header_rows, sep)


def cells(rows):
    return [[None if c == "" else c for c in r.cells] for r in rows.orderBy("row_idx").collect()]


def test_ragged_and_blank_lines(spark):
    parsed = parse(spark, "a\tb\n\t\n1\t2\n3\t4\t5\n6\n\n \n\t\n7\t8\n")
    mapping = {("a", "[-]"): ("a", "[-]"), ("b", "[-]"): ("b", "[-]")}
    rows = files.explode_rows(files.locate_columns(parsed, mapping))
    got = files.canonical_columns(rows, (), ("a", "b")).orderBy("row_idx")
    assert [(r.row_idx, r.a, r.b) for r in got.collect()] == [(0, 1, 2), (1, 3, 4), (2, 6, None), (3, None, None), (4, 7, 8)]
    good, bad = files.split_malformed(rows)
    assert good.count() == 4 and bad.count() == 1


def test_header_repair(spark):
    parsed = parse(spark, "free text\nDate\tU\t\n\t[m/s]\t\nx\t1\t\t9\n", skip=1)
    header = [(h.name, h.unit, h.pos) for h in parsed.first().header]
    assert header == [("Date", "[-]", 0), ("U", "[m/s]", 1), ("", "[-]", 2), ("unknown_1", "[-unknown-]", 3)]
    named = parsed.select(files.named_columns(F.col("header")).alias("h")).first().h
    assert [h.name for h in named] == ["Date", "U"]


def test_nul_bytes_and_line_ends(spark):
    assert cells(files.explode_rows(parse(spark, "a\tb\r\n\t\r\n3\x00\t4\r\n"))) == [["3", "4"]]


def test_file_without_data(spark):
    parsed = parse(spark, "a\tb")
    assert parsed.first().lines == [] and files.explode_rows(parsed).count() == 0


def test_same_column_twice_and_unknown_ones(spark):
    text = "T\tSound\tZ\tZ\tDate\n[degC]\t[m/50s]\t[x]\t[x]\t\n1\t2\t3\t4\t5\n"
    located = files.locate_columns(parse(spark, text), presets.RAW_COLUMNS, presets.RAW_HELPERS)
    assert located.first().ambiguous
    row = files.canonical_columns(files.explode_rows(located), (), ("T_SONIC", "U")).first()
    assert (row.T_SONIC, row.U, row.extras) == (1.0, None, {"Z [x]": 3.0})


def number(x):
    return "" if np.isnan(x) else repr(float(x))


def write_pair(folder, name, start, n, rng, latin=True, extra=False, damage=None):
    """One generated pair and the values it holds."""
    folder.mkdir(parents=True, exist_ok=True)
    fast = pd.DataFrame(
        {
            "U": rng.integers(-500, 500, n), "V": rng.integers(-500, 500, n), "W": rng.integers(-100, 100, n),
            "S": rng.integers(16000, 17000, n), "C": rng.integers(1000, 3000, n), "Xw": rng.integers(100, 900, n),
        }
    ).astype(float)
    fast = fast.mask(rng.random(fast.shape) < 0.02)
    lines = ["site", "logger", "comment", "Date\tTime\tIndex\tU\tV\tW\tSound\tC\tXw" + ("\tZ" if extra else ""),
             "\t\t\t[m/s]\t[m/s]\t[m/s]\t[m/50s]\t[µmol/mol]\t[mmol/mol]" + ("\t[z]" if extra else "")]
    for i, row in enumerate(fast.itertuples(index=False)):
        parts = [f"{start:%d.%m.%y}", "00:00:00", str(i + 1), *map(number, row), *(["1.5"] if extra else [])]
        if damage == "surplus" and i == 0:
            parts += ["9", "9"]
        if damage == "long" and i in (2, 3, 500):
            parts += ["9"]
        lines.append("\t".join(parts))
    if damage == "nul":
        lines[7] = lines[7].replace("\t", "\x00\t", 1)
    encoding = "latin-1" if latin else "utf-8"
    (folder / f"{name}.raw").write_bytes(("\n".join(lines) + "\n").encode(encoding))

    seconds = [s for s in range(int(n * 0.048) + 1) if rng.random() > 0.1]
    slow = pd.DataFrame(
        {"Pa": rng.normal(83, 1, len(seconds)), "Plic": rng.normal(80, 1, len(seconds)),
         "Ta": rng.normal(10, 1, len(seconds)), "Tlic": rng.normal(30, 1, len(seconds))}
    ).round(3)
    slow = slow.mask(rng.random(slow.shape) < 0.1)
    slow.index = [start + pd.Timedelta(s, unit="s") for s in seconds]
    lines = ["site", "Date\tTime\tPa\tPlic\tTa\tTlic\t", "\t\t[kPa]\t[kPa]\t[degC]\t[degC]\t"]
    for i, (ts, row) in enumerate(slow.iterrows()):
        date = "" if i and i % 3 else (f"{ts:%d.%m.%Y}" if extra else f" {ts:%d.%m.%y}")
        texts = [number(v) for v in row]
        if damage == "dates" and i == 5:
            texts = [f"{ts:%d.%m.%y}"] * 4
            slow.iloc[i] = np.nan
        if i == 2:  # the same second twice: the later row counts
            lines.append("\t".join([date, f"{ts:%H:%M:%S}", "1", "1", "1", "1"]))
        lines.append("\t".join([date, f"{ts:%H:%M:%S}", *texts]))
    (folder / f"{name}.aux").write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return fast, slow


def on_axis(slow, axis):
    """Slow columns at fast times: the line between known neighbours, read at the nearest 10 ms that lies within 48 ms."""
    times = (slow.index - slow.index[0]).total_seconds().to_numpy() * 1e6
    wanted = (axis - slow.index[0]).total_seconds().to_numpy() * 1e6
    point = np.clip(np.round(wanted / 10_000), 0, times[-1] // 10_000) * 10_000
    out = {}
    for c in slow:
        value = slow[c].to_numpy()
        known_at, known = times[~np.isnan(value)], value[~np.isnan(value)]
        left = np.searchsorted(known_at, point, side="right") - 1
        right = np.minimum(left + 1, len(known) - 1)
        width = np.where(right > left, known_at[right] - known_at[left], 1)
        line = known[left] + (known[right] - known[left]) * (point - known_at[left]) / width
        out[c] = np.where((left < 0) | (np.abs(wanted - point) > 48_000), np.nan, line)
    return out


def filled(values):
    """Each gap takes the next value, the last gap the one before it."""
    out, after = np.array(values, float), np.nan
    for i in reversed(range(len(out))):
        after = out[i] = after if np.isnan(out[i]) else out[i]
    known = out[~np.isnan(out)]
    return np.where(np.isnan(out), known[-1] if len(known) else np.nan, out)


def by_hand(fast, slow, start, co2_mult, h2o_mult):
    """The conversion, from the definition of each step."""
    axis = start + pd.to_timedelta(np.arange(len(fast)) * presets.PERIOD_PS // 10**6, unit="us")
    measured = {c: fast[c].to_numpy() * 0.01 for c in ("U", "V", "W")}
    measured["T_SONIC"] = (fast["S"].to_numpy() * 0.02) ** 2 / 1.402 / 287.64 - 273.15
    measured |= {"CO2": fast["C"].to_numpy() * co2_mult, "H2O": fast["Xw"].to_numpy() * h2o_mult} | on_axis(slow, axis)
    out = pd.DataFrame({c: filled(v) for c, v in measured.items()}, index=axis)
    warm = (out["Tlic"] + 273.15) / (32.15 + 273.15)
    h = out["H2O"] * 101.3 / out["Plic"]
    h = (8.1020e-3 * h - 8.1540e-8 * h**2 + 1.2110e-9 * h**3) * warm * 1.114
    x = 1 + 0.5 * h / 1000
    c = out["CO2"] * 1.027330 * 101.3 / (out["Plic"] * x)
    c = 0.14225 * c + 5.9733e-6 * c**2 + 9.0892e-9 * c**3 - 1.2783e-12 * c**4 + 8.5851e-17 * c**5
    return out.assign(H2O=h, CO2=x * c * warm * 1.114)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    rng = np.random.default_rng(11)
    starts = {"Site970107_07": (1, 1), "Site981001_10": (0.33425, 0.335), "Site990615_23": (1, 0.335), "Site050101_00": (1, 0.335), "Site981001_11": (0.33425, 0.335)}
    kinds = [{"damage": "surplus"}, {"damage": "nul", "latin": False}, {"extra": True}, {"damage": "dates"}, {"damage": "long"}]
    made = {}
    for (name, mult), kind in zip(starts.items(), kinds):
        start = pd.Timestamp(dt.datetime.strptime(name, "Site%y%m%d_%H"))
        fast, slow = write_pair(root / name[4:6], name, start, 700, rng, **kind)
        made[f"{name}.raw"] = by_hand(fast, slow, start, *mult)
    (root / "97" / "Site970107_08.raw").write_text("no partner")
    (root / "97" / "notes.txt").write_text("other")
    return root, made


def test_discovery_and_pairing(spark, folder, tmp_path):
    root, made = folder
    pairs = files.discover_pairs(spark, str(root)).orderBy("file_id").collect()
    assert [p.file_id for p in pairs] == sorted(made)
    assert pairs[0].start_ts == dt.datetime(2005, 1, 1) and pairs[0].raw_len > 1000
    for sub in ("a", "b"):
        (tmp_path / sub).mkdir()
        (tmp_path / sub / "X970101_00.RAW").write_text("x" * (1 + (sub == "b")))
    found = files.discover_files(spark, str(tmp_path), "raw").collect()
    assert [(f.name, f.length) for f in found] == [("X970101_00.RAW", 2)]


@pytest.mark.parametrize("max_bytes, limit", [(files.MAX_WHOLE_FILE, {}), (30_000, {}), (10, {"min_hot_rows": 100})])
def test_conversion(spark, folder, max_bytes, limit):
    """Whole-file reading, split reading and series cut into blocks give what pandas gives."""
    root, made = folder
    got = convert.convert_pairs(spark, str(root), max_bytes, **limit).toPandas()
    assert len(got) == sum(map(len, made.values()))
    for name, expected in made.items():
        part = got[got.file_id == name].sort_values("row_idx").set_index("ts")
        assert (part.index == expected.index).all()
        assert part["calibrated"].all()
        for c in expected:
            np.testing.assert_allclose(part[c].astype(float), expected[c], rtol=1e-9, err_msg=f"{name} {c}")

def test_unknown_columns_are_filled(spark, folder):
    root, made = folder
    got = convert.convert_pairs(spark, str(root), raw_extra=["Z [z]"]).toPandas()
    assert got.groupby("file_id")["Z [z]"].count().to_dict() == {n: 700 if n == "Site990615_23.raw" else 0 for n in made}


def test_batch(spark, folder, tmp_path):
    root, made = folder
    out = tmp_path / "out"
    wide = convert.run_batch(spark, str(root), str(out), csv=True).orderBy("start_ts").collect()
    assert [r.start_ts for r in wide] == sorted(m.index[0] for m in made.values())
    first = made["Site970107_07.raw"]
    assert wide[0]["CO2__median"] == pytest.approx(first["CO2"].median())
    assert wide[0]["U__std"] == pytest.approx(first["U"].std())
    parts = list((out / "series_csv" / "file_id=Site970107_07.raw").glob("*.csv.gz"))
    assert len(parts) == 1
    lines = gzip.decompress(parts[0].read_bytes()).decode().splitlines()
    assert lines[0].startswith("U,V,W,T_SONIC,CO2,H2O,")
    assert lines[1].startswith("[m/s],[m/s],[m/s],[degC],[µmol/mol],")
    body = pd.read_csv(parts[0], skiprows=[1])
    np.testing.assert_allclose(body["W"], first["W"], rtol=1e-9)
    stats_files = list((out / "stats_csv").glob("*.csv"))
    assert len(stats_files) == 1
    written = pd.read_csv(stats_files[0])
    assert written["TIMESTAMP"].is_monotonic_increasing
    assert list(written.columns[:5]) == ["TIMESTAMP", "file_id", "CO2 [µmol/mol] count", "CO2 [µmol/mol] min", "CO2 [µmol/mol] max"]
    assert written["Z [z] [z] count"].tolist() == [0, 0, 0, 700, 0]
    assert {"Xa [mmol / mol] mean", "Rhoa [kg / m3] mean"} <= set(written.columns)
    assert written["W [m/s] mean"][0] == pytest.approx(first["W"].mean())
    manifest = spark.read.parquet(str(out / "manifest")).orderBy("file_id").collect()
    assert [(m.n_rows, m.start_label) for m in manifest] == [
        (700, "200501010000"), (700, "199701070700"), (700, "199810011000"), (700, "199810011100"), (700, "199906152300"),
    ]
    assert [(m.co2_mult, m.h2o_mult, m.n_calibrated, m.n_ambiguous) for m in manifest] == [
        (1.0, 0.335, 700, 0), (1.0, 1.0, 700, 0), (0.33425, 0.335, 700, 0), (0.33425, 0.335, 700, 0), (1.0, 0.335, 700, 0),
    ]
    assert len(list((out / "series").glob("date=*"))) == 4
    assert [(m.raw_lines, m.raw_malformed, m.raw_unknown) for m in manifest] == [(700, 0, []), (700, 0, []), (700, 0, []), (700, 3, []), (700, 0, ["Z [z]"])]
    rejected = spark.read.parquet(str(out / "rejects")).collect()
    assert [(r.reason, r.path.split("/")[-1]) for r in rejected if r.path] == [("no partner", "Site970107_08.raw")]
    assert sorted((r.file_id, r.row_idx, r.line.endswith("\t9")) for r in rejected if r.line) == [("Site981001_11.raw", i, True) for i in (2, 3, 500)]
    for m in manifest:
        assert sum(r.file_id == m.file_id and r.side == "raw" for r in rejected) == m.raw_malformed
        assert sum(r.file_id == m.file_id and r.side == "aux" for r in rejected) == m.aux_malformed + m.aux_without_time
    assert spark.read.parquet(str(out / "trends")).count() == 5 * len(set(written.columns[2:])) // 10
    assert spark.read.parquet(str(out / "bounds")).where("variable = 'CO2'").first().lower == min(r["CO2__q01"] for r in wide)


def test_batch_leaves_other_tables(spark, folder, tmp_path):
    """A lazy result that reads landed tables outlives a batch of the same application, whose own tables are gone."""
    from windrow.session import matching, shared_folder

    root, made = folder
    lazy = convert.convert_pairs(spark, str(root))
    convert.run_batch(spark, str(root), str(tmp_path / "out"))
    assert lazy.count() == sum(map(len, made.values()))
    assert not matching(spark, f"{shared_folder(spark)}/batch-*")


def test_periods():
    day = dt.datetime(1998, 12, 30, 22)
    assert files.aligned_periods(day, dt.datetime(2000, 2, 1, 1)) == [
        (day, "hour"), (dt.datetime(1998, 12, 30, 23), "hour"), (dt.datetime(1998, 12, 31), "day"), (dt.datetime(1999, 1, 1), "year"),
        (dt.datetime(2000, 1, 1), "month"), (dt.datetime(2000, 2, 1), "hour"),
    ]
    span = (dt.datetime(1998, 12, 31, 23), dt.datetime(1999, 2, 2))
    assert files.name_glob("raw", span) == "*{981231_23,9901[0-9][0-9]_[0-9][0-9],990201_[0-9][0-9]}.[rR][aA][wW]"


@pytest.fixture(scope="module")
def two_years(tmp_path_factory):
    """A pair for every noon of two years in folders by month; only names matter but for a few days."""
    root = tmp_path_factory.mktemp("years")
    rng = np.random.default_rng(7)
    for n in range(730):
        start = pd.Timestamp("1999-01-01 12:00") + pd.Timedelta(n, unit="D")
        month = root / f"{start:%Y}" / f"{start:%m}"
        if f"{start:%y%m%d}" in ("000310", "000311", "991231", "000101"):
            write_pair(month, f"Site{start:%y%m%d_%H}", start, 50, rng)
            continue
        month.mkdir(parents=True, exist_ok=True)
        for side in ("raw", "aux"):
            (month / f"Site{start:%y%m%d_%H}.{side}").write_text("never read")
    return root


@pytest.mark.parametrize("layout", [None, "%Y/%m"])
def test_range_of_time(spark, two_years, layout):
    """One day of two years: only its files are listed and read, and they are listed once for each side."""
    span = {"start": dt.datetime(2000, 3, 10), "end": dt.datetime(2000, 3, 11), "layout": layout}
    folder = convert.Folder(spark, str(two_years), **span)
    for side, found in folder.found.items():
        assert [f.rsplit("/")[-1] for f in found.inputFiles()] == [f"Site000310_12.{side}"]
    late = two_years / "2000" / "03" / "Other000310_13.raw"
    late.write_text("came after the listing")
    raw, aux = folder.rows()
    assert {r.file_id for r in raw.select("file_id").distinct().collect()} == {"Site000310_12.raw"}
    late.unlink()
    got = convert.convert_pairs(spark, str(two_years), **span)
    assert [(r.file_id, r["count"]) for r in got.groupBy("file_id").count().collect()] == [("Site000310_12.raw", 50)]
    part = {"start": dt.datetime(2000, 3, 10, 12), "end": dt.datetime(2000, 3, 11, 12), "layout": layout}
    assert convert.convert_pairs(spark, str(two_years), **part).count() == 50
    assert convert.convert_pairs(spark, str(two_years), start=dt.datetime(1999, 12, 31, 5), end=dt.datetime(2000, 1, 1, 13), layout=layout).count() == 100
    assert convert.convert_pairs(spark, str(two_years), start=dt.datetime(2005, 1, 1), end=dt.datetime(2005, 2, 1), layout=layout).count() == 0


def test_several_roots(spark, two_years):
    roots = [str(two_years / "1999" / "12"), str(two_years / "2000" / "01")]
    assert files.list_files(spark, roots, "raw").count() == 62
    got = convert.convert_pairs(spark, roots, start=dt.datetime(1999, 12, 31), end=dt.datetime(2000, 1, 2))
    assert {r.file_id for r in got.select("file_id").distinct().collect()} == {"Site991231_12.raw", "Site000101_12.raw"}


def test_two_towers_in_one_hour_stay_apart(spark, tmp_path):
    rng = np.random.default_rng(3)
    start = pd.Timestamp("1997-01-07 07:00")
    for name in ("SiteA970107_07", "SiteB970107_07"):
        write_pair(tmp_path / "in", name, start, 60, rng)
    wide = convert.run_batch(spark, str(tmp_path / "in"), str(tmp_path / "out"), csv=True).collect()
    assert sorted((r.file_id, r["CO2__count"]) for r in wide) == [("SiteA970107_07.raw", 60), ("SiteB970107_07.raw", 60)]
    folders = sorted(p.name for p in (tmp_path / "out" / "series_csv").glob("file_id=*"))
    assert folders == ["file_id=SiteA970107_07.raw", "file_id=SiteB970107_07.raw"]


@pytest.mark.parametrize("max_bytes", [files.MAX_WHOLE_FILE, 10])
def test_lone_line_ends_quotes_and_surplus_cells(spark, tmp_path, max_bytes):
    """Whole and split reading agree on every kind of line end, quoted cells and lines with too many cells."""
    head = "a\nb\nc\nU\tV\tW\tSound\tC\tXw\n[m/s]\t[m/s]\t[m/s]\t[m/50s]\t[mV]\t[mV]\n"
    row = "1\t2\t3\t16000\t1500\t{}"
    body = row.format(1) + "\r" + row.format('"2"') + "\r\n" + row.format(3) + "\tsurplus\n\n" + row.format('"4.5"') + "\n"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "X970101_00.raw").write_bytes((head + body).encode())
    (tmp_path / "in" / "X970101_00.aux").write_text("x\nDate\tTime\tPa\tPlic\tTa\tTlic\n\t\t[kPa]\t[kPa]\t[degC]\t[degC]\n01.01.97\t00:00:00\t80\t80\t10\t35\n")
    raw, _ = convert.Folder(spark, str(tmp_path / "in"), max_bytes).rows()
    rows = raw.select("row_idx", "H2O", "line").collect()
    assert sorted((r.row_idx, r.H2O) for r in rows) == [(0, 1.0), (1, 2.0), (2, 3.0), (3, 4.5)]
    assert [(r.row_idx, r.line) for r in rows if r.line is not None] == [(2, row.format(3) + "\tsurplus")]
    times = {}
    for surplus in ("keep", "drop"):
        got = convert.convert_pairs(spark, str(tmp_path / "in"), max_bytes, surplus=surplus).collect()
        times[surplus] = {r.row_idx: r.ts for r in got}
    assert set(times["drop"]) == {0, 1, 3} and times["drop"].items() <= times["keep"].items()


def test_missing_marker_only_at_the_sink(spark, tmp_path):
    df = spark.sql("SELECT 'f' AS file_id, 0L AS row_idx, timestamp_ntz'2000-01-01 00:00:00' AS start_ts, cast(NULL AS double) AS x")
    sinks.write_series(df, str(tmp_path / "o"), "csv")
    part = next((tmp_path / "o").glob("file_id=*/*.csv.gz"))
    assert gzip.decompress(part.read_bytes()).decode() == "x\n-9999.0\n"


def test_stats_are_ordered(spark, tmp_path):
    wide = spark.range(200).selectExpr("timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(cast(199 - id as int)) AS start_ts", "id AS n")
    sinks.write_stats(wide, str(tmp_path / "s"))
    parts = [pd.read_csv(p) for p in sorted((tmp_path / "s").glob("*.csv"))]
    assert pd.concat(parts)["n"].tolist() == list(range(199, -1, -1))


def test_factor_tables(spark, tmp_path):
    a, b = tmp_path / "a.dat", tmp_path / "b.dat"
    a.write_text("year.from,doy.from,year.to,doy.to,factor.from,factor.to\n1997,0,1997.15,55,1.0,1.54\n")
    b.write_text('"year.from" "doy.from" "year.to" "doy.to" "factor.from" "factor.to"\n1997 10 1997.2 60 2.0 3.0\n')
    both = lookup.combine_factors(
        lookup.daily_factors(factors.read_segments(spark, str(a)), "h2o"),
        lookup.daily_factors(factors.read_segments(spark, str(b), " "), "co2"),
    ).orderBy("date").collect()
    assert len(both) == 60
    assert (both[0].h2o_factor, both[0].co2_factor) == (1.0, None)
    assert both[27].h2o_factor == pytest.approx(1.27)
    assert (both[59].h2o_factor, both[59].co2_factor) == (None, 3.0)
    b.write_text('"year.from" "doy.from" "year.to" "doy.to" "factor.from" "factor.to"\n1997 10 1997.2 60 2.0 x\n')
    with pytest.raises(Exception, match="not a number"):
        lookup.daily_factors(factors.read_segments(spark, str(b), " "), "co2").collect()


def test_text_series(spark, tmp_path):
    df = spark.range(10).selectExpr("'f' AS file_id", "id AS row_idx", "timestamp_ntz'2000-01-01 00:00:00' AS start_ts", "double(id) AS x")
    sinks.write_series(df, str(tmp_path / "o"), "csv", units={"x": "[m]"})
    found = {p.parent.name: gzip.decompress(p.read_bytes()).decode().split() for p in (tmp_path / "o").glob("*/*.csv.gz")}
    assert found == {"file_id=f": ["x", "[m]", *[f"{i}.0" for i in range(10)]]}


def one_file(spark, h2o):
    raw = spark.createDataFrame(
        [("f", i, 1.0, 1.0, 1.0, 16000.0, 1500.0, v) for i, v in enumerate(h2o)],
        "file_id string, row_idx long, U double, V double, W double, T_SONIC double, CO2 double, H2O double",
    ).withColumn("start_ts", F.lit("1997-01-01").cast("timestamp_ntz"))
    slow = spark.createDataFrame([("f", 80.0, 80.0, 10.0, 35.0)], "file_id string, Pa double, Plic double, Ta double, Tlic double")
    return raw, slow.withColumn("ts", F.lit("1997-01-01").cast("timestamp_ntz"))


def test_markers_decoded_early_or_late(spark):
    raw, slow = one_file(spark, [500.0, -9999.0, 250.0])

    def h2o(**options):
        return [r.H2O for r in convert.convert_series(raw, slow, **options).orderBy("row_idx").collect()]

    early, late = h2o(), h2o(late_decode=True)
    assert early[1] == early[2] and early[0] == late[0] == pytest.approx(6.0765112, rel=1e-6)
    assert late[1] is None


def test_dated_factors_come_last(spark):
    raw, slow = one_file(spark, [500.0])
    factors_df = spark.createDataFrame([(dt.date(1997, 1, 1), 2.0, 3.0)], "date date, co2_factor double, h2o_factor double")
    row = convert.convert_series(raw, slow, factors=factors_df).first()
    assert (row.CO2, row.H2O) == (pytest.approx(2 * 395.1143264114937), pytest.approx(3 * 6.076511221065185))
