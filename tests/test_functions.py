import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from windrow import presets
from windrow.functions import clock, numeric, physics
from windrow.operators import asof, columns, fill, lookup


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_file_time_uses_the_pivot(spark):
    names = ["Site970107_07.raw", "Site050107_07.raw", "Site050107.raw", "Site051307_07.raw"]
    assert column(spark, names, "string", clock.file_time) == [
        dt.datetime(1997, 1, 7, 7), dt.datetime(2005, 1, 7, 7), None, None,
    ]
    assert column(spark, names[:2], "string", clock.file_date) == [dt.date(1997, 1, 7), dt.date(2005, 1, 7)]


def test_date_text(spark):
    texts = ["07.01.97", "01.01.68", "01.01.69", " 7.1.1997", "31.02.97", "x"]
    assert column(spark, texts, "string", clock.date_from_text) == [
        dt.date(1997, 1, 7), dt.date(2068, 1, 1), dt.date(1969, 1, 1), dt.date(1997, 1, 7), None, None,
    ]


def test_timestamp_text(spark):
    df = spark.createDataFrame([("07.01.97", " 12:00:05"), ("07.01.97", "25:00:00"), ("07.01.97", None)], "d string, t string")
    got = [r[0] for r in df.select(clock.timestamp_from_text(F.col("d"), F.col("t"))).collect()]
    assert got == [dt.datetime(1997, 1, 7, 12, 0, 5), None, None]


def test_time_axis_is_exact(spark):
    rows = [0, 1, 2, 12345, 74999, 75000, 10**12]
    expected = [0, 48000, 96000, 592560009, 3599952057, 3600000057, 10**12 * presets.PERIOD_PS // 10**6]
    assert column(spark, rows, "bigint", lambda i: clock.axis_micros(F.lit(0).cast("bigint"), i)) == expected


def test_snap_takes_the_later_grid_point_on_a_tie(spark):
    assert column(spark, [4999, 5000, 14999, 15000, -5000, -5001], "bigint", lambda x: clock.snap(x, 10000)) == [
        0, 10000, 10000, 20000, 0, -10000,
    ]


def test_to_number(spark):
    cells = [" 12 ", "1d", "1f", "NaN", "0x1A", "1_0", "1e3", "", "1,5", "+3", ".5", "5.", None, "Infinity", "-9999"]
    assert column(spark, cells, "string", numeric.to_number) == [
        12.0, None, None, None, None, None, 1000.0, None, None, 3.0, 0.5, 5.0, None, None, -9999.0,
    ]


def test_strict_number(spark):
    assert column(spark, ["1", "", None, " 2.5"], "string", numeric.to_number_strict) == [1.0, None, None, 2.5]
    with pytest.raises(Exception, match="not a number: x1"):
        column(spark, ["x1"], "string", numeric.to_number_strict)


def test_sonic_temperature(spark):
    assert column(spark, [16600.0], "double", physics.sonic_temperature)[0] == pytest.approx(0.17469597140666338, rel=1e-10)


@pytest.mark.parametrize(
    "h2o, co2, p, t, expected",
    [
        (500.0, 1500.0, 80.0, 35.0, (6.076511221065185, 395.1143264114937, True)),
        (0.0, 1500.0, 80.0, 35.0, (0.0, 395.4952360777533, True)),
        (250.0, 1800.0, 75.5, 20.0, (2.946060811788254, 521.8531462227668, True)),
        (500.0, 1500.0, None, 35.0, (500.0, 1500.0, False)),
        (500.0, 1500.0, 0.0, 35.0, (500.0, 1500.0, False)),
        (None, 1500.0, 80.0, 35.0, (None, 1500.0, False)),
    ],
)
def test_calibration(spark, h2o, co2, p, t, expected):
    df = spark.createDataFrame([(h2o, co2, p, t)], "H2O double, CO2 double, Plic double, Tlic double")
    row = columns.calibrate_gas(df).first()
    for got, want in zip((row.H2O, row.CO2), expected):
        assert got == (None if want is None else pytest.approx(want, rel=1e-10))
    assert row.calibrated is expected[2]
    cleared = columns.calibrate_gas(df, on_missing="null").first()
    if not expected[2]:
        assert cleared.CO2 is None


def test_update_keeps_the_old_value_over_nan(spark):
    df = spark.createDataFrame([(1.0, float("nan")), (1.0, None), (1.0, 2.0)], "a double, b double")
    assert [r.a for r in columns.update_non_null(df, {"a": F.col("b")}).collect()] == [1.0, 1.0, 2.0]


def test_sentinels(spark):
    df = spark.createDataFrame([(-9999.0, "None"), (float("nan"), "1"), (2.0, None)], "a double, b string")
    decoded = columns.decode_missing(df, ["a", "b"])
    assert [tuple(r) for r in decoded.collect()] == [(None, None), (None, "1"), (2.0, None)]
    assert [r.a for r in columns.encode_missing(decoded, ["a"]).collect()] == [-9999.0, -9999.0, 2.0]


def test_eras(spark):
    times = ["1998-09-22 11:00:00", "1998-09-22 12:00:00", "1998-12-15 15:00:00", "1998-12-15 16:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    defaults = {"co2_mult": 1.0, "h2o_mult": 1.0}
    got = lookup.lookup_by_interval(df, lookup.era_table(spark), "t", "after", "until", "(]", defaults).orderBy("i")
    expected = [(1, 1), (0.33425, 0.335), (0.33425, 0.335), (1, 0.335)]
    assert [(r.co2_mult, r.h2o_mult) for r in got.collect()] == expected


KINDS = {
    "time": "timestamp_ntz'2023-12-31 00:00:00' + make_dt_interval(0, cast({} as int))",
    "date": "date_add(date'2020-01-01', cast({} as int))",
    "bigint": "cast({} as bigint)",
    "double": "cast({} as double) / 2",
}


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("bounds", ["(]", "[]", "[)", "()"])
def test_interval_tables_of_any_size_give_the_same(spark, kind, bounds):
    """Gaps, overlaps, equal starts, open ends, NULL values and both border rules: one row per row, as the definition says."""
    rng = random.Random(7)
    rows = [(s, s + rng.choice([0, 1, 3, 30]), i) for i, s in enumerate(rng.choices(range(0, 300), k=120))] + [(None, 2, 900), (290, None, 901), (50, None, 902)]
    table = spark.createDataFrame(rows, "s bigint, e bigint, v bigint").selectExpr(f"{KINDS[kind].format('s')} AS start", f"{KINDS[kind].format('e')} AS end", "v", "s", "e")
    points = [*range(-3, 340), None]
    df = spark.createDataFrame([(p,) for p in points], "p bigint").selectExpr("p", f"{KINDS[kind].format('p')} AS x")

    def look(**options):
        found = lookup.lookup_by_interval(df, table, "x", "start", "end", bounds, {"v": -1}, **options)
        assert found.columns == ["p", "x", "v", "s", "e"]
        return sorted(((r.p, r.v) for r in found.collect()), key=str)

    def by_hand(p):
        if p is None:
            return -1
        begun = [(s is not None, s or 0, e is None, e or 0, v) for s, e, v in rows if s is None or (s <= p if bounds[0] == "[" else s < p)]
        _, _, open_, e, v = max(begun)
        return v if open_ or (p <= e if bounds[1] == "]" else p < e) else -1

    same_start = {}
    for s, e, v in rows:
        same_start.setdefault((s, e), []).append(v)
    want = sorted(((p, by_hand(p)) for p in points), key=str)
    for got in (look(), look(max_broadcast=3), look(max_broadcast=None), look(max_broadcast=3, min_hot_rows=50)):
        assert len(got) == len(want)
        for (p, v), (q, w) in zip(got, want):
            assert p == q and (v == w or any(v in x and w in x for x in same_start.values()))


@pytest.mark.parametrize("zone", ["UTC", "Europe/Zurich", "America/New_York"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    """Across both changes of the clock: counting, the axis, truncation, labels, nearest rows and interpolation."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for day in ("1997-03-30", "1997-10-26"):
            start = dt.datetime.fromisoformat(f"{day} 00:00:00")
            hours = spark.range(0, 360).selectExpr("1 AS k", "id AS row_idx", f"timestamp_ntz'{day} 00:00:00' AS start_ts")
            axis = fill.assign_time_axis(hours, period_ps=60_000_000_000_000)
            rows = axis.select("row_idx", "ts", clock.micros(F.col("ts")).alias("us"), clock.truncated(F.col("ts"), 3_600_000_000).alias("h"), clock.label(F.col("ts")).alias("l")).orderBy("row_idx").collect()
            for r in rows:
                at = start + dt.timedelta(minutes=r.row_idx)
                assert (r.ts, r.h, r.l) == (at, at.replace(minute=0), at.strftime("%Y%m%d%H%M"))
                assert r.us == (at - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
            slow = axis.where("row_idx % 10 = 0").selectExpr("k", "ts", "double(row_idx) AS v")
            near = asof.asof_join(axis, slow, "ts", ["k"], ["v"], "nearest", 1_000, "at").where("v IS NOT NULL").collect()
            assert [(r.v, r.at) for r in sorted(near, key=lambda r: r.v)] == [(float(10 * i), start + dt.timedelta(minutes=10 * i)) for i in range(36)]
            lines = asof.interpolate_linear(axis, slow, "ts", ["k"], ["v"]).orderBy("row_idx").collect()
            assert [r.v for r in lines] == pytest.approx([min(float(i), 350.0) for i in range(360)])
            dense = fill.densify(axis.where("row_idx % 90 = 0").select("k", "ts"), ["k"], "ts", 1_800_000_000)
            assert dense.count() == 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_infinite_results_leave_the_old_value(spark):
    df = spark.createDataFrame([(1e70, 500.0, 80.0, 35.0), (float("inf"), 500.0, 80.0, 35.0), (500.0, 1e300, 80.0, 35.0)], "CO2 double, H2O double, Plic double, Tlic double")
    got = columns.calibrate_gas(df).collect()
    assert [(r.CO2 if i < 2 else r.H2O, r.calibrated) for i, r in enumerate(got)] == [(1e70, False), (float("inf"), False), (1e300, False)]
    cleared = columns.calibrate_gas(df, on_missing="null").collect()
    assert [r.CO2 for r in cleared[:2]] == [None, None]


def test_period_linear(spark):
    df = spark.createDataFrame([("1997-06-01 00:00:00", 2.0), ("1998-01-01 00:10:00", 2.0)], "t string, h double")
    df = df.withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = lookup.period_linear(df, lookup.period_table(spark), "t", "h")
    assert [r.h for r in got.orderBy("t").collect()] == [pytest.approx(1.087378 * 2 + 24.757392), 2.0]


def test_ramp(spark):
    segments = spark.createDataFrame(
        [(1997.0, 0, 1997.15, 55, 1.0, 1.54), (1997.15, 55, 1997.2, 56, 3.0, 4.0), (1997.2, 58, 1997.2, 60, 6.0, 7.0)],
        "year_from double, doy_from int, year_to double, doy_to int, factor_from double, factor_to double",
    )
    got = {str(r.date): r.f for r in lookup.expand_ramp(lookup.segment_dates(segments), "f").collect()}
    assert len(got) == 60
    assert got["1997-01-01"] == 1.0
    assert got["1997-01-28"] == pytest.approx(1.27)
    assert got["1997-02-24"] == 1.54
    assert got["1997-02-25"] == 4.0  # a segment of one day: its end counts
    assert got["1997-02-26"] == pytest.approx(4 + 2 / 3)  # a gap is bridged
    assert got["1997-03-01"] == 7.0


def test_dated_factor(spark):
    factors = spark.createDataFrame([(dt.date(2000, 1, 1), 2.0), (dt.date(2000, 1, 2), None)], "date date, f double")
    df = spark.createDataFrame([(dt.date(2000, 1, d), 3.0) for d in (1, 2, 3)], "d date, x double")
    got = lookup.apply_dated_factor(df, factors, "d", {"x": "f"}).orderBy("d").collect()
    assert [(r.x, r.factor_missing) for r in got] == [(6.0, False), (3.0, False), (3.0, True)]
    with pytest.raises(Exception, match="no factor for 2000-01-03"):
        lookup.apply_dated_factor(df, factors, "d", {"x": "f"}, on_missing="error").collect()
