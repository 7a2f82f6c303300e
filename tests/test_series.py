"""Ordered operators against pandas, with and without cutting of large keys."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrow.operators import asof, fill

PROBES = [10**9, 40]  # 40: every key above 40 rows is cut


def series(seed=1, sizes=(400, 60, 30, 1), columns=("a", "b")):
    rng = np.random.default_rng(seed)
    parts = []
    for key, n in enumerate(sizes):
        part = pd.DataFrame({"k": [f"k{key}"] * n, "i": rng.choice(10 * n, n, replace=False)})
        for c in columns:
            values = rng.normal(size=n)
            values[rng.random(n) < 0.8] = np.nan
            part[c] = values
        parts.append(part)
    table = pd.concat(parts, ignore_index=True)
    table.loc[table.k == "k0", "b"] = np.nan
    return table.sample(frac=1, random_state=seed).reset_index(drop=True)


def to_spark(spark, table):
    kinds = {"O": "string", "i": "bigint", "f": "double", "M": "timestamp_ntz"}
    schema = ", ".join(f"{c} {kinds[t.kind]}" for c, t in table.dtypes.items())
    rows = table.astype(object).where(table.notna(), None).values.tolist()
    plain = [[v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in row] for row in rows]
    return spark.createDataFrame(plain, schema)


def same(got, expected, keys):
    got = got.sort_values(keys).reset_index(drop=True)[list(expected.columns)]
    expected = expected.sort_values(keys).reset_index(drop=True)
    pd.testing.assert_frame_equal(got, expected, check_dtype=False, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("probe", PROBES)
@pytest.mark.parametrize("name", ["ffill", "bfill", "bffill"])
def test_fills(spark, probe, name):
    table = series()
    got = getattr(fill, name)(to_spark(spark, table), ["k"], ["i"], ["a", "b"], probe).toPandas()
    ordered = table.sort_values(["k", "i"])
    groups = ordered.groupby("k")[["a", "b"]]
    if name == "bffill":
        filled = groups.transform(lambda s: s.bfill().ffill())
    else:
        filled = getattr(groups, name)()
    same(got, ordered.assign(a=filled["a"], b=filled["b"]), ["k", "i"])


def test_fill_fixture(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([None, 5.0, None, 7.0, None])], "i int, v double")
    got = fill.bffill(df, [], ["i"], ["v"]).orderBy("i").collect()
    assert [r.v for r in got] == [5, 5, 7, 7, 7]


@pytest.mark.parametrize("probe", PROBES)
def test_null_keys_form_one_series(spark, probe):
    table = series(sizes=(100,))
    df = to_spark(spark, table).withColumn("k", F.lit(None).cast("string"))
    got = fill.ffill(df, ["k"], ["i"], ["a"], probe).toPandas().sort_values("i")
    assert got["a"].tolist()[5:] == pytest.approx(table.sort_values("i")["a"].ffill().tolist()[5:], nan_ok=True)


@pytest.mark.parametrize("probe", PROBES)
def test_row_index(spark, probe):
    table = series()
    got = fill.row_index(to_spark(spark, table), ["k"], ["i"], min_hot_rows=probe).toPandas()
    expected = table.assign(row_idx=table.groupby("k")["i"].rank().astype(int) - 1)
    same(got, expected, ["k", "i"])


@pytest.mark.parametrize("probe", PROBES)
def test_clumped_order(spark, probe):
    """Nearly all rows of a key share one instant; the second ordering column settles their order."""
    table = pd.DataFrame({"k": "a", "i": [1] * 500 + [2, 3], "j": range(502), "v": [float(n) if n % 50 == 0 else np.nan for n in range(502)]})
    got = fill.ffill(to_spark(spark, table), ["k"], ["i", "j"], ["v"], probe).toPandas()
    same(got, table.assign(v=table["v"].ffill()), ["j"])


def test_dedupe_last(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 3), ("a", 1, 2), ("b", 1, 0)], "k string, t int, i int")
    assert sorted(tuple(r) for r in fill.dedupe_last(df, ["k", "t"], ["i"]).collect()) == [("a", 1, 3), ("b", 1, 0)]


def test_dedupe_last_limits_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id")
    plan = fill.dedupe_last(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan.split("WindowGroupLimit")[-1]


def test_fill_needs_one_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k", "id AS i", "double(id) AS v")
    plan = fill.bffill(df, ["k"], ["i"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_densify(spark):
    df = spark.sql("SELECT date'2024-01-01' AS d, 1.0D AS v UNION ALL SELECT date'2024-01-04', 4.0D")
    got = fill.densify(df, [], "d").orderBy("d").collect()
    assert [(r.d.day, r.v) for r in got] == [(1, 1.0), (2, None), (3, None), (4, 4.0)]


def test_densify_keeps_keys_apart(spark):
    df = spark.sql("SELECT 'a' AS k, date'2024-01-01' AS d, 1.0D AS v UNION ALL SELECT 'a', date'2024-01-03', 2.0D UNION ALL SELECT 'b', date'2024-05-01', 3.0D")
    got = fill.densify(df, ["k"], "d").orderBy("k", "d").collect()
    assert [(r.k, r.d.day, r.v) for r in got] == [("a", 1, 1.0), ("a", 2, None), ("a", 3, 2.0), ("b", 1, 3.0)]


def test_densify_loses_no_row(spark):
    """A NULL key, rows between the steps, rows without time and two rows of one step come through."""
    rows = [(None, "00:00:00", 1.0), (None, "03:00:00", 2.0), ("a", "00:00:00", 3.0), ("a", "01:30:00", 4.0), ("a", "02:00:00", 5.0), ("a", "02:00:00", 6.0), ("a", None, 7.0)]
    df = spark.createDataFrame(rows, "k string, t string, v double").selectExpr("k", "cast('2024-01-01 ' || t AS timestamp_ntz) AS t", "v")
    got = sorted((str(r.k), str(r.t)[11:], str(r.v)) for r in fill.densify(df, ["k"], "t", 3_600_000_000).collect())
    assert got == sorted([
        ("None", "00:00:00", "1.0"), ("None", "01:00:00", "None"), ("None", "02:00:00", "None"), ("None", "03:00:00", "2.0"),
        ("a", "00:00:00", "3.0"), ("a", "01:00:00", "None"), ("a", "02:00:00", "5.0"), ("a", "02:00:00", "6.0"), ("a", "01:30:00", "4.0"), ("a", "", "7.0"),
    ])


def timed(seed, keys, n, names, spread=3_600_000_000):
    rng = np.random.default_rng(seed)
    parts = []
    for k in range(keys):
        us = rng.choice(spread // 1000, n, replace=False) * 1000
        part = pd.DataFrame({"k": f"k{k}", "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(us), unit="us")})
        for name in names:
            part[name] = rng.normal(size=n)
        parts.append(part)
    return pd.concat(parts, ignore_index=True)


@pytest.mark.parametrize("probe", PROBES)
@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 20_000_000])
def test_asof(spark, probe, direction, tolerance):
    left, right = timed(1, 3, 120, ["x"]), timed(2, 2, 60, ["y"])
    got = asof.asof_join(
        to_spark(spark, left), to_spark(spark, right), "ts", ["k"], ["y"], direction, tolerance, "rts", probe
    ).toPandas()
    expected = pd.merge_asof(
        left.sort_values("ts"), right.assign(rts=right["ts"]).sort_values("ts"), on="ts", by="k", direction=direction,
        tolerance=None if tolerance is None else pd.Timedelta(tolerance, unit="us"),
    )
    assert expected["y"].notna().sum() > 20
    same(got[["k", "ts", "x", "y", "rts"]], expected[["k", "ts", "x", "y", "rts"]], ["k", "ts"])


def test_asof_tie_takes_the_later_row(spark):
    left = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:02' AS ts")
    right = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:01' AS ts, 'a' AS v UNION ALL SELECT timestamp_ntz'2024-01-01 00:00:03', 'b'")
    assert asof.asof_join(left, right, "ts", [], ["v"], "nearest").first().v == "b"


def stamp(seconds):
    return pd.Timestamp("2024-01-01") + pd.Timedelta(round(seconds * 1e6), unit="us")


def test_interpolation_fixture(spark):
    right = pd.DataFrame({"k": "a", "ts": [stamp(s) for s in (0, 1, 3, 4, 5)], "v": [np.nan, 1, np.nan, 4, np.nan]})
    left = pd.DataFrame({"k": "a", "ts": [stamp(s) for s in (0, 0.5, 1, 1.5, 4, 4.5, 5)]})
    got = asof.interpolate_linear(to_spark(spark, left), to_spark(spark, right), "ts", ["k"], ["v"])
    assert [r.v for r in got.orderBy("ts").collect()] == [None, None, 1, 1.5, 4, 4, 4]


def test_interpolation_grid_fixture(spark):
    right = pd.DataFrame({"k": "a", "ts": [stamp(s) for s in range(6)], "v": [1.0, 2, 3, 4, 5, 6]})
    at = [-0.048, -0.049, 1.005, 5.048, 5.049, 2.0149]
    left = pd.DataFrame({"k": "a", "i": range(6), "ts": [stamp(s) for s in at]})
    got = asof.interpolate_linear(
        to_spark(spark, left), to_spark(spark, right), "ts", ["k"], ["v"], 48_000, 10_000
    ).orderBy("i").collect()
    assert [None if r.v is None else round(r.v, 9) for r in got] == [1, None, 2.01, 6, None, 3.01]


@pytest.mark.parametrize("probe", PROBES)
def test_upsample_nearest_fill_against_pandas(spark, probe):
    """The whole alignment: upsample to 10 ms, interpolate, nearest within 48 ms, fill backward and forward."""
    rng = np.random.default_rng(5)
    lefts, rights, expected = [], [], []
    for k in range(6):
        start = pd.Timestamp("2024-01-01") + pd.Timedelta(k, unit="h")
        n = 900
        axis = start + pd.to_timedelta(np.arange(n) * 48_000_000_768 // 1_000_000, unit="us")
        seconds = np.arange(-3 if k % 2 else 4, 46 if k % 3 else 38)
        seconds = seconds[rng.random(len(seconds)) > 0.2]
        slow = pd.DataFrame(rng.normal(size=(len(seconds), 3)), columns=["p", "q", "r"])
        slow[rng.random(slow.shape) < 0.3] = np.nan
        if k == 2:
            slow["r"] = np.nan
        slow.index = start + pd.to_timedelta(seconds, unit="s")
        fast = pd.DataFrame({"x": rng.normal(size=n)}, index=axis)
        fast[rng.random(fast.shape) < 0.3] = np.nan
        aligned = slow.resample("10ms").interpolate("linear").reindex(axis, method="nearest", tolerance="48ms")
        merged = pd.concat([fast, aligned], axis=1).bfill().ffill()
        key = f"f{k}"
        lefts.append(fast.reset_index(names="ts").assign(k=key, i=range(n)))
        rights.append(slow.reset_index(names="ts").assign(k=key))
        expected.append(merged.reset_index(names="ts").assign(k=key, i=range(n)))
    left, right = to_spark(spark, pd.concat(lefts)), to_spark(spark, pd.concat(rights))
    got = asof.interpolate_linear(left, right, "ts", ["k"], ["p", "q", "r"], 48_000, 10_000, probe)
    got = fill.bffill(got, ["k"], ["i"], ["x", "p", "q", "r"], probe)
    same(got.toPandas(), pd.concat(expected), ["k", "i"])


def test_densify_long_range_of_milliseconds(spark, monkeypatch):
    monkeypatch.setattr(fill, "CHUNK_STEPS", 7)
    df = spark.range(0, 1000, 30).selectExpr("timestamp_micros(id * 48000) AS t", "double(id) AS v")
    got = fill.densify(df, [], "t", 48_000)
    assert got.count() == 991 and got.where("v is not null").count() == 34
    assert got.select("t").distinct().count() == 991
