import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrow.operators import columns, quality, stats


def expected_summary(table, by, cols):
    out = {}
    for key, group in table.groupby(by):
        for c in cols:
            s = group[c].replace(-9999, np.nan)
            out[key, c] = [s.count(), s.min(), s.max(), s.mean(), s.std(), s.median(), *[s.quantile(q) for q in (0.01, 0.05, 0.95, 0.99)]]
    return out


def table():
    rng = np.random.default_rng(3)
    parts = []
    for key, n in enumerate((3000, 200, 5, 1)):
        part = pd.DataFrame({"k": [f"k{key}"] * n, "a": rng.normal(size=n).round(1), "b": rng.exponential(size=n)})
        part.loc[rng.random(n) < 0.1, "b"] = -9999.0
        parts.append(part)
    parts.append(pd.DataFrame({"k": ["flat"] * 700, "a": [1.0] * 699 + [2.0], "b": [-9999.0] * 700}))
    return pd.concat(parts, ignore_index=True)


@pytest.mark.parametrize("limit", [None, 10**9, 150, 2])
def test_summary(spark, limit):
    data = table()
    wide = stats.summarize(spark.createDataFrame(data), ["k"], ["a", "b"], max_percentile_rows=limit)
    got = {(r.k, r.variable): [r[s] for s in stats.STATS] for r in stats.to_long(wide, ["k"], ["a", "b"]).collect()}
    expected = expected_summary(data, "k", ["a", "b"])
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        have = [np.nan if v is None else v for v in got[key]]
        assert have == pytest.approx(values, nan_ok=True, rel=1e-9), key


@pytest.mark.parametrize("limit", [None, 100])
def test_summary_of_everything(spark, limit):
    data = table()
    row = stats.summarize(spark.createDataFrame(data), [], ["a"], max_percentile_rows=limit).first()
    assert row["a__q05"] == pytest.approx(data["a"].quantile(0.05))
    assert row["a__count"] == len(data)


def test_fixture(spark):
    df = spark.createDataFrame([(1, v) for v in (1.0, 2.0, 4.0, 10.0)] + [(2, 3.0)], "k int, v double")
    one, two = stats.summarize(df, ["k"], ["v"]).orderBy("k").collect()
    assert one["v__std"] == pytest.approx(4.031128874149275)
    assert [one[f"v__{s}"] for s in ("q01", "q05", "median", "q95", "q99")] == pytest.approx([1.03, 1.15, 3, 9.1, 9.82])
    assert two["v__std"] is None


def test_empty_groups_and_own_statistics(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 3.0)], "k int, v double")
    groups = spark.createDataFrame([(1,), (2,)], "k int")
    wide = stats.summarize(df, ["k"], ["v"], extra={"range": lambda c: F.max(c) - F.min(c)}, groups=groups)
    long = stats.to_long(wide, ["k"], ["v"], {"v": "[m]"}, ["range"]).orderBy("k").collect()
    assert [(r["count"], r["mean"], r["range"], r["unit"]) for r in long] == [(2, 2.0, 2.0, "[m]"), (0, None, None, "[m]")]


def test_infinite_values_give_the_same_at_every_size(spark):
    inf = float("inf")
    values = [float(i) for i in range(40)] + [inf] * 5 + [-inf] * 3
    df = spark.createDataFrame([(k, v) for k in (1, 2, None) for v in values[: 48 if k else 20]], "k int, v double")
    whole, split = (stats.summarize(df, ["k"], ["v"], max_percentile_rows=m).orderBy("k").collect() for m in (None, 10))
    assert [[str(x) for x in r] for r in whole] == [[str(x) for x in r] for r in split]
    assert whole[1]["v__q95"] == inf


def test_groups_that_are_not_listed_stay(spark):
    df = spark.createDataFrame([(1, 1.0), (3, 5.0), (None, 7.0)], "k int, v double")
    groups = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    got = stats.summarize(df, ["k"], ["v"], groups=groups).collect()
    assert sorted((str(r.k), r["v__count"], r["v__mean"]) for r in got) == [("1", 1, 1.0), ("2", 0, None), ("3", 1, 5.0), ("None", 1, 7.0)]


def test_sketch_quantiles_are_close(spark):
    row = stats.summarize(spark.range(10_001).selectExpr("double(id) AS v"), [], ["v"], exact=False).first()
    assert row["v__median"] == pytest.approx(5000, abs=2)


def test_bins(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:29:59' AS ts, 1.0D AS v UNION ALL SELECT timestamp_ntz'2024-01-01 00:30:00', 2.0D")
    got = stats.bin_summarize(df, "ts", "30 minutes", ["v"]).orderBy("bin").collect()
    assert [(r.bin, r["v__mean"]) for r in got] == [(dt.datetime(2024, 1, 1), 1.0), (dt.datetime(2024, 1, 1, 0, 30), 2.0)]


def test_second_level(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (1, 2.0, 6.0), (2, 8.0, 7.0)], "k int, a double, b double")
    long = stats.to_long(stats.summarize(df, ["k"], ["a", "b"]), ["k"], ["a", "b"])
    bounds = {r.variable: (r.lower, r.upper) for r in stats.robust_bounds(long).collect()}
    assert bounds == {"a": (pytest.approx(1.01), 8.0), "b": (pytest.approx(5.01), 7.0)}
    band = stats.trend_bands(long, "k").where("variable = 'a' AND k = 1").first()
    assert band.mean_plus_std == pytest.approx(1.5 + 0.5**0.5)
    assert stats.distinct_variables(long).count() == 2
    assert stats.annotations(long, ["k"]).columns == ["k", "variable", "unit", "count", "median", "mean", "min", "max"]


def test_column_states(spark):
    df = spark.createDataFrame([(None, "1", "x", "FF"), (None, "2", "1", "0A")], "a string, b string, c string, d string")
    got = quality.profile_columns(df, ["a", "b", "c", "d"], {"d": "[hexadecimal_value]"})
    assert {r.variable: r.state for r in got.collect()} == {"a": "EMPTY", "b": "OK", "c": "NON-NUMERIC", "d": "HEXADECIMAL"}


def test_availability(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 30), 1_000_000, 500_000), (dt.date(2024, 2, 2), 2_000_000, 0)], "d date, r long, a long")
    daily = quality.densify_days(quality.daily_sizes(df, "d", ["r", "a"]))
    assert daily.count() == 4
    january, february = quality.availability_matrix(daily).orderBy("year_month").collect()
    assert (january["30"], january["31"], february["1"], february["2"]) == (1.5, None, None, 2.0)


def test_valid_rows(spark):
    df = spark.sql(
        """SELECT * FROM VALUES ('01.01.97', '00:00:01', timestamp_ntz'1997-01-01 00:00:01'),
        ('01.01.97', '0:00:01', timestamp_ntz'1997-01-01 00:00:01'), ('01.ja.97', '00:00:01', timestamp_ntz'1997-01-01 00:00:01'),
        ('01.01.97', '01:00:00', timestamp_ntz'1997-01-01 01:00:00') AS t(d, t, ts)"""
    ).withColumn("start", F.lit("1997-01-01").cast("timestamp_ntz"))
    assert columns.valid_rows(df, "d", "t", "ts", "start").count() == 1


def test_sorted_columns(spark):
    assert columns.sort_columns(spark.sql("SELECT 1 AS b, 2 AS C, 3 AS a")).columns == ["C", "a", "b"]
