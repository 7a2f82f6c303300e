"""Shapes of physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

from windrow.operators import asof, fill, hot, stats
from windrow.plans import convert, queries

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan_of(df).count("Exchange hashpartitioning") + plan_of(df).count("Exchange SinglePartition")


@pytest.fixture
def fast(spark):
    return spark.range(100).selectExpr(
        "concat('f', id % 3) AS file_id", "timestamp_ntz'2000-01-01 00:00:00' AS start_ts", "id AS row_idx",
        *[f"double(id) AS {c}" for c in convert.FAST], "1.0D AS co2_mult", "1.0D AS h2o_mult",
    )


@pytest.fixture
def slow(spark):
    return spark.range(50).selectExpr(
        "concat('f', id % 3) AS file_id", "timestamp_micros(id * 1000000)::timestamp_ntz AS ts", *[f"double(id) AS {c}" for c in convert.SLOW]
    )


def test_conversion_and_statistics_shuffle_each_side_once(spark, fast, slow):
    series = convert.convert_series(fast, slow, min_hot_rows=0)
    assert shuffles(series) == 2
    assert shuffles(stats.summarize(series, ["file_id"], convert.FAST, max_percentile_rows=None)) == 2


def test_asof_shuffles_each_side_once(spark, fast, slow):
    left = fill.assign_time_axis(fast)
    assert shuffles(asof.asof_join(left, slow, "ts", ["file_id"], ["Pa"], min_hot_rows=0)) == 2


def test_no_cross_join_and_no_python(spark):
    for name, query in queries.QUERIES.items():
        plan = plan_of(query(spark, SF))
        assert "CartesianProduct" not in plan, name
        assert "Python" not in plan, name


def test_scans_read_only_what_is_needed(spark):
    plan = plan_of(queries.summary_by_hour(spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,value:double>" in plan
    plan = plan_of(queries.played_lines(spark, SF, 0)[1])
    assert "EqualTo(event_type,signup)" in plan


def test_hot_keys_are_found(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 500) END AS k", "id")
    keys, n, largest = hot.hot_keys(df, ["k"], 1_000)
    assert [(r.k, r._rows) for r in keys.collect()] == [("hot", 10_000)] and (n, largest) == (1, 10_000)
    assert hot.hot_keys(df, ["k"], 10_000) is None
    cut = hot.cut_series(df, ["k"], ["id"], 1_000)
    sizes = {(r.k, r[hot.BLOCK]): r["count"] for r in cut.df.groupBy("k", hot.BLOCK).count().collect()}
    assert max(n for (k, _), n in sizes.items() if k == "hot") < 1_000
    assert {b for (k, b) in sizes if k != "hot"} == {0}


@pytest.mark.parametrize("apart", [0, 3_600])
def test_every_hot_key_is_cut_by_its_own_borders(spark, apart):
    """Forty keys, all at one time or an hour apart, one of them much larger: no block holds over twice the limit."""
    rows = spark.range(20_000).selectExpr("least(id % 50, 40) AS k", "id").selectExpr("k", f"timestamp_micros((k * {apart} * 1000 + id) * 1000)::timestamp_ntz AS ts", "double(id) AS v")
    cut = hot.cut_series(rows, ["k"], ["ts"], 100)
    sizes = cut.df.groupBy("k", hot.BLOCK).count().collect()
    assert {r.k for r in sizes} == set(range(41)) and max(r["count"] for r in sizes) <= 200
    assert len(sizes) >= 41 * 4
    by_key = cut.df.groupBy("k", hot.BLOCK).agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("k", hot.BLOCK).collect()
    assert all(x.b <= y.a for x, y in zip(by_key, by_key[1:]) if x.k == y.k)
    whole, split = (stats.summarize(rows, ["k"], ["v"], max_percentile_rows=m).orderBy("k").collect() for m in (None, 100))
    assert whole == split


def jobs(spark, build):
    """How many jobs run while a DataFrame is built."""
    tracker, group = spark.sparkContext.statusTracker(), f"build-{id(build)}"
    spark.sparkContext.setJobGroup(group, "building")
    try:
        build()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_building_starts_no_jobs_when_sizes_are_known(spark, fast, slow):
    assert jobs(spark, lambda: convert.convert_series(fast, slow, min_hot_rows=0)) == 0
    assert jobs(spark, lambda: fill.bffill(fast, ["file_id"], ["row_idx"], ["U"], 0)) == 0
    assert jobs(spark, lambda: stats.summarize(fast, ["file_id"], ["U"], max_percentile_rows=None)) == 0
    era = convert.with_era(fast.drop("co2_mult", "h2o_mult"))
    assert jobs(spark, lambda: convert.with_era(fast.drop("co2_mult", "h2o_mult"))) == 0 and era.columns[-1] == "h2o_mult"


def test_conversion_scans_each_side_once(spark):
    plan = plan_of(queries.played_series(spark, SF, 0))
    assert plan.count("FileScan parquet") <= 4  # rows and list of files of both sides
    assert "CartesianProduct" not in plan


def test_hot_block_table_is_broadcast(spark):
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 500) END AS k", "id", "double(id) AS v")
    plan = plan_of(fill.bffill(df, ["k"], ["id"], ["v"], 1_000))
    assert "SortMergeJoin" not in plan


def test_landed_tables_go_to_the_shared_folder(spark):
    from windrow.session import clear_shared, landed, shared_folder

    table = landed(spark.range(5).withColumn("x", F.lit(None).cast("double")), "five")
    assert table.count() == 5 and table.columns == ["id", "x"]
    assert all(shared_folder(spark).removeprefix("file:") in f for f in table.inputFiles())
    clear_shared(spark)
