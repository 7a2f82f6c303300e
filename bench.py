"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of cores. Each query is run once to warm up and then timed to
the end of its result (``noop`` sink), including the row counts it takes while the plan is built.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from windrow.plans.queries import QUERIES

HEADLINE = (
    "summary_by_hour",
    "summary_by_type",
    "summary_lineitem",
    "halfhour_summary",
    "calibrate_gas",
    "row_index",
    "bffill",
    "dedupe_last",
    "asof_nearest",
    "interp_linear",
    "align_slow",
    "factor_join",
    "ramp_daily",
    "parse_table",
    "convert_series",
    "series_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("windrow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        run(name)
        seconds[name] = round(run(name), 3)
    spark.stop()
    print(json.dumps({"metric": "total_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
