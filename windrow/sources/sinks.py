"""Writers. Missing values get their marker here and nowhere before."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.operators.columns import encode_missing


def _doubles(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "double"]


def write_series(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    ts: str = "ts",
    start: str = "start_ts",
    by: str = "file_id",
    units: Mapping[str, str] | None = None,
    files: DataFrame | None = None,
    drop_ts: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Write converted series.

    ``parquet`` keeps NULLs and one folder per day of ``ts``; days are balanced over tasks by size. ``csv`` writes
    gzip text with one folder per file, missing values as -9999 and, given ``units``, a second header line.
    """
    if fmt == "parquet":
        dated = df.withColumn("date", F.to_date(ts))
        dated.hint("rebalance", "date").write.mode(mode).partitionBy("date").parquet(path)
        return
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}")
    data = [c for c in df.columns if c not in (by, "row_idx", start) and not (drop_ts and c == ts)]
    simple = [c for c in data if not dict(df.dtypes)[c].startswith(("map", "array", "struct"))]
    encoded = encode_missing(df, [c for c in _doubles(df) if c in simple])
    rows = encoded.select(by, F.col("row_idx").alias("_row"), *[F.col(c).cast("string") for c in simple])
    if units is not None:
        listed = df.select(by).distinct() if files is None else files.select(by)
        second = listed.select(by, F.lit(-1).cast("bigint").alias("_row"), *[F.lit(units.get(c, "[-]")).alias(c) for c in simple])
        rows = second.unionByName(rows)
    placed = rows.repartition(by).sortWithinPartitions(by, "_row").drop("_row")
    placed.write.mode(mode).partitionBy(by).option("compression", "gzip").csv(path, header=True)


@contextmanager
def bucketed(df: DataFrame, path: str, by: str = "file_id", order: str = "row_idx", start: str = "start_ts", buckets: int | None = None) -> Iterator[DataFrame]:
    """Write series to a new folder, one folder per start day, bucketed by file; yields them as a table of the session.

    Rows that are partitioned by file already are written where they are. All rows of a file and day are in one part,
    sorted by file and position, so a reader skips other files by the statistics of the parts. Inside the block,
    groupings, windows and sorts by file read the table without a shuffle. Afterwards only the files remain.
    """
    spark = df.sparkSession
    name = f"windrow_series_{uuid.uuid4().hex}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dated = df.withColumn("date", F.to_date(start))
    dated.write.format("parquet").partitionBy("date").bucketBy(buckets, by).sortBy(by, order).option("path", path).saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def write_units(df: DataFrame, units: Mapping[str, str], path: str, mode: str = "errorifexists") -> None:
    """Units of the columns as a table of their own, for formats that have no place for them."""
    rows = [(c, units[c]) for c in df.columns if c in units]
    df.sparkSession.createDataFrame(rows, "variable string, unit string").coalesce(1).write.mode(mode).csv(path, header=True)


def write_stats(
    wide: DataFrame,
    path: str,
    time: str = "start_ts",
    units: Mapping[str, str] | None = None,
    mode: str = "errorifexists",
) -> None:
    """One row per file, oldest first, in ordered parts (one, while Spark finds the table small).

    Given ``units``, columns are titled with name, unit and statistic.
    """

    def title(column: str) -> str:
        variable, _, stat = column.partition("__")
        return f"{variable} {units[variable]} {stat}" if units and variable in units else column

    first = wide.select(
        F.col(time).alias("TIMESTAMP"), *[F.col(c).alias(title(c)) for c in wide.columns if c != time]
    )
    ordered = first.orderBy("TIMESTAMP", *[c for c in first.columns if c == "file_id"])
    ordered.write.mode(mode).csv(path, header=True)
