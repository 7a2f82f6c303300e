"""What data there is, and in what state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.functions.clock import label
from windrow.functions.numeric import to_number
from windrow.operators.columns import date_labels
from windrow.operators.fill import densify

HEX_UNIT = "hexadecimal_value"


def daily_sizes(df: DataFrame, date: str, bytes_cols: Sequence[str], out: str = "mb") -> DataFrame:
    """Megabytes per day, summed over the size columns of all files of the day."""
    size = sum((F.col(c) / F.lit(1e6) for c in bytes_cols), F.lit(0.0))
    return df.groupBy(F.col(date).cast("date").alias("date")).agg(F.sum(size).alias(out))


def densify_days(daily: DataFrame, date: str = "date") -> DataFrame:
    return densify(daily, (), date)


def availability_matrix(daily: DataFrame, date: str = "date", measure: str = "mb") -> DataFrame:
    """Months by days of the month; several rows of a day add up. The listed days spare the job that would look for them."""
    labelled = date_labels(daily, date)
    return labelled.groupBy("year_month").pivot("day", list(range(1, 32))).agg(F.sum(measure))


def profile_columns(df: DataFrame, cols: Sequence[str], units: Mapping[str, str] | None = None) -> DataFrame:
    """State of text columns: ``OK``, ``EMPTY``, ``HEXADECIMAL`` or ``NON-NUMERIC``, with the counts behind it."""
    units = units or {}
    counts = []
    for i, c in enumerate(cols):
        counts += [F.count(c).alias(f"v{i}"), F.count(to_number(F.col(c))).alias(f"n{i}")]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("variable"),
                F.lit(units.get(c, "[-]")).alias("unit"),
                "n_rows",
                F.col(f"v{i}").alias("n_values"),
                F.col(f"n{i}").alias("n_numeric"),
            )
            for i, c in enumerate(cols)
        ]
    )
    state = (
        F.when(F.col("n_values") == 0, "EMPTY")
        .when(F.contains("unit", F.lit(HEX_UNIT)), "HEXADECIMAL")
        .when(F.col("n_values") > F.col("n_numeric"), "NON-NUMERIC")
        .otherwise("OK")
    )
    return counted.select(F.inline(rows)).withColumn("state", state)


def file_manifest(
    rows: DataFrame, by: str = "file_id", ts: str = "ts", malformed: str | None = None, flags: Sequence[str] = ()
) -> DataFrame:
    """Rows, time span and start label of every file, and in how many rows each flag is set."""
    bad = F.count_if(F.col(malformed)) if malformed else F.lit(0).cast("bigint")
    return (
        rows.groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            bad.alias("n_malformed"),
            *[F.count_if(F.col(flag)).alias(f"n_{flag}") for flag in flags],
        )
        .withColumn("start_label", label(F.col("first_ts")))
    )
