"""Segment tables of dated correction factors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIELDS = ("year_from", "doy_from", "year_to", "doy_to", "factor_from", "factor_to")


def read_segments(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Segments as text columns; ``daily_factors`` checks and converts the numbers."""
    schema = ", ".join(f"{name} string" for name in FIELDS)
    return spark.read.csv(path, header=True, sep=sep, quote='"', schema=schema, enforceSchema=True)
