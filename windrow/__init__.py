"""Preparation of sensor time series on Spark: parse, align, fill, calibrate, summarise."""
