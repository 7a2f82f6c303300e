"""Numbers and missing markers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow.presets import MISSING_NUMBER, MISSING_TEXT

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def to_number(cell: Column) -> Column:
    """Double value of a text cell, NULL where the text is not a plain decimal number.

    The pattern keeps out what a Spark cast would let through (``1d``, ``NaN``, ``Infinity``).
    """
    text = F.trim(cell)
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_number_strict(cell: Column) -> Column:
    """Like ``to_number``, but a cell with other text in it fails the job."""
    text = F.trim(cell)
    return F.when(text != "", F.coalesce(to_number(cell), F.raise_error(F.concat(F.lit("not a number: "), cell))))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def finite_or_null(value: Column) -> Column:
    """NULL for NaN and for both infinities."""
    return F.when(F.abs(value) < float("inf"), value)


def decode_text(cell: Column, markers: Iterable[str] = (MISSING_TEXT,)) -> Column:
    """NULL for a text cell that spells a missing value."""
    return F.when(~cell.isin(*markers), cell)


def decode_number(value: Column, markers: Iterable[float] = (MISSING_NUMBER,)) -> Column:
    """NULL for NaN and for the numeric markers."""
    return F.when(~F.isnan(value) & ~value.isin(*markers), value)


def encode_number(value: Column, marker: float = MISSING_NUMBER) -> Column:
    """The marker in place of NULL or NaN; for use right before a text sink."""
    return F.coalesce(nan_to_null(value), F.lit(marker))


def try_ratio(top: Column, bottom: Column) -> Column:
    """Quotient, NULL over zero whatever the ANSI setting."""
    return F.try_divide(top, bottom)


def lerp(x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Value at ``x`` on the line through two points; ``y0`` where the second point is missing."""
    return F.when(x1.isNull(), y0).otherwise(y0 + (y1 - y0) * (x - x0) / (x1 - x0))
