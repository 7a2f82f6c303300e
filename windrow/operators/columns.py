"""Column repair, unit conversion and calibration; all of it plain projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from windrow import presets
from windrow.functions import physics
from windrow.functions.numeric import decode_number, decode_text, encode_number, finite_or_null, nan_to_null, to_number


def decode_missing(df: DataFrame, cols: Sequence[str], text=(presets.MISSING_TEXT,), number=(presets.MISSING_NUMBER,)):
    """NULL for missing markers: text markers in string columns, numeric ones and NaN in double columns."""
    kinds = dict(df.dtypes)
    decoded = {
        c: decode_text(F.col(c), text) if kinds[c] == "string" else decode_number(F.col(c), number) for c in cols
    }
    return df.withColumns(decoded)


def encode_missing(df: DataFrame, cols: Sequence[str], marker: float = presets.MISSING_NUMBER) -> DataFrame:
    return df.withColumns({c: encode_number(F.col(c), marker) for c in cols})


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Text to double; what is no number becomes NULL."""
    return df.withColumns({c: to_number(F.col(c)) for c in cols})


def update_non_null(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Overwrite columns where the new value is a value; NULL and NaN leave the old one."""
    return df.withColumns({c: F.coalesce(nan_to_null(value), F.col(c)) for c, value in new.items()})


def sort_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def valid_rows(df: DataFrame, date: str, time: str, ts: str, start: str, hours: int = 1) -> DataFrame:
    """Rows with a time text of eight characters, a date text without letters, inside the file's time span."""
    end = F.col(start) + F.make_dt_interval(hours=F.lit(hours))
    return df.where((F.length(time) == 8) & ~F.col(date).rlike("[a-z]") & (F.col(ts) < end))


def date_labels(df: DataFrame, date: str) -> DataFrame:
    day = F.col(date)
    return df.withColumns(
        {
            "day": F.dayofmonth(day),
            "month": F.month(day),
            "year": F.year(day),
            "year_month": F.date_format(day, "yyyy-MM"),
        }
    )


def with_units(df: DataFrame, units: Mapping[str, str]) -> DataFrame:
    """Note the unit of columns in the schema."""
    return df.select(
        *[F.col(c).alias(c, metadata={"unit": units[c]}) if c in units else F.col(c) for c in df.columns]
    )


def units_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["unit"] for f in df.schema.fields if "unit" in f.metadata}


def convert_units(df: DataFrame, co2_mult: str = "co2_mult", h2o_mult: str = "h2o_mult") -> DataFrame:
    """Wind to m/s, speed of sound to degC, gas voltages through the amplifier multipliers of the era."""
    return df.withColumns(
        {
            **{c: physics.wind(F.col(c)) for c in ("U", "V", "W")},
            "T_SONIC": physics.sonic_temperature(F.col("T_SONIC")),
            "CO2": F.col("CO2") * F.col(co2_mult),
            "H2O": F.col("H2O") * F.col(h2o_mult),
        }
    )


def calibrate_gas(
    df: DataFrame,
    h2o: str = "H2O",
    co2: str = "CO2",
    pressure: str = "Plic",
    temperature: str = "Tlic",
    h2o_cell: Mapping = presets.H2O_CELL,
    co2_cell: Mapping = presets.CO2_CELL,
    on_missing: str = "keep",
) -> DataFrame:
    """Voltages of the gas analyser to mole fractions: H2O first, then CO2 corrected for that water vapour.

    Where pressure or temperature is missing, the pressure is zero, or the result is not finite, ``keep`` leaves the voltage in place and
    ``null`` clears it. ``calibrated`` tells whether both gases got a value.
    """
    p, t = F.col(pressure), F.col(temperature)
    # Each stage is a column of its own, so that the powers below do not repeat it.
    staged = df.withColumn("_w", physics.to_standard_pressure(F.col(h2o), p, h2o_cell))
    vapour = physics.power_sum(F.col("_w"), h2o_cell["poly"]) * physics.kelvin_ratio(t, h2o_cell)
    staged = staged.withColumn("_h2o", finite_or_null(vapour * F.lit(h2o_cell["scale"])))
    staged = staged.withColumn("_x", physics.vapour_factor(F.col("_h2o")))
    staged = staged.withColumn("_c", physics.to_standard_pressure(F.col(co2), p * F.col("_x"), co2_cell))
    dry = F.col("_x") * physics.power_sum(F.col("_c"), co2_cell["poly"]) * physics.kelvin_ratio(t, co2_cell)
    staged = staged.withColumn("_co2", finite_or_null(dry * F.lit(co2_cell["scale"])))
    staged = staged.withColumn("calibrated", F.col("_h2o").isNotNull() & F.col("_co2").isNotNull())
    if on_missing == "keep":
        staged = update_non_null(staged, {h2o: F.col("_h2o"), co2: F.col("_co2")})
    elif on_missing == "null":
        staged = staged.withColumns({h2o: F.col("_h2o"), co2: F.col("_co2")})
    else:
        raise ValueError(f"unknown on_missing {on_missing!r}")
    return staged.drop("_w", "_h2o", "_x", "_c", "_co2")
