"""Unit conversion and calibration formulas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from windrow import presets
from windrow.functions.numeric import try_ratio


def wind(value: Column, scale: float = presets.WIND_SCALE) -> Column:
    return value * F.lit(scale)


def sonic_temperature(
    value: Column,
    scale: float = presets.SOUND_SCALE,
    kappa: float = presets.KAPPA,
    gas_constant: float = presets.GAS_CONSTANT,
) -> Column:
    """Temperature in degC from a scaled speed of sound."""
    speed = value * F.lit(scale)
    return speed * speed / F.lit(kappa) / F.lit(gas_constant) - F.lit(presets.ZERO_CELSIUS)


def power_sum(x: Column, coefficients: Sequence[float]) -> Column:
    """a1*x + a2*x^2 + ..., from the inside out: (... + a2) * x + a1) * x."""
    return reduce(lambda inner, a: (inner + F.lit(a)) * x, reversed(coefficients[:-1]), F.lit(coefficients[-1]) * x)


def kelvin_ratio(temperature: Column, cell: dict) -> Column:
    return (temperature + F.lit(presets.ZERO_CELSIUS)) / F.lit(cell["temperature"] + presets.ZERO_CELSIUS)


def to_standard_pressure(signal: Column, pressure: Column, cell: dict) -> Column:
    """Signal with span correction, scaled to standard pressure; NULL at zero pressure."""
    return signal * F.lit(cell["span"]) * try_ratio(F.lit(cell["pressure"]), pressure)


def vapour_factor(h2o: Column, weight: float = presets.VAPOUR_WEIGHT) -> Column:
    """Widening of the CO2 band by water vapour given in mmol/mol."""
    return F.lit(1.0) + F.lit(weight - 1.0) * h2o / F.lit(1000.0)
