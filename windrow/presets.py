"""Site constants. Everything else in the package takes them as parameters."""

from __future__ import annotations

# Exact sample period of the fast channel, in picoseconds (20.833333 Hz).
PERIOD_PS = 48_000_000_768

# Upsampling grid and nearest-match tolerance of the slow channel, in microseconds.
GRID_US = 10_000
TOLERANCE_US = 48_000

# Markers of a missing measurement.
MISSING_NUMBER = -9999.0
MISSING_TEXT = "None"

# Two-digit years from 69 on belong to the 20th century.
YEAR_PIVOT = 69

# Header name and unit in the fast files -> (column, unit after conversion).
RAW_COLUMNS = {
    ("U", "[m/s]"): ("U", "[m/s]"),
    ("V", "[m/s]"): ("V", "[m/s]"),
    ("W", "[m/s]"): ("W", "[m/s]"),
    ("Sound", "[m/50s]"): ("T_SONIC", "[degC]"),
    ("T", "[degC]"): ("T_SONIC", "[degC]"),
    ("C", "[mV]"): ("CO2", "[µmol/mol]"),
    ("C", "[µmol/mol]"): ("CO2", "[µmol/mol]"),
    ("Xw", "[mV]"): ("H2O", "[mmol/mol]"),
    ("Xw", "[mmol/mol]"): ("H2O", "[mmol/mol]"),
}

# Helper columns of the fast files that carry no measurement.
RAW_HELPERS = ("Date", "Time", "Index")

# Columns of the slow files.
AUX_COLUMNS = {
    ("Pa", "[kPa]"): ("Pa", "[kPa]"),
    ("Plic", "[kPa]"): ("Plic", "[kPa]"),
    ("Ta", "[degC]"): ("Ta", "[degC]"),
    ("Tlic", "[degC]"): ("Tlic", "[degC]"),
    ("Xa", "[mmol / mol]"): ("Xa", "[mmol / mol]"),
    ("Rhoa", "[kg / m3]"): ("Rhoa", "[kg / m3]"),
}

# Physical layout of the two kinds of file.
RAW_LAYOUT = {"skip": 3, "header_rows": 2, "escapes": True}
AUX_LAYOUT = {"skip": 1, "header_rows": 2, "escapes": True}

# Unit conversion of wind and speed of sound.
WIND_SCALE = 0.01
SOUND_SCALE = 0.02
KAPPA = 1.402
GAS_CONSTANT = 287.64
ZERO_CELSIUS = 273.15

# Amplifier eras as (after, until, CO2 multiplier, H2O multiplier); open ends are None.
ERAS = [
    (None, "1998-09-22 11:00:00", 1.0, 1.0),
    ("1998-09-22 11:00:00", "1998-12-15 15:00:00", 0.33425, 0.335),
    ("1998-12-15 15:00:00", None, 1.0, 0.335),
]

# Linear H2O correction per period as (from, to, slope, intercept), both ends included.
H2O_PERIODS = [
    ("1997-01-01 00:30:00", "1998-01-01 00:00:00", 1.087378, 24.757392),
    ("1998-01-01 00:30:00", "1999-01-01 00:00:00", 1.171352, 1.241446),
    ("1999-01-01 00:30:00", "2000-01-01 00:00:00", 1.1655515, 2.7512004),
    ("2000-01-01 00:30:00", "2001-01-01 00:00:00", 1.1617209, 3.9202374),
    ("2001-01-01 00:30:00", "2002-01-01 00:00:00", 1.1473303, 4.2208861),
    ("2002-01-01 00:30:00", "2003-01-01 00:00:00", 1.1644168, 5.9501428),
    ("2003-01-01 00:30:00", "2004-01-01 00:00:00", 1.1580541, 1.0469319),
    ("2004-01-01 00:30:00", "2005-01-01 00:00:00", 1.304316, -12.997544),
    ("2005-01-01 00:30:00", "2005-08-09 16:30:00", 1.2226907, -3.389643),
]

# Gas analyser calibration. ``poly`` holds the coefficients of x, x^2, x^3, ...
H2O_CELL = {
    "span": 1.0,
    "pressure": 101.3,
    "temperature": 32.15,
    "poly": (8.1020e-3, -8.1540e-8, 1.2110e-9),
    "scale": 1.114,
}
CO2_CELL = {
    "span": 1.027330,
    "pressure": 101.3,
    "temperature": 32.15,
    "poly": (0.14225, 5.9733e-6, 9.0892e-9, -1.2783e-12, 8.5851e-17),
    "scale": 1.114,
}
VAPOUR_WEIGHT = 1.5
