"""Times taken from file names, text cells and row positions."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampType

from windrow.presets import PERIOD_PS, YEAR_PIVOT

FILE_STAMP = r"(\d{2})(\d{2})(\d{2})_(\d{2})\.[A-Za-z]+$"
DATE_TEXT = r"^(\d{1,2})\.(\d{1,2})\.(\d{4}|\d{2})$"
TIME_TEXT = r"^([01]?\d|2[0-3]):([0-5]?\d):([0-5]?\d)$"
DAY_US = 86_400_000_000


def _part(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def full_year(year: Column, pivot: int = YEAR_PIVOT) -> Column:
    """Four-digit year; two-digit years from ``pivot`` on are in the 1900s, the others in the 2000s."""
    return year + F.when(year >= 100, 0).when(year >= pivot, 1900).otherwise(2000)


def file_time(name: Column, pivot: int = YEAR_PIVOT) -> Column:
    """Start of a file named ``<prefix>yymmdd_HH.<ext>``, NULL for other names."""
    year, month, day, hour = (_part(name, FILE_STAMP, g) for g in (1, 2, 3, 4))
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(full_year(year, pivot), month, day, hour, zero, zero)


def file_date(name: Column, pivot: int = 95) -> Column:
    """Day of a file from its name; the older naming rule puts the century change at 95."""
    return file_time(name, pivot).cast("date")


def strip_blanks(text: Column) -> Column:
    return F.replace(text, F.lit(" "), F.lit(""))


def date_from_text(text: Column, pivot: int = YEAR_PIVOT) -> Column:
    """Date of ``dd.mm.yy`` or ``dd.mm.yyyy`` text with any blanks in it, NULL where it is none."""
    bare = strip_blanks(text)
    day, month, year = (_part(bare, DATE_TEXT, g) for g in (1, 2, 3))
    zero = F.lit(0)
    return F.try_make_timestamp_ntz(full_year(year, pivot), month, day, zero, zero, zero).cast("date")


def timestamp_from_text(date: Column, time: Column, pivot: int = YEAR_PIVOT) -> Column:
    """Timestamp of a date text and an ``HH:MM:SS`` text, NULL where either is unreadable."""
    bare = strip_blanks(time)
    hour, minute, second = (_part(bare, TIME_TEXT, g) for g in (1, 2, 3))
    return date_from_text(date, pivot).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour, minute, second)


#: Session zones in which times with and without zone are written alike.
PLAIN_ZONES = {"UTC", "Etc/UTC", "GMT", "Z", "+00:00", "UTC+0"}


def _plain_zone() -> bool:
    """Whether the session's zone, which is fixed when a plan is made, is UTC: then casts between times change nothing."""
    session = SparkSession.getActiveSession()
    return session is not None and session.conf.get("spark.sql.session.timeZone") in PLAIN_ZONES


def micros(ts: Column) -> Column:
    """Microseconds since 1970, whatever the session zone.

    Times without zone and dates are counted as written; instants (``timestamp``) from the epoch. Which of the two
    holds is known from the type when the plan is made.
    """
    if _plain_zone():
        return F.unix_micros(ts.cast("timestamp"))
    # TIMESTAMPs must not meet a zone on their way, so the fields of the clock are added up.
    local = ts.cast("timestamp_ntz")
    day = F.unix_date(local.cast("date")).cast("bigint") * F.lit(DAY_US)
    minutes = F.hour(local).cast("bigint") * 60 + F.minute(local)
    seconds = (F.date_part(F.lit("SECOND"), local) * F.lit(1_000_000)).cast("bigint")
    return F.when(F.typeof(ts) == "timestamp", F.unix_micros(ts.cast("timestamp"))).otherwise(day + minutes * 60_000_000 + seconds)


def from_micros(us: Column) -> Column:
    """The time without zone that lies so many microseconds after 1970."""
    if _plain_zone():
        return F.timestamp_micros(us).cast("timestamp_ntz")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL '0.000001' SECOND") * us


def back_to(us: Column, kind: DataType) -> Column:
    """The value of a time or date type that ``micros`` counts as ``us``."""
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(us)
    return from_micros(us).cast(kind)


def truncated(ts: Column, width_us: int) -> Column:
    """Beginning of the span of ``width_us`` (counted from 1970) that holds a time without zone."""
    us = micros(ts)
    return from_micros(us - F.pmod(us, F.lit(width_us)))


def axis_micros(start_us: Column, row: Column, period_ps: int = PERIOD_PS) -> Column:
    """Time of row ``row`` counted from ``start_us``, in whole microseconds, without rounding drift.

    Whole and broken microseconds of the period are multiplied apart, so that long series do not overflow.
    """
    whole, broken = divmod(period_ps, 1_000_000)
    carried = F.call_function("div", row.cast("bigint") * F.lit(broken), F.lit(1_000_000))
    return start_us + row.cast("bigint") * F.lit(whole) + carried


def snap(us: Column, grid_us: int) -> Column:
    """Nearest grid point, the later one on a tie."""
    return us + F.lit(grid_us // 2) - F.pmod(us + F.lit(grid_us // 2), F.lit(grid_us))


def label(ts: Column) -> Column:
    """``yyyyMMddHHmm`` of a time without zone."""
    parts = [(F.year, 4), (F.month, 2), (F.dayofmonth, 2), (F.hour, 2), (F.minute, 2)]
    return F.concat(*[F.lpad(part(ts).cast("string"), width, "0") for part, width in parts])


def day_of_year_date(year: Column, offset: Column) -> Column:
    """January 1 of the whole part of ``year`` plus ``offset`` days."""
    return F.date_add(F.make_date(F.floor(year).cast("int"), F.lit(1), F.lit(1)), offset.cast("int"))
