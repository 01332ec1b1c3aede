"""Calendar expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfspark.functions.text import any_of

# Other ways of writing a date that are accepted besides ISO.
EXTRA_FORMATS = ("yyyy/M/d", "M/d/yyyy", "yyyyMMdd", "MMM d, yyyy")


def parsed_timestamp(c: Column, is_text: bool = True) -> Column:
    """Timestamp or null. Text may use ISO or one of ``EXTRA_FORMATS``."""
    if not is_text:
        return c.cast("timestamp_ntz")
    attempts = [c.try_cast("timestamp_ntz")]
    attempts += [F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in EXTRA_FORMATS]
    return F.coalesce(*attempts)


def parsed_date(c: Column, is_text: bool = True) -> Column:
    return F.to_date(parsed_timestamp(c, is_text))


def calendar_parts(day: Column) -> dict[str, Column]:
    """Every calendar part by name; Monday is day 0, weeks are ISO weeks."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "dayofweek": F.weekday(day),
        "quarter": F.quarter(day),
        "weekofyear": F.weekofyear(day),
        "is_weekend": (F.weekday(day) >= 5).cast("int"),
    }


def cyclical_parts(day: Column) -> dict[str, Column]:
    """Sine and cosine of month, day of month and day of week."""
    sources = {
        "month": (F.month(day), 12),
        "day": (F.dayofmonth(day), 31),
        "dayofweek": (F.weekday(day), 7),
    }
    parts: dict[str, Column] = {}
    for name, (value, period) in sources.items():
        angle = F.lit(2 * math.pi) * value / F.lit(period)
        parts[f"{name}_sin"] = F.sin(angle)
        parts[f"{name}_cos"] = F.cos(angle)
    return parts


def _div(a: Column, b: int) -> Column:
    return F.floor(a / F.lit(b))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter from the year alone (the anonymous computus)."""
    golden = year % 19
    century = _div(year, 100)
    skipped = century - _div(century, 4) - _div(century * 8 + 13, 25)
    epact = (skipped + golden * 19 + 15) % 30
    moon = epact - _div(epact, 28) * (1 - _div(29 / (epact + 1), 1) * _div(21 - golden, 11))
    weekday = (year + _div(year, 4) + moon + 2 - century + _div(century, 4)) % 7
    offset = moon - weekday
    month = 3 + _div(offset + 40, 44)
    day = offset + 28 - 31 * _div(month, 4)
    return F.make_date(year.cast("int"), month.cast("int"), day.cast("int"))


def german_public_holiday(day: Column) -> Column:
    """True on the public holidays that all of Germany keeps."""
    year, month, dom = F.year(day), F.month(day), F.dayofmonth(day)
    after_easter = F.datediff(day, easter_sunday(year))
    fixed = [
        (month == 1) & (dom == 1),
        (month == 5) & (dom == 1),
        (month == 10) & (dom == 3) & (year >= 1990),
        (month == 12) & dom.isin(25, 26),
        (month == 10) & (dom == 31) & (year == 2017),
        # Day of repentance: the Wednesday before 23 November, nationwide until 1994.
        (month == 11) & dom.between(16, 22) & (F.weekday(day) == 2) & year.between(1990, 1994),
    ]
    moving = after_easter.isin(-2, 1, 39, 50)
    return any_of([*fixed, moving])
