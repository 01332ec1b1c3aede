"""Text, flag and key expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that mean "no state holiday"; a null means the same.
NO_HOLIDAY = ("", "0", "0.0", "none", "nan", "nat", "false")
YES_WORDS = ("true", "yes", "y")
WHITESPACE = " \t\n\r\x0b\x0c"


def normalised(c: Column) -> Column:
    """Lower-case text without outer whitespace; null becomes the empty text."""
    return F.lower(F.btrim(F.coalesce(c.cast("string"), F.lit("")), F.lit(WHITESPACE)))


def number(c: Column) -> Column:
    """Number or null: what cannot be parsed, and NaN, is null."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def finite(c: Column) -> Column:
    """The value where it is a finite number, else null."""
    value = c.cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def state_holiday_code(c: Column) -> Column:
    text = normalised(c)
    return F.when(text.isin(*NO_HOLIDAY), F.lit("none")).otherwise(text)


def state_holiday_indicator(c: Column) -> Column:
    return (~normalised(c).isin(*NO_HOLIDAY)).cast("int")


def binary_indicator(c: Column, is_number: bool = False) -> Column:
    """1 for a number other than zero or a yes word, else 0. Numbers need no text check."""
    nonzero = F.coalesce(number(c), F.lit(0.0)) != 0
    return (nonzero if is_number else nonzero | normalised(c).isin(*YES_WORDS)).cast("int")


def holiday_flag(state: Column, school: Column) -> Column:
    school_day = F.coalesce(school == 1, F.lit(False))
    return ((state_holiday_indicator(state) == 1) | school_day).cast("int")


def store_key(store: Column) -> Column:
    """``store_`` and the number, padded to four digits but never cut."""
    digits = store.cast("bigint").cast("string")
    padded = F.when(F.length(digits) >= 4, digits).otherwise(F.lpad(digits, 4, "0"))
    return F.concat(F.lit("store_"), padded)


def yes_no_label(flag: Column) -> Column:
    """0/1 to No/Yes; anything else, and null, is No."""
    whole = F.coalesce(number(flag), F.lit(0.0)).cast("int")
    return F.when(whole == 1, F.lit("Yes")).otherwise(F.lit("No"))


def yes_no_value(label: Column) -> Column:
    """No/Yes to 0/1; other values are taken as numbers."""
    text = label.cast("string")
    return F.when(text == "Yes", F.lit(1)).when(text == "No", F.lit(0)).otherwise(text.cast("int"))


def any_of(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)
