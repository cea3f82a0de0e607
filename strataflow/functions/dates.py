"""Dates out of text in the spellings the deliveries use, and ages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date patterns of the deliveries and the average year length of the age formula.
UNPADDED = "yyyy-M-d"
PADDED = "yyyy-MM-dd"
SECONDS = "yyyy-MM-dd HH:mm:ss"
YEAR_DAYS = 365.25

_DAY_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2}$"
_TIME_PART = r"[T\s].*$"
_LONE_DIGIT = r"-(\d)(?!\d)"


def day_unpadded(text: Column) -> Column:
    """Strict reading: ``2022-9-1`` or ``2022-09-01``, nothing around it."""
    return F.try_to_date(text, UNPADDED)


def day_padded(text: Column) -> Column:
    return F.try_to_date(text, PADDED)


def day_lenient(text: Column) -> Column:
    """Also takes slashes as separators and ignores a time part and outer spaces."""
    day = F.regexp_replace(F.translate(F.trim(text), "/", "-"), _TIME_PART, "")
    return F.try_to_date(day, UNPADDED)


def day_text(text: Column, time_part: bool = False) -> Column:
    """Canonical ``yyyy-MM-dd`` text, or NULL if the shape is wrong.

    Only lone digits are padded, so a three-digit day cannot shrink into a valid one.
    """
    day = F.trim(text)
    if time_part:
        day = F.regexp_replace(day, _TIME_PART, "")
    return F.when(day.rlike(_DAY_SHAPE), F.regexp_replace(day, _LONE_DIGIT, "-0$1"))


def day_normalised(text: Column, time_part: bool = False) -> Column:
    return day_padded(day_text(text, time_part))


def timestamp_text(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(SECONDS))


def age_years(birth: Column, as_of: Column) -> Column:
    """Full years by mean year length. Off by a day around some birthdays; see ``age_exact``."""
    return F.floor(F.datediff(as_of, birth) / F.lit(YEAR_DAYS))


def age_exact(birth: Column, as_of: Column) -> Column:
    """Full years by calendar birthdays; one of 29 February falls on the 28th in other years."""
    return F.floor(F.months_between(as_of, birth) / 12)


def age_band(age: Column, width: int = 10) -> Column:
    """``27`` -> ``20-29``; NULL stays NULL."""
    low = (F.floor(age / width) * width).cast("bigint")
    return F.concat(low.cast("string"), F.lit("-"), (low + (width - 1)).cast("string"))
