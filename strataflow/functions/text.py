"""Prices, keys and names out of dirty text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import MONEY

# Characters a price may keep, and the shape of a usable e-mail address.
NOT_PRICE = "[^0-9.]"
NOT_PRICE_WITH_COMMA = "[^0-9.,]"
LIKELY_EMAIL = r"^[a-zA-Z0-9_.]+@[a-zA-Z0-9.]+\.[a-zA-Z]{2,}$"


def money(text: Column, decimal_comma: bool = False, as_type: str = MONEY) -> Column:
    """``609$``, ``USD 12.50`` or ``4966`` as a number; signs and currency marks are ignored.

    With ``decimal_comma`` a comma is read as the decimal mark, so ``1,234.50`` is unreadable.
    """
    if decimal_comma:
        digits = F.translate(F.regexp_replace(text, NOT_PRICE_WITH_COMMA, ""), ",", ".")
    else:
        digits = F.regexp_replace(text, NOT_PRICE, "")
    return digits.try_cast(as_type)


def whole_number(text: Column) -> Column:
    """Integer key; fractions and words are bad keys."""
    return text.try_cast("int")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def without_token(text: Column, token: str) -> Column:
    """``text`` with every literal ``token`` removed."""
    return F.replace(text, F.lit(token), F.lit(""))


def email_key(text: Column) -> Column:
    return F.lower(F.trim(text))


def _name_part(full_name: Column, position: int) -> Column:
    return F.get(F.split(full_name, " ", 2), F.lit(position))


def first_name_of(full_name: Column) -> Column:
    return _name_part(full_name, 0)


def last_name_of(full_name: Column) -> Column:
    """All after the first space; NULL for a one-word name."""
    return _name_part(full_name, 1)
