"""Typed, cleaned and deduplicated tables.

Reading profiles for sales:
  strict      unpadded dates only; a row needs id, date and price
  lenient     also slashes and a time part; price as double and may be NULL
  normalised  padded by shape, time part ignored; decimal comma; price as double and may be NULL
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.dedup import any_copy, latest


def _processed(run_ts: Column | None) -> Column:
    return (F.current_timestamp() if run_ts is None else run_ts).alias("processed_at")


def _sale(profile: str) -> dict[str, Column]:
    """The silver columns of a sale, read from its bronze text."""
    day, product, price = F.col("PurchaseDate"), F.col("Product"), F.col("Price")
    if profile == "strict":
        day, price = fn.day_unpadded(day), fn.money(price)
    elif profile == "lenient":
        day, price = fn.day_lenient(day), fn.money(price, as_type="double")
    elif profile == "normalised":
        day = fn.day_normalised(day, time_part=True)
        product, price = F.trim(product), fn.money(price, decimal_comma=True, as_type="double")
    else:
        raise ValueError(f"unknown profile {profile!r}")
    return {
        "client_id": fn.whole_number(F.col("CustomerId")),
        "purchase_date": day,
        "product_name": product,
        "price": price,
    }


def _needed(profile: str) -> list[str]:
    return ["client_id", "purchase_date", *(["price"] if profile == "strict" else [])]


def sales_typed(bronze: DataFrame, profile: str = "strict") -> DataFrame:
    """All bronze sales with unreadable values as NULL; nothing is dropped yet."""
    return bronze.select(*(column.alias(name) for name, column in _sale(profile).items()))


def usable_sales(typed: DataFrame, profile: str = "strict") -> DataFrame:
    for name in _needed(profile):
        typed = typed.where(F.col(name).isNotNull())
    return typed


def sales_silver(bronze: DataFrame, profile: str = "strict", run_ts: Column | None = None) -> DataFrame:
    """Typed sales that have all their profile needs."""
    sale, needed = _sale(profile), _needed(profile)
    # A filter on parsed columns is pushed below a projection and parses everything again. It stays
    # above a generator, so these columns come out of one; the rest can still be pruned and pushed.
    judged = F.inline(F.array(F.struct(*(sale[name].alias(name) for name in needed))))
    rest = [column.alias(name) for name, column in sale.items() if name not in needed]
    return usable_sales(bronze.select(judged, *rest), profile).select(*sale, _processed(run_ts))


def customers_typed(bronze: DataFrame) -> DataFrame:
    """Typed before deduplication, so that ``1`` and `` 1`` are one client."""
    return bronze.select(
        fn.whole_number(F.col("Id")).alias("client_id"),
        *(
            F.trim(name).alias(new)
            for name, new in (("FirstName", "first_name"), ("LastName", "last_name"), ("Email", "email"))
        ),
        fn.day_normalised(F.col("RegistrationDate")).alias("registration_date"),
        F.trim("State").alias("state"),
        "delivery_date",
    )


def customers_silver(bronze: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """The newest delivery of each client. Names and state may be NULL; gold fills them."""
    keyed = customers_typed(bronze).dropna(subset=["client_id"])
    newest = latest(keyed, ["client_id"], ["delivery_date"])
    return newest.drop("delivery_date").select("*", _processed(run_ts))


def customers_distinct(bronze: DataFrame) -> DataFrame:
    """Variant: renamed text columns, whole-row copies removed, nothing parsed."""
    return any_copy(
        bronze.select(
            F.col("Id").alias("client_id"),
            F.col("FirstName").alias("first_name"),
            F.col("LastName").alias("last_name"),
            F.col("Email").alias("email"),
            F.col("RegistrationDate").alias("registration_date"),
            F.col("State").alias("state"),
        )
    )


def profiles_silver(raw: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """One profile per e-mail. Profiles without one can never be joined and are left out."""
    name = F.col("full_name")
    profiles = raw.where(F.col("email").isNotNull()).select(
        "email",
        "state",
        fn.day_padded(F.col("birth_date")).alias("birth_date"),
        "phone_number",
        fn.first_name_of(name).alias("first_name"),
        fn.last_name_of(name).alias("last_name"),
    )
    return latest(profiles, ["email"], []).select("*", _processed(run_ts))


def profiles_distinct(raw: DataFrame) -> DataFrame:
    """Variant: ``full_name`` kept whole, whole-row copies removed."""
    return any_copy(
        raw.select(
            "email", "full_name", "state", fn.day_padded(F.col("birth_date")).alias("birth_date"), "phone_number"
        )
    )
