"""Customers and sales completed with profile data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.dedup import latest
from ..operators.joins import left_join_chain, left_join_on_nullable


def _prefer(first: str, a: Column, b: Column) -> Column:
    return F.coalesce(a, b) if first == "customer" else F.coalesce(b, a)


def enrich_customers(
    customers: DataFrame,
    profiles: DataFrame,
    *,
    as_of: Column | None = None,
    run_ts: Column | None = None,
    state_first: str = "customer",
    normalise_email: bool = False,
) -> DataFrame:
    """Every customer, with gaps in name and state filled and birth data added by e-mail.

    ``profiles`` holds one row per e-mail. With ``normalise_email`` both sides are trimmed and
    lower-cased, and the profiles are made unique again after that.
    """
    today = F.current_date() if as_of is None else as_of
    found = profiles.select(
        "email",
        "birth_date",
        "phone_number",
        F.col("first_name").alias("_first"),
        F.col("last_name").alias("_last"),
        F.col("state").alias("_state"),
    )
    if normalise_email:
        customers = customers.withColumn("email", fn.email_key(F.col("email")))
        found = latest(found.withColumn("email", fn.email_key(F.col("email"))), ["email"], [])
    return left_join_on_nullable(customers, found, "email").select(
        F.col("client_id").cast("long").alias("client_id"),
        "email",
        F.coalesce("first_name", "_first").alias("first_name"),
        F.coalesce("last_name", "_last").alias("last_name"),
        "registration_date",
        _prefer(state_first, F.col("state"), F.col("_state")).alias("state"),
        "birth_date",
        fn.age_years(F.col("birth_date"), today).alias("age"),
        "phone_number",
        (F.current_timestamp() if run_ts is None else run_ts).alias("processed_at"),
    )


def sales_enriched(
    sales: DataFrame, customers: DataFrame, profiles: DataFrame, state_first: str = "profile"
) -> DataFrame:
    """Every sale with its customer and profile, if known.

    ``profiles`` still has ``full_name``. E-mails are compared trimmed and lower-cased.
    """
    people = customers.select(
        "client_id",
        F.trim("first_name").alias("first_name"),
        F.trim("last_name").alias("last_name"),
        fn.email_key(F.col("email")).alias("email"),
        F.col("registration_date").cast("date").alias("registration_date"),
        F.trim("state").alias("_customer_state"),
    )
    known = profiles.where(F.col("email").isNotNull()).select(
        fn.email_key(F.col("email")).alias("email"),
        F.trim("full_name").alias("full_name"),
        F.trim("state").alias("_profile_state"),
        F.col("birth_date").cast("date").alias("birth_date"),
        F.trim("phone_number").alias("phone_number"),
    )
    usable = F.col("client_id").isNotNull() & F.col("purchase_date").isNotNull()
    facts = sales.where(usable).withColumn("product_name", F.trim("product_name"))
    joined = left_join_chain(facts, people, "client_id", latest(known, ["email"], []), "email")
    return joined.select(
        "purchase_date",
        "client_id",
        "first_name",
        "last_name",
        "email",
        _prefer(state_first, F.col("_customer_state"), F.col("_profile_state")).alias("state"),
        "registration_date",
        "full_name",
        "birth_date",
        "phone_number",
        "product_name",
        "price",
    )
