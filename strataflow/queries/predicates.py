"""Section D: filters and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..plans.analytics import in_date_range, in_days_of_month
from ..plans.silver import sales_typed
from .registry import query

GAPS = "SELECT FirstName, LastName, State FROM raw_customers"


def gaps(lay):
    return lay.raw_customers.select("FirstName", "LastName", "State")


@query("d1_drop_all_null", f"{GAPS} WHERE NOT (FirstName IS NULL AND LastName IS NULL AND State IS NULL)")
def _(lay):
    return gaps(lay).dropna("all")


@query("d2_drop_null_keys", "SELECT * FROM typed_sales WHERE client_id IS NOT NULL AND price IS NOT NULL")
def _(lay):
    return sales_typed(lay.raw_sales).dropna(subset=["client_id", "price"])


@query("d3_drop_any_null", f"{GAPS} WHERE FirstName IS NOT NULL AND LastName IS NOT NULL AND State IS NOT NULL")
def _(lay):
    return gaps(lay).dropna("any")


@query("d4_not_null_not_blank", "SELECT * FROM raw_sales WHERE Price IS NOT NULL AND Price <> ''")
def _(lay):
    return lay.raw_sales.where(fn.blank_to_null(F.col("Price")).isNotNull())


@query("d5_both_not_null", f"{GAPS} WHERE FirstName IS NOT NULL AND State IS NOT NULL")
def _(lay):
    return gaps(lay).where(F.col("FirstName").isNotNull() & F.col("State").isNotNull())


@query(
    "d6_fill_constants",
    """SELECT client_id, coalesce(state, 'Unknown') AS state, coalesce(age, 0) AS age FROM gold_customers""",
)
def _(lay):
    return lay.enriched.select("client_id", "state", "age").fillna({"state": "Unknown", "age": 0})


@query(
    "d7_coalesce",
    "SELECT Id, coalesce(FirstName, LastName, 'Anonymous') AS display_name FROM raw_customers",
)
def _(lay):
    return lay.raw_customers.select(
        "Id", F.coalesce("FirstName", "LastName", F.lit("Anonymous")).alias("display_name")
    )


@query(
    "d8_conditional_replacement",
    "SELECT Id, CASE WHEN State IS NULL THEN 'Unknown' ELSE State END AS State FROM raw_customers",
)
def _(lay):
    state = F.col("State")
    return lay.raw_customers.select("Id", F.when(state.isNull(), "Unknown").otherwise(state).alias("State"))


@query(
    "d9_comparisons",
    "SELECT * FROM state_sales WHERE price > 50000 AND product_name = 'TV' AND state <> 'NATION_1'",
)
def _(lay):
    wanted = (F.col("price") > 50000) & (F.col("product_name") == "TV") & (F.col("state") != "NATION_1")
    return lay.state_sales.where(wanted)


@query("d9_is_null", "SELECT * FROM state_sales WHERE state IS NULL")
def _(lay):
    return lay.state_sales.where(F.col("state").isNull())


@query(
    "d10_and_or",
    """SELECT * FROM state_sales WHERE (price > 90000 AND state = 'NATION_3')
       OR state = 'NATION_4' OR state = 'MOVED'""",
)
def _(lay):
    state = F.col("state")
    dear = (F.col("price") > 90000) & (state == "NATION_3")
    return lay.state_sales.where(dear | (state == "NATION_4") | (state == "MOVED"))


@query("d11_in_list", "SELECT * FROM state_sales WHERE state IN ('NATION_1', 'NATION_2', 'MOVED')")
def _(lay):
    return lay.state_sales.where(F.col("state").isin("NATION_1", "NATION_2", "MOVED"))


@query("d11_not_in_list", "SELECT * FROM state_sales WHERE state NOT IN ('NATION_1', 'MOVED')")
def _(lay):
    return lay.state_sales.where(~F.col("state").isin("NATION_1", "MOVED"))


@query(
    "d12_substring_prefix_suffix",
    """SELECT * FROM raw_customers WHERE Email LIKE '%1@example%' AND FirstName LIKE 'First1%'
       AND LastName LIKE '%1'""",
)
def _(lay):
    return lay.raw_customers.where(
        F.col("Email").contains("1@example")
        & F.col("FirstName").startswith("First1")
        & F.col("LastName").endswith("1")
    )


@query(
    "d13_regex_match",
    """SELECT email, regexp_matches(email, '^[a-zA-Z0-9_.]+@[a-zA-Z0-9.]+\\.[a-zA-Z]{2,}$') AS valid,
              regexp_matches(phone_number, '^[a-zA-Z0-9_.]+@[a-zA-Z0-9.]+\\.[a-zA-Z]{2,}$') AS phone_valid
       FROM raw_user_profiles""",
)
def _(lay):
    return lay.raw_profiles.select(
        "email",
        F.col("email").rlike(fn.LIKELY_EMAIL).alias("valid"),
        F.col("phone_number").rlike(fn.LIKELY_EMAIL).alias("phone_valid"),
    )


@query("d14_between", "SELECT * FROM gold_customers WHERE age BETWEEN 20 AND 30")
def _(lay):
    return lay.enriched.where(F.col("age").between(20, 30))


@query(
    "d15_calendar_predicate",
    "SELECT * FROM silver_sales WHERE month(purchase_date) = 9 AND day(purchase_date) BETWEEN 1 AND 10",
)
def _(lay):
    return lay.sales.where(in_days_of_month(F.col("purchase_date"), 9, 1, 10))


@query(
    "d16_date_range",
    "SELECT * FROM silver_sales WHERE purchase_date BETWEEN DATE '1998-09-01' AND DATE '1998-09-10'",
)
def _(lay):
    return lay.sales.where(in_date_range(F.col("purchase_date"), "1998-09-01", "1998-09-10"))


@query(
    "d17_failed_cast_filter",
    """SELECT CustomerId, PurchaseDate FROM raw_sales
       WHERE TRY_CAST(CustomerId AS INTEGER) IS NULL OR try_strptime(PurchaseDate, '%Y-%m-%d') IS NULL""",
)
def _(lay):
    rows = lay.raw_sales.select("CustomerId", "PurchaseDate")
    unread_id = fn.whole_number(F.col("CustomerId")).isNull()
    return rows.where(unread_id | fn.day_unpadded(F.col("PurchaseDate")).isNull())
