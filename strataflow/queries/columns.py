"""Section C: projections, renames and casts."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.joins import left_join_to_many
from ..plans import bronze
from .registry import query


@query(
    "c1_project_and_rename",
    "SELECT CustomerId AS client_id, PurchaseDate AS purchase_date, Product AS product_name, Price AS price FROM raw_sales",
)
def _(lay):
    return lay.raw_sales.select(
        F.col("CustomerId").alias("client_id"),
        F.col("PurchaseDate").alias("purchase_date"),
        F.col("Product").alias("product_name"),
        F.col("Price").alias("price"),
    )


@query(
    "c2_rename_columns",
    """SELECT Id AS client_id, FirstName AS first_name, LastName AS last_name, Email AS email,
              RegistrationDate AS registration_date, State AS state, delivery_date FROM raw_customers""",
)
def _(lay):
    return lay.raw_customers.withColumnsRenamed(
        {
            "Id": "client_id",
            "FirstName": "first_name",
            "LastName": "last_name",
            "Email": "email",
            "RegistrationDate": "registration_date",
            "State": "state",
        }
    )


@query("c3_drop_columns", "SELECT email, state, birth_date FROM raw_user_profiles")
def _(lay):
    return lay.raw_profiles.drop("full_name", "phone_number")


@query(
    "c4_add_and_replace_columns",
    """SELECT client_id, purchase_date, upper(product_name) AS product_name, price,
              CAST(year(purchase_date) AS INT) AS year FROM silver_sales""",
)
def _(lay):
    return lay.sales.withColumns({"year": F.year("purchase_date"), "product_name": F.upper("product_name")})


@query(
    "c5_case_collision",
    "SELECT Price AS raw_price, TRY_CAST(regexp_replace(Price, '[^0-9.]', '', 'g') AS DECIMAL(10,2)) AS price FROM raw_sales",
)
def _(lay):
    """``Price`` and ``price`` are one name to Spark, so the raw column must get another."""
    return lay.raw_sales.select(F.col("Price").alias("raw_price"), fn.money(F.col("Price")).alias("price"))


@query("c6_cast_int", "SELECT CustomerId, TRY_CAST(CustomerId AS INTEGER) AS client_id FROM raw_sales")
def _(lay):
    return lay.raw_sales.select("CustomerId", fn.whole_number(F.col("CustomerId")).alias("client_id"))


@query("c7_cast_decimal", "SELECT Price, TRY_CAST(Price AS DECIMAL(10,2)) AS amount FROM raw_sales")
def _(lay):
    return lay.raw_sales.select("Price", F.col("Price").try_cast("decimal(10,2)").alias("amount"))


@query("c8_cast_double", "SELECT Price, TRY_CAST(Price AS DOUBLE) AS amount FROM raw_sales")
def _(lay):
    return lay.raw_sales.select("Price", F.col("Price").try_cast("double").alias("amount"))


@query("c9_cast_long", "SELECT CAST(client_id AS BIGINT) AS client_id, email FROM silver_customers")
def _(lay):
    return lay.customers.select(F.col("client_id").cast("long").alias("client_id"), "email")


@query("c10_cast_date", "SELECT email, TRY_CAST(birth_date AS DATE) AS birth_date FROM raw_user_profiles")
def _(lay):
    return lay.raw_profiles.select("email", F.col("birth_date").try_cast("date").alias("birth_date"))


@query(
    "c11_text_to_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
              CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 24 AS INT) END AS hour FROM orders""",
)
def _(lay):
    hour = F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), hour, F.lit(":30:00"))
    dirty = F.when(F.col("o_orderkey") % 5 == 0, F.lit("30:00 o'clock")).otherwise(text)
    moment = fn.timestamp_text(dirty)
    return lay.read("orders").select("o_orderkey", moment.cast("date").alias("day"), F.hour(moment).alias("hour"))


@query(
    "c12_select_from_two_aliases",
    """SELECT c.client_id, coalesce(c.state, p.state) AS state, p.state AS profile_state, p.phone_number
       FROM silver_customers c LEFT JOIN silver_profiles p ON c.email = p.email""",
)
def _(lay):
    joined = lay.customers.alias("mine").join(lay.profiles.alias("theirs"), "email", "left")
    return joined.select(
        "mine.client_id",
        F.coalesce("mine.state", "theirs.state").alias("state"),
        F.col("theirs.state").alias("profile_state"),
        "theirs.phone_number",
    )


@query(
    "c13_audit_columns",
    "SELECT CustomerId, Product, DATE '2001-08-01' AS ingested_on FROM raw_sales",
)
def _(lay):
    stamped = bronze.sales_bronze(lay.raw_sales, run_ts=F.lit("2001-08-01 00:00:00").cast("timestamp"))
    return stamped.select("CustomerId", "Product", F.col("ingested_at").cast("date").alias("ingested_on"))


@query(
    "c14_star_of_one_side",
    """SELECT c.*, s.purchase_date, s.price FROM silver_customers c
       LEFT JOIN silver_sales s ON c.client_id = s.client_id""",
)
def _(lay):
    joined = left_join_to_many(lay.customers, lay.sales.select("client_id", "purchase_date", "price"), "client_id")
    return joined.alias("c").select("c.*")


@query(
    "c15_early_pruning",
    "SELECT client_id, CAST(max(price) AS DECIMAL(10,2)) AS top_price FROM silver_sales GROUP BY client_id",
)
def _(lay):
    return lay.sales.select("client_id", "price").groupBy("client_id").agg(F.max("price").alias("top_price"))
