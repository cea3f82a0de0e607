"""Section E: joins, and I: set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators.dedup import any_copy
from ..operators.joins import left_join_chain, left_join_on_nullable, left_join_to_many, lookup_join
from .registry import query


@query(
    "e1_left_join_using",
    """SELECT c.client_id, c.email, p.birth_date, p.phone_number
       FROM silver_customers c LEFT JOIN silver_profiles p USING (email)""",
)
def _(lay):
    found = lay.profiles.select("email", "birth_date", "phone_number")
    return left_join_on_nullable(lay.customers.select("client_id", "email"), found, "email")


@query(
    "e1_left_join_nullable_key",
    """SELECT c.client_id, c.state, n.n_nationkey FROM silver_customers c LEFT JOIN nation n ON c.state = n.n_name""",
)
def _(lay):
    nations = lay.read("nation").select(F.col("n_name").alias("state"), "n_nationkey")
    return left_join_on_nullable(lay.customers.select("client_id", "state"), nations, "state")


@query(
    "e2_left_join_chain",
    """SELECT s.client_id, s.purchase_date, s.price, c.email, c.state, p.birth_date
       FROM silver_sales s LEFT JOIN silver_customers c ON s.client_id = c.client_id
            LEFT JOIN silver_profiles p ON c.email = p.email""",
)
def _(lay):
    joined = left_join_chain(
        lay.sales,
        lay.customers.select("client_id", "email", "state"),
        "client_id",
        lay.profiles.select("email", "birth_date"),
        "email",
    )
    return joined.select("client_id", "purchase_date", "price", "email", "state", "birth_date")


@query(
    "e3_inner_join_fact_dimension",
    """SELECT s.client_id, s.purchase_date, s.product_name, s.price, e.state, e.age
       FROM silver_sales s JOIN gold_customers e ON s.client_id = e.client_id""",
)
def _(lay):
    people = lay.enriched.select(F.col("client_id").cast("int").alias("client_id"), "state", "age")
    return lay.sales.join(people, "client_id")


@query(
    "e4_inner_join_renamed_keys",
    """SELECT c.client_id, s.client_id AS customer_id, c.email, s.price
       FROM silver_customers c JOIN silver_sales s ON c.client_id = s.client_id""",
)
def _(lay):
    bought = lay.sales.select(F.col("client_id").alias("customer_id"), "price")
    people = lay.customers.select("client_id", "email")
    return bought.join(people, bought["customer_id"] == people["client_id"])


@query(
    "e5_left_join_same_name",
    """SELECT c.client_id, c.email, s.price FROM silver_customers c
       LEFT JOIN silver_sales s ON c.client_id = s.client_id""",
)
def _(lay):
    bought = lay.sales.select("client_id", "price")
    return left_join_to_many(lay.customers.select("client_id", "email"), bought, "client_id")


@query(
    "e5_left_join_renamed_keys",
    """SELECT c.client_id, s.client_id AS customer_id, s.price FROM silver_customers c
       LEFT JOIN silver_sales s ON c.client_id = s.client_id""",
)
def _(lay):
    bought = lay.sales.select(F.col("client_id").alias("customer_id"), "price")
    keyed = bought.withColumn("client_id", F.col("customer_id"))
    return left_join_to_many(lay.customers.select("client_id"), keyed, "client_id")


@query(
    "e6_lookup_join",
    """SELECT s.client_id, s.price, s.state, n.n_regionkey FROM state_sales s
       LEFT JOIN nation n ON s.state = n.n_name""",
)
def _(lay):
    nations = lay.read("nation").select(F.col("n_name").alias("state"), "n_regionkey")
    return lookup_join(lay.state_sales.select("client_id", "price", "state"), nations, "state", broadcast=True)


@query(
    "e6_lookup_join_too_large",
    """SELECT s.client_id, s.price, s.state, n.n_regionkey FROM state_sales s
       LEFT JOIN nation n ON s.state = n.n_name""",
)
def _(lay):
    """The same join as it is planned without the caller's word: by the size Spark measures."""
    nations = lay.read("nation").select(F.col("n_name").alias("state"), "n_regionkey")
    return lookup_join(lay.state_sales.select("client_id", "price", "state"), nations, "state", broadcast=False)


@query(
    "e7_normalised_key_join",
    """SELECT c.client_id, p.phone_number FROM silver_customers c
       JOIN silver_profiles p ON lower(trim(c.email)) = lower(trim(p.email))""",
)
def _(lay):
    """Both sides are made dirty first, so that only the normalised key can match."""
    people = lay.customers.select("client_id", F.concat(F.lit("  "), F.upper("email")).alias("email"))
    found = lay.profiles.select(F.concat("email", F.lit(" ")).alias("email"), "phone_number")
    people, found = (df.withColumn("email", fn.email_key(F.col("email"))) for df in (people, found))
    return people.join(found, "email").select("client_id", "phone_number")


@query(
    "i1_union_by_name",
    """SELECT email, state FROM silver_profiles UNION ALL SELECT email, state FROM silver_customers""",
)
def _(lay):
    return lay.profiles.select("email", "state").unionByName(lay.customers.select("state", "email"))


@query("i2_distinct", "SELECT DISTINCT product_name, CAST(year(purchase_date) AS INT) AS year FROM silver_sales")
def _(lay):
    return any_copy(lay.sales.select("product_name", F.year("purchase_date").alias("year")))
