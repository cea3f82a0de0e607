"""Section M: the layers as a user calls them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import first_ranked
from ..plans import gold, silver
from ..plans.analytics import in_days_of_month, top_state
from ..sinks import overwrite_partitioned
from ..sources import parquet
from ..sources.testtables import AS_OF
from .registry import query, scratch


@query("m2_sales_silver", "SELECT * FROM silver_sales")
def _(lay):
    return lay.sales


@query(
    "m2b_sales_silver_lenient",
    """SELECT client_id, purchase_date, product_name, CAST(price AS DOUBLE) AS price
       FROM typed_sales WHERE client_id IS NOT NULL AND purchase_date IS NOT NULL""",
)
def _(lay):
    slashed = lay.raw_sales.withColumn("PurchaseDate", F.translate("PurchaseDate", "-", "/"))
    return silver.sales_silver(slashed, "lenient").drop("processed_at")


@query(
    "m2c_sales_silver_normalised",
    """SELECT client_id, purchase_date, product_name, CAST(price AS DOUBLE) AS price
       FROM typed_sales WHERE client_id IS NOT NULL AND purchase_date IS NOT NULL""",
)
def _(lay):
    timed = lay.raw_sales.withColumns(
        {"PurchaseDate": F.concat("PurchaseDate", F.lit(" 08:15:00")), "Price": F.translate("Price", ".", ",")}
    )
    return silver.sales_silver(timed, "normalised").drop("processed_at")


@query("m4_customers_silver", "SELECT * FROM silver_customers")
def _(lay):
    return lay.customers


@query(
    "m4b_customers_distinct",
    """SELECT DISTINCT Id AS client_id, FirstName AS first_name, LastName AS last_name, Email AS email,
              RegistrationDate AS registration_date, State AS state FROM raw_customers""",
)
def _(lay):
    return silver.customers_distinct(lay.raw_customers)


@query("m4c_customers_keep_latest", "SELECT * FROM silver_customers")
def _(lay):
    keyed = silver.customers_typed(lay.customer_deliveries).where(F.col("client_id").isNotNull())
    others = [F.col(name) for name in keyed.columns if name not in ("client_id", "delivery_date")]
    order = [F.col("delivery_date").desc_nulls_last(), *others]
    return first_ranked(keyed, ["client_id"], order).drop("delivery_date")


@query("m5_profiles_silver", "SELECT * FROM silver_profiles")
def _(lay):
    return lay.profiles


@query(
    "m5b_profiles_distinct",
    """SELECT DISTINCT email, full_name, state, CAST(birth_date AS DATE) AS birth_date, phone_number
       FROM raw_user_profiles""",
)
def _(lay):
    return silver.profiles_distinct(lay.raw_profiles)


@query("m6_enrich_customers", "SELECT * FROM gold_customers")
def _(lay):
    return lay.enriched


@query(
    "m6_enrich_profile_first",
    """SELECT c.client_id, coalesce(p.state, c.state) AS state FROM gold_customers c
       LEFT JOIN silver_profiles p ON c.email = p.email""",
)
def _(lay):
    """Profile state first, with e-mails that only match when normalised."""
    shouted = lay.customers.withColumn("email", F.upper("email"))
    rows = gold.enrich_customers(
        shouted,
        lay.profiles,
        as_of=F.lit(AS_OF).cast("date"),
        state_first="profile",
        normalise_email=True,
    )
    return rows.select("client_id", "state")


@query("m7_sales_enriched", "SELECT * FROM gold_sales")
def _(lay):
    return gold.sales_enriched(lay.sales, lay.customers, silver.profiles_distinct(lay.raw_profiles))


@query(
    "m7_sales_enriched_by_day",
    """SELECT purchase_date, count(*) AS sales, count(full_name) AS with_profile,
              CAST(sum(price) AS DECIMAL(20,2)) AS revenue FROM gold_sales GROUP BY purchase_date""",
)
def _(lay):
    path = scratch(lay, "gold-sales")
    rows = gold.sales_enriched(lay.sales, lay.customers, silver.profiles_distinct(lay.raw_profiles))
    overwrite_partitioned(rows, path, "purchase_date")
    return (
        parquet(lay.spark, path)
        .groupBy("purchase_date")
        .agg(
            F.count(F.lit(1)).alias("sales"),
            F.count("full_name").alias("with_profile"),
            F.sum("price").alias("revenue"),
        )
    )


@query(
    "m8_top_state",
    """SELECT e.state, count(*) AS purchases FROM silver_sales s
       JOIN gold_customers e ON s.client_id = e.client_id
       WHERE s.product_name = 'Phone' AND e.age BETWEEN 25 AND 34 AND e.state IS NOT NULL
         AND month(s.purchase_date) = 3 AND day(s.purchase_date) BETWEEN 11 AND 20
       GROUP BY e.state ORDER BY purchases DESC, e.state LIMIT 3""",
)
def _(lay):
    return top_state(
        lay.sales,
        lay.enriched,
        product="Phone",
        ages=(25, 34),
        when=in_days_of_month(F.col("purchase_date"), 3, 11, 20),
        exclude_null_state=True,
        k=3,
    )
