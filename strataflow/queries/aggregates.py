"""Section F: aggregation and deduplication, and H: questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import any_copy, latest
from ..operators.quality import key_quality, observed, sales_quality
from ..plans import silver, summary
from ..plans.analytics import (
    by_state_and_age,
    client_totals,
    in_date_range,
    rolled_up,
    sales_by_state_and_age,
    top_state,
)
from ..plans.sketches import day_sketches, distinct_in
from ..session import staged
from ..sinks import overwrite_partitioned
from .registry import query, scratch

REVENUE = "CAST(sum(price) AS DECIMAL(20,2)) AS total_revenue"


def built_summary(lay):
    path = scratch(lay, "client-days")
    summary.build_summary(lay.sales, path)
    return summary.stored_summary(lay.spark, path)


def with_state(totals, lay):
    return totals.join(lay.customers.select("client_id", "state"), "client_id")


@query("f1_count_per_group", "SELECT state, count(*) AS purchases FROM state_sales GROUP BY state")
def _(lay):
    return rolled_up(with_state(client_totals(lay.sales), lay), "state").select(
        "state", F.col("total_orders").alias("purchases")
    )


@query("f2_group_count", "SELECT state, count(*) AS count FROM silver_customers GROUP BY state")
def _(lay):
    return lay.customers.groupBy("state").count()


BY_STATE_AND_PRODUCT = f"""SELECT state, product_name, count(*) AS total_orders, {REVENUE},
           round(CAST(CAST(sum(price) AS DECIMAL(38,2)) AS DOUBLE) / count(price), 4) AS avg_price,
           min(price) AS min_price, max(price) AS max_price, count(DISTINCT client_id) AS unique_customers
    FROM state_sales GROUP BY state, product_name"""


@query("f3_multi_key_aggregates", BY_STATE_AND_PRODUCT)
def _(lay):
    return rolled_up(with_state(client_totals(lay.sales, "product_name"), lay), "state", "product_name")


@query(
    "f4_count_distinct",
    """SELECT product_name, count(DISTINCT client_id) AS unique_customers, count(DISTINCT purchase_date) AS days
       FROM silver_sales GROUP BY product_name""",
)
def _(lay):
    return lay.sales.groupBy("product_name").agg(
        F.count_distinct("client_id").alias("unique_customers"),
        F.count_distinct("purchase_date").alias("days"),
    )


@query(
    "f4_distinct_from_sketches",
    """SELECT product_name, CAST(year(purchase_date) AS INT) AS year, count(DISTINCT client_id) AS exact, true AS close
       FROM silver_sales GROUP BY ALL""",
)
def _(lay):
    """Buyers of a year by uniting the sketches of its days, held against the exact count."""
    year = F.year("purchase_date").alias("year")
    sketches = staged(day_sketches(lay.sales, "product_name"), "sketches")
    found = distinct_in(sketches, "product_name", year)
    exact = lay.sales.groupBy("product_name", year).agg(F.count_distinct("client_id").alias("exact"))
    close = F.abs(F.col("distinct_estimate") - F.col("exact")) <= 0.05 * F.col("exact")
    return exact.join(found, ["product_name", "year"]).select("product_name", "year", "exact", close.alias("close"))


@query(
    "f5_sql_aggregate",
    f"""SELECT state, count(*) AS total_orders, {REVENUE},
               round(CAST(CAST(sum(price) AS DECIMAL(38,2)) AS DOUBLE) / count(price), 4) AS avg_price
        FROM state_sales WHERE price > 0 AND state IS NOT NULL GROUP BY state""",
)
def _(lay):
    lay.sales.createOrReplaceTempView("strataflow_sales")
    lay.customers.createOrReplaceTempView("strataflow_customers")
    return lay.spark.sql(
        """
        WITH per_client AS (
          SELECT client_id, count(*) AS orders, CAST(sum(price) AS DECIMAL(38,2)) AS revenue
          FROM strataflow_sales WHERE price > 0 GROUP BY client_id)
        SELECT state, sum(orders) AS total_orders, CAST(sum(revenue) AS DECIMAL(20,2)) AS total_revenue,
               round(CAST(sum(revenue) AS DOUBLE) / sum(orders), 4) AS avg_price
        FROM per_client JOIN strataflow_customers USING (client_id)
        WHERE state IS NOT NULL GROUP BY state ORDER BY total_revenue DESC
        """
    )


@query("f6_row_count", "SELECT count(*) AS rows FROM silver_sales")
def _(lay):
    return lay.sales.agg(F.count(F.lit(1)).alias("rows"))


@query(
    "f6_row_count_while_writing",
    """SELECT (SELECT count(*) FROM silver_sales) AS rows,
              (SELECT count(*) FROM silver_sales WHERE product_name = 'TV') AS televisions""",
)
def _(lay):
    df, counts = observed(lay.sales, "sales", televisions=F.col("product_name") == "TV")
    df.write.parquet(scratch(lay, "sales"))
    return lay.spark.createDataFrame([counts.get], "rows long, televisions long")


@query(
    "f7_sales_quality",
    """SELECT count(*) AS rows_in,
              count(*) FILTER (client_id IS NOT NULL AND purchase_date IS NOT NULL AND price IS NOT NULL) AS rows_out,
              count(*) FILTER (client_id IS NULL OR purchase_date IS NULL OR price IS NULL) AS rows_dropped,
              count(*) FILTER (client_id IS NULL) AS bad_client_id,
              count(*) FILTER (purchase_date IS NULL) AS bad_purchase_date,
              count(*) FILTER (price IS NULL) AS bad_price FROM typed_sales""",
)
def _(lay):
    return sales_quality(silver.sales_typed(lay.raw_sales))


@query(
    "f7_customer_quality",
    """SELECT count(*) AS rows_in, count(*) - count(k) AS rows_without_key,
              count(k) - count(DISTINCT k) AS duplicates_removed, count(DISTINCT k) AS rows_out
       FROM (SELECT TRY_CAST(Id AS INTEGER) AS k FROM raw_customers) t""",
)
def _(lay):
    return key_quality(silver.customers_typed(lay.customer_deliveries), "client_id")


@query(
    "f8_keyed_dedup",
    "SELECT Id, CASE WHEN Id <> 'n/a' THEN min(Email) END AS Email FROM raw_customers GROUP BY Id",
)
def _(lay):
    # All customers without an id share one key, of which any row may stay: its e-mail is not compared.
    one = any_copy(lay.raw_customers.select("Id", "Email"), "Id")
    return one.select("Id", F.when(F.col("Id") != "n/a", F.col("Email")).alias("Email"))


@query("f9_whole_row_dedup", "SELECT DISTINCT Id, FirstName, LastName, Email, State FROM raw_customers")
def _(lay):
    return any_copy(lay.raw_customers.select("Id", "FirstName", "LastName", "Email", "State"))


@query("f10_revenue_per_state", f"SELECT state, count(*) AS total_orders, {REVENUE} FROM state_sales GROUP BY state")
def _(lay):
    return rolled_up(with_state(client_totals(lay.sales), lay), "state").select(
        "state", "total_orders", "total_revenue"
    )


@query("f11_keep_latest_by_aggregate", "SELECT client_id, email, state FROM silver_customers")
def _(lay):
    keyed = silver.customers_typed(lay.customer_deliveries).dropna(subset=["client_id"])
    return latest(keyed, ["client_id"], ["delivery_date"]).select("client_id", "email", "state")


TOP_STATE = """
    SELECT e.state, count(*) AS tv_purchases
    FROM silver_sales s JOIN gold_customers e ON s.client_id = e.client_id
    WHERE s.product_name = 'TV' AND e.age BETWEEN 20 AND 30 AND {when}
    GROUP BY e.state ORDER BY tv_purchases DESC, e.state NULLS FIRST LIMIT {k}"""
ANY_YEAR = "month(s.purchase_date) = 9 AND day(s.purchase_date) BETWEEN 1 AND 10"


@query("h1_top_state_tv_buyers", TOP_STATE.format(when=ANY_YEAR, k=1))
def _(lay):
    return top_state(lay.sales, lay.enriched).withColumnRenamed("purchases", "tv_purchases")


@query("h1_top_five_states_tv_buyers", TOP_STATE.format(when=ANY_YEAR, k=5))
def _(lay):
    return top_state(lay.sales, lay.enriched, k=5).withColumnRenamed("purchases", "tv_purchases")


@query(
    "h1_top_state_fixed_dates",
    TOP_STATE.format(when="s.purchase_date BETWEEN DATE '1998-09-01' AND DATE '1998-09-10'", k=1),
)
def _(lay):
    days = in_date_range(F.col("purchase_date"), "1998-09-01", "1998-09-10")
    return top_state(lay.sales, lay.enriched, when=days).withColumnRenamed("purchases", "tv_purchases")


@query("h1_top_state_sql", TOP_STATE.format(when=ANY_YEAR, k=1))
def _(lay):
    lay.sales.createOrReplaceTempView("strataflow_sales")
    lay.enriched.createOrReplaceTempView("strataflow_enriched")
    return lay.spark.sql(
        """
        SELECT state, count(*) AS tv_purchases
        FROM strataflow_sales JOIN strataflow_enriched USING (client_id)
        WHERE product_name = 'TV' AND age BETWEEN 20 AND 30
          AND month(purchase_date) = 9 AND day(purchase_date) BETWEEN 1 AND 10
        GROUP BY state ORDER BY tv_purchases DESC, state LIMIT 1
        """
    )


@query(
    "h2_top_k_groups",
    "SELECT state, count(*) AS cnt FROM gold_customers GROUP BY state ORDER BY cnt DESC, state NULLS FIRST LIMIT 10",
)
def _(lay):
    counts = lay.enriched.groupBy("state").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.orderBy(F.col("cnt").desc(), F.col("state").asc_nulls_first()).limit(10)


@query("h3_sorted_aggregate", f"SELECT state, {REVENUE} FROM state_sales GROUP BY state")
def _(lay):
    revenue = rolled_up(with_state(client_totals(lay.sales), lay), "state").select("state", "total_revenue")
    return revenue.orderBy(F.col("total_revenue").desc(), "state")


@query("h4_filtered_export", "SELECT * FROM gold_customers WHERE age < 25")
def _(lay):
    return lay.enriched.where("age < 25")


STATE_AND_AGE = f"""SELECT state, CASE WHEN low IS NOT NULL
           THEN concat(CAST(low AS STRING), '-', CAST(low + 9 AS STRING)) END AS age_band,
           count(*) AS total_orders, {REVENUE}
    FROM (SELECT e.state, e.age // 10 * 10 AS low, s.price
              FROM silver_sales s JOIN gold_customers e ON s.client_id = e.client_id) t
    GROUP BY state, low"""


@query("h5_sales_by_state_and_age", STATE_AND_AGE)
def _(lay):
    return sales_by_state_and_age(lay.sales, lay.enriched)


@query(
    "h5_client_day_summary",
    """SELECT client_id, product_name, purchase_date, count(*) AS orders, CAST(sum(price) AS DECIMAL(38,2)) AS revenue,
              count(price) AS priced, min(price) AS low, max(price) AS high
       FROM silver_sales GROUP BY client_id, product_name, purchase_date""",
)
def _(lay):
    """The summary after a first load, a late and repeated delivery of a month, and a day that was wrong at first."""
    sales, path = scratch(lay, "silver-sales"), scratch(lay, "client-days")
    known = staged(lay.sales, "sales")
    day, price = F.col("purchase_date"), F.col("price")
    late = in_date_range(day, "1998-02-01", "1998-02-28")
    wrong = day == F.lit("1995-03-01").cast("date")
    first = known.where(~late).withColumn("price", F.when(wrong, 1).otherwise(price).cast("decimal(10,2)"))
    overwrite_partitioned(first, sales, "purchase_date")
    summary.build_summary(lay.spark.read.parquet(sales), path)
    delivery = staged(known.where(late), "late")
    for _again in range(2):
        summary.add_sales(delivery, sales, path)
    summary.replace_sales(known.where(wrong), sales, path)
    return summary.stored_summary(lay.spark, path)


@query("h1_top_states_from_summary", TOP_STATE.format(when=ANY_YEAR, k=5))
def _(lay):
    found = top_state(built_summary(lay), lay.enriched, k=5, orders="orders")
    return found.withColumnRenamed("purchases", "tv_purchases")


@query("h5_by_state_and_age_from_summary", STATE_AND_AGE)
def _(lay):
    return by_state_and_age(summary.totals(built_summary(lay)), lay.enriched)


@query("f3_multi_key_from_summary", BY_STATE_AND_PRODUCT)
def _(lay):
    totals = summary.totals(built_summary(lay), "product_name")
    return rolled_up(with_state(totals, lay), "state", "product_name")
