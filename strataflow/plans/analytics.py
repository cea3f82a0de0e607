"""Questions asked of silver sales and gold customers.

Sales are summed per client before they meet the customer table, so a client with very many
sales reaches the join as one row and the join moves clients, not sales.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import age_band

PER_CLIENT_MONEY = "decimal(38,2)"


def in_days_of_month(day: Column, month: int, first: int, last: int) -> Column:
    """Calendar days of any year; prunes folders of a table partitioned by ``day``."""
    return (F.month(day) == month) & F.dayofmonth(day).between(first, last)


def in_date_range(day: Column, first: date | str, last: date | str) -> Column:
    return day.between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"))


def keyed_like(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with ``client_id`` in the type of the customer table.

    Cast before grouping, so that the partitions of the sums also serve the join.
    """
    return sales.withColumn("client_id", F.col("client_id").cast(customers.schema["client_id"].dataType))


def purchases_by_state(
    sales: DataFrame, customers: DataFrame, when: Column, product: str, ages: tuple[int, int], orders: str | None = None
) -> DataFrame:
    """Purchases of one product per state, by buyers of an inclusive age range.

    ``sales`` may be a summary by client, product and day; ``orders`` then names the number of sales in a row.
    """
    bought = keyed_like(sales, customers).where((F.col("product_name") == product) & when)
    per_client = bought.groupBy("client_id").agg((F.sum(orders) if orders else F.count(F.lit(1))).alias("_n"))
    buyers = customers.where(F.col("age").between(*ages)).select("client_id", "state")
    return per_client.join(buyers, "client_id").groupBy("state").agg(F.sum("_n").alias("purchases"))


def top_state(
    sales: DataFrame,
    customers: DataFrame,
    *,
    product: str = "TV",
    ages: tuple[int, int] = (20, 30),
    when: Column | None = None,
    exclude_null_state: bool = False,
    k: int = 1,
    orders: str | None = None,
) -> DataFrame:
    """The ``k`` states with most purchases; ties go to the state that sorts first.

    ``when`` limits the purchase day; by default the first ten days of any September. ``orders`` as above.
    """
    if when is None:
        when = in_days_of_month(F.col("purchase_date"), 9, 1, 10)
    counts = purchases_by_state(sales, customers, when, product, ages, orders)
    if exclude_null_state:
        counts = counts.where(F.col("state").isNotNull())
    return counts.orderBy(F.col("purchases").desc(), F.col("state").asc_nulls_first()).limit(k)


def client_totals(sales: DataFrame, *also_by: str) -> DataFrame:
    """Orders, revenue and price range per client (and further columns)."""
    return sales.groupBy("client_id", *also_by).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("price").cast(PER_CLIENT_MONEY).alias("revenue"),
        F.count("price").alias("priced"),
        F.min("price").alias("low"),
        F.max("price").alias("high"),
    )


def rolled_up(totals: DataFrame, *by: str) -> DataFrame:
    """Per-client totals brought together by columns of the joined customer table."""
    revenue, priced = F.sum("revenue"), F.sum("priced")
    return totals.groupBy(*by).agg(
        F.sum("orders").alias("total_orders"),
        revenue.cast("decimal(20,2)").alias("total_revenue"),
        F.round(revenue.cast("double") / priced, 4).alias("avg_price"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        F.count_distinct("client_id").alias("unique_customers"),
    )


def by_state_and_age(totals: DataFrame, customers: DataFrame, width: int = 10) -> DataFrame:
    """Per-client totals by state and age band of the buyer."""
    buyers = customers.select("client_id", "state", age_band(F.col("age"), width).alias("age_band"))
    joined = keyed_like(totals, customers).join(buyers, "client_id")
    return rolled_up(joined, "state", "age_band").select("state", "age_band", "total_orders", "total_revenue")


def sales_by_state_and_age(sales: DataFrame, customers: DataFrame, width: int = 10) -> DataFrame:
    """Orders and revenue by state and age band of the buyer."""
    return by_state_and_age(client_totals(keyed_like(sales, customers)), customers, width)
