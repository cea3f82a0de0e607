"""Section G: window functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.dedup import first_ranked, upsert
from ..operators.ordered import neighbours, rank_by_day, running_by_row, running_total
from ..plans import silver
from .registry import query
from .tables import UPSERTED, upsert_sides

SALE_ORDER = ["purchase_date", "client_id", "product_name", "price"]


@query("g1_keep_latest", "SELECT * FROM silver_customers")
def _(lay):
    keyed = silver.customers_typed(lay.customer_deliveries).dropna(subset=["client_id"])
    ties = [F.col(name).asc() for name in keyed.columns if name not in ("client_id", "delivery_date")]
    newest = first_ranked(keyed, ["client_id"], [F.col("delivery_date").desc_nulls_last(), *ties])
    return newest.drop("delivery_date")


@query(
    "g2_keep_earliest",
    """SELECT client_id, purchase_date, product_name, price FROM (
         SELECT *, row_number() OVER (PARTITION BY client_id
           ORDER BY purchase_date, product_name, price) AS place FROM silver_sales) t WHERE place = 1""",
)
def _(lay):
    order = [F.col(name).asc() for name in ("purchase_date", "product_name", "price")]
    return first_ranked(lay.sales, ["client_id"], order)


@query(
    "g3_keep_highest_version",
    """SELECT Id, State, version FROM (
         SELECT Id, State, CAST(right(delivery_date, 1) AS INT) AS version,
                row_number() OVER (PARTITION BY Id ORDER BY delivery_date DESC, State NULLS LAST) AS place
         FROM raw_customers) t WHERE place = 1""",
)
def _(lay):
    version = F.get(F.split("delivery_date", "-"), F.lit(2)).cast("int").alias("version")
    versions = lay.raw_customers.select("Id", "State", version)
    # Customers without an id share one key and tie in the version.
    return first_ranked(versions, ["Id"], [F.col("version").desc(), F.col("State").asc_nulls_last()])


@query(
    "g4_running_total",
    """SELECT *, CAST(sum(price) OVER (PARTITION BY state ORDER BY purchase_date) AS DECIMAL(20,2)) AS running_total
       FROM state_sales""",
)
def _(lay):
    return running_total(lay.state_sales, "state", "purchase_date", "price")


@query(
    "g5_rank_in_group",
    """SELECT *, rank() OVER (PARTITION BY state ORDER BY purchase_date) AS rank_in_state FROM state_sales""",
)
def _(lay):
    return rank_by_day(lay.state_sales, "state", "purchase_date", "rank_in_state")


IN_ORDER = "OVER (PARTITION BY state ORDER BY purchase_date, client_id, product_name, price)"
IN_ORDER_ROWS = IN_ORDER[:-1] + " ROWS UNBOUNDED PRECEDING)"


@query(
    "g4_running_total_by_sale",
    f"""SELECT *, CAST(sum(price) {IN_ORDER_ROWS} AS DECIMAL(20,2)) AS running_total,
               row_number() {IN_ORDER} AS place FROM state_sales""",
)
def _(lay):
    """Sale by sale: copies of a sale are told apart by nothing, so they share out the places they take."""
    return running_by_row(lay.state_sales, ["state"], SALE_ORDER, "price")


@query("g6_previous_value", f"SELECT *, lag(price, 1) {IN_ORDER} AS prev_purchase FROM state_sales")
def _(lay):
    return neighbours(lay.state_sales, ["state"], SALE_ORDER, "price", "prev_purchase", None)


@query("g7_next_value", f"SELECT *, lead(price, 1) {IN_ORDER} AS next_purchase FROM state_sales")
def _(lay):
    return neighbours(lay.state_sales, ["state"], SALE_ORDER, "price", None, "next_purchase")


@query("g8_source_priority", UPSERTED)
def _(lay):
    existing, updates = upsert_sides(lay)
    return upsert(existing, updates, "client_id")
