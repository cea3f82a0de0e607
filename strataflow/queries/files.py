"""Section A and B: file sources and sinks, each as a round trip over the whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import bronze
from ..plans.analytics import in_date_range
from ..schemas import RAW_CUSTOMERS, RAW_PROFILES, RAW_SALES, SILVER_CUSTOMERS
from ..session import staged
from ..sinks import append, overwrite, overwrite_days, overwrite_days_sorted, overwrite_partitioned, preview, write_csv
from ..sources import csv_delivery, drop_void_columns, json_lines, parquet, split_malformed, with_delivery_date
from ..sources.files import MALFORMED
from ..streaming import ingest_new_files, reload_days
from .registry import query, scratch

DUMPS = ("2001-08-1", "2001-08-2", "2001-08-3")


def customer_folders(lay, root: str, days=DUMPS) -> str:
    """Raw customers as CSV in one folder per delivery day."""
    for day in days:
        dump = lay.raw_customers.where(F.col("delivery_date") == day).drop("delivery_date")
        write_csv(dump, f"{root}/{day}")
    return root


def sales_csv(lay) -> str:
    path = scratch(lay, "raw-sales")
    write_csv(lay.raw_sales, path)
    return path


RAW_SALES_READ = "SELECT CustomerId, PurchaseDate, Product, nullif(Price, '') AS Price FROM raw_sales"
RAW_CUSTOMERS_READ = "SELECT Id, FirstName, LastName, Email, RegistrationDate, State FROM raw_customers"


@query("a1_csv_scan", RAW_SALES_READ)
def _(lay):
    return csv_delivery(lay.spark, sales_csv(lay), RAW_SALES, recursive=False)


@query("a2_recursive_csv_scan", RAW_CUSTOMERS_READ)
def _(lay):
    return csv_delivery(lay.spark, customer_folders(lay, scratch(lay, "raw-customers")), RAW_CUSTOMERS)


@query("a2_strict_header_scan", RAW_CUSTOMERS_READ)
def _(lay):
    path = customer_folders(lay, scratch(lay, "raw-customers"))
    return csv_delivery(lay.spark, path, RAW_CUSTOMERS, strict_header=True)


@query("a3_parquet_scan", "SELECT * FROM raw_customers")
def _(lay):
    path = scratch(lay, "customers")
    overwrite(lay.raw_customers, path)
    return parquet(lay.spark, path)


@query("a4_json_lines_scan", "SELECT * FROM raw_user_profiles")
def _(lay):
    path = scratch(lay, "raw-profiles")
    lay.raw_profiles.write.json(path)
    return json_lines(lay.spark, path, RAW_PROFILES)


@query("a5_json_recursive_scan", "SELECT * FROM raw_user_profiles")
def _(lay):
    root = scratch(lay, "raw-profiles")
    named = F.col("full_name").contains(" ")
    lay.raw_profiles.where(named).write.json(f"{root}/2001-08-1/full")
    lay.raw_profiles.where(~named).write.json(f"{root}/2001-08-2")
    return json_lines(lay.spark, root, RAW_PROFILES, recursive=True)


@query(
    "a11_csv_null_tokens",
    "SELECT Id, coalesce(FirstName, '') AS FirstName, State FROM raw_customers",
)
def _(lay):
    """NULL is written as a word and the empty string in quotes, so the two stay apart."""
    path = scratch(lay, "tokens")
    rows = lay.raw_customers.select("Id", F.coalesce("FirstName", F.lit("")).alias("FirstName"), "State")
    rows.write.options(header=True, nullValue="NULL").csv(path)
    return csv_delivery(lay.spark, path, rows.schema, recursive=False, null_value="NULL", empty_value="")


@query(
    "a14_delivery_date",
    """SELECT Id, Email, State, CAST(try_strptime(delivery_date, '%Y-%m-%d') AS DATE) AS delivery_date
       FROM raw_customers""",
)
def _(lay):
    path = customer_folders(lay, scratch(lay, "raw-customers"))
    scan = with_delivery_date(csv_delivery(lay.spark, path, RAW_CUSTOMERS))
    return scan.select("Id", "Email", "State", "delivery_date")


@query(
    "a15_partition_discovery",
    """SELECT purchase_date, count(*) AS sales, CAST(sum(price) AS DECIMAL(20,2)) AS revenue
       FROM silver_sales WHERE purchase_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
       GROUP BY purchase_date""",
)
def _(lay):
    path = scratch(lay, "sales-by-day")
    overwrite_partitioned(lay.sales, path, "purchase_date")
    some_years = parquet(lay.spark, path).where("purchase_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'")
    return some_years.groupBy("purchase_date").agg(
        F.count(F.lit(1)).alias("sales"), F.sum("price").alias("revenue")
    )


@query("a16_drop_void_columns", "SELECT * FROM raw_user_profiles")
def _(lay):
    return drop_void_columns(lay.raw_profiles.withColumn("remark", F.lit(None)))


@query(
    "a16_typed_void_columns",
    "SELECT email, full_name, CAST(NULL AS STRING) AS state, birth_date FROM raw_user_profiles",
)
def _(lay):
    profiles = lay.raw_profiles.select("email", "full_name", F.lit(None).alias("state"), "birth_date")
    return drop_void_columns(profiles, RAW_PROFILES)


def damaged_sales(lay) -> str:
    """Sales lines as text, where some lack the last field and some have one too many."""
    path = scratch(lay, "damaged-sales")
    key = F.col("l_orderkey")
    fields = [F.col(n).cast("string") for n in ("l_orderkey", "l_shipmonth", "l_returnflag")]
    line = F.concat_ws(",", *fields)
    priced = F.concat_ws(",", line, F.col("l_quantity").cast("int").cast("string"))
    text = F.when(key % 89 == 0, line).when(key % 83 == 0, F.concat(priced, F.lit(",x"))).otherwise(priced)
    rows = lay.read("lineitem").withColumn("l_shipmonth", F.date_format("l_shipdate", "yyyy-MM"))
    # One column named like the header line, with a separator that never occurs in it.
    rows.select(text.alias(",".join(RAW_SALES.fieldNames()))).write.option("header", True).option(
        "sep", "\u0001"
    ).csv(path)
    return path


DAMAGED = """
    SELECT l_orderkey AS k, CAST(l_orderkey AS STRING) AS a, strftime(l_shipdate, '%Y-%m') AS b,
           l_returnflag AS c, CAST(CAST(l_quantity AS INT) AS STRING) AS d FROM lineitem"""


@query(
    "a17_quarantined_rows",
    f"""SELECT a AS CustomerId, b AS PurchaseDate, c AS Product, CASE WHEN k % 89 <> 0 THEN d END AS Price,
               CASE WHEN k % 89 = 0 THEN concat(a, ',', b, ',', c) ELSE concat(a, ',', b, ',', c, ',', d, ',x') END
               AS {MALFORMED}
        FROM ({DAMAGED}) t WHERE k % 89 = 0 OR k % 83 = 0""",
)
def _(lay):
    return split_malformed(csv_delivery(lay.spark, damaged_sales(lay), RAW_SALES, keep_malformed=True))[1]


@query(
    "a17_sound_rows",
    f"""SELECT a AS CustomerId, b AS PurchaseDate, c AS Product, d AS Price
        FROM ({DAMAGED}) t WHERE k % 89 <> 0 AND k % 83 <> 0""",
)
def _(lay):
    return split_malformed(csv_delivery(lay.spark, damaged_sales(lay), RAW_SALES, keep_malformed=True))[0]


@query("b1_overwrite_snapshot", "SELECT * FROM silver_customers")
def _(lay):
    path = scratch(lay, "customers")
    overwrite(lay.raw_customers, path)
    overwrite(lay.customers, path)
    return parquet(lay.spark, path)


@query("b2_partitioned_by_day", "SELECT * FROM silver_sales")
def _(lay):
    path = scratch(lay, "sales-by-day")
    overwrite_partitioned(lay.sales, path, "purchase_date")
    return parquet(lay.spark, path).select(*lay.sales.columns)


@query(
    "b3_dynamic_partition_overwrite",
    """SELECT client_id, purchase_date, product_name, CASE WHEN year(purchase_date) = 1997
         THEN CAST(price + 1 AS DECIMAL(10,2)) ELSE price END AS price FROM silver_sales""",
)
def _(lay):
    path = scratch(lay, "sales-by-month")
    monthly = staged(lay.sales, "sales").withColumn("month", F.trunc("purchase_date", "month"))
    overwrite_partitioned(monthly, path, "month")
    corrected = monthly.where(F.year("purchase_date") == 1997)
    overwrite_days(corrected.withColumn("price", (F.col("price") + 1).cast("decimal(10,2)")), path, "month")
    return parquet(lay.spark, path).select(*lay.sales.columns)


@query(
    "b4_partitioned_by_year_month",
    """SELECT *, CAST(year(purchase_date) AS INT) AS year, CAST(month(purchase_date) AS INT) AS month
       FROM silver_sales""",
)
def _(lay):
    path = scratch(lay, "sales-by-month")
    dated = lay.sales.withColumns({"year": F.year("purchase_date"), "month": F.month("purchase_date")})
    overwrite_partitioned(dated, path, "year", "month")
    return parquet(lay.spark, path)


@query("b5_append", "SELECT * FROM raw_customers")
def _(lay):
    path = scratch(lay, "customers")
    for day in DUMPS:
        append(lay.raw_customers.where(F.col("delivery_date") == day), path)
    return parquet(lay.spark, path)


@query("b6_csv_write", "SELECT * FROM silver_customers")
def _(lay):
    path = scratch(lay, "customers-csv")
    write_csv(lay.customers, path)
    typed = SILVER_CUSTOMERS[:-1]
    return csv_delivery(lay.spark, path, typed, recursive=False, strict_header=True)


@query("b13_preview", "SELECT * FROM gold_customers ORDER BY client_id LIMIT 10")
def _(lay):
    return preview(lay.enriched.orderBy("client_id"))


@query("m1_sales_raw_to_bronze", RAW_SALES_READ)
def _(lay):
    raw = csv_delivery(lay.spark, sales_csv(lay), RAW_SALES)
    path = scratch(lay, "bronze-sales")
    overwrite(bronze.sales_bronze(raw), path)
    return parquet(lay.spark, path).drop("ingested_at")


@query(
    "m3_customers_raw_to_bronze",
    """SELECT Id, FirstName, LastName, Email, RegistrationDate, State,
              CAST(try_strptime(delivery_date, '%Y-%m-%d') AS DATE) AS delivery_date FROM raw_customers""",
)
def _(lay):
    raw = csv_delivery(lay.spark, customer_folders(lay, scratch(lay, "raw-customers")), RAW_CUSTOMERS)
    path = scratch(lay, "bronze-customers")
    overwrite(bronze.customers_bronze(with_delivery_date(raw)), path)
    return parquet(lay.spark, path).drop("ingested_at")


@query("m5c_profiles_passthrough", "SELECT * FROM raw_user_profiles")
def _(lay):
    source, target = scratch(lay, "raw-profiles"), scratch(lay, "profiles")
    lay.raw_profiles.write.json(source)
    overwrite(drop_void_columns(json_lines(lay.spark, source, RAW_PROFILES, recursive=True)), target)
    return parquet(lay.spark, target)


@query("k1_incremental_ingest", RAW_CUSTOMERS_READ)
def _(lay):
    root = scratch(lay, "stream")
    where = {"raw": f"{root}/raw", "bronze": f"{root}/bronze", "checkpoint": f"{root}/checkpoint"}
    for days in (DUMPS[:2], DUMPS[2:], ()):
        customer_folders(lay, where["raw"], days)
        ingest_new_files(lay.spark, **where, schema=RAW_CUSTOMERS, shape=bronze.customers_bronze)
    return parquet(lay.spark, where["bronze"]).drop("ingested_at", "delivery_date")


@query(
    "k1_redelivered_lines",
    """SELECT Id, FirstName, LastName, Email, RegistrationDate, State,
              CAST(try_strptime(delivery_date, '%Y-%m-%d') AS DATE) AS delivery_date FROM raw_customers""",
)
def _(lay):
    """Each dump is delivered twice, the second time in new files and after the next dump."""
    root = scratch(lay, "stream")
    where = {"raw": f"{root}/raw", "bronze": f"{root}/bronze", "checkpoint": f"{root}/checkpoint"}
    line = (*RAW_CUSTOMERS.fieldNames(), "delivery_date")
    for days in (DUMPS[:1], DUMPS[:2], DUMPS[1:], DUMPS[2:]):
        customer_folders(lay, where["raw"], days)
        ingest_new_files(lay.spark, **where, schema=RAW_CUSTOMERS, shape=bronze.customers_bronze, unique=line)
    return parquet(lay.spark, where["bronze"]).drop("ingested_at")


@query(
    "b2_days_sorted_by_client",
    """SELECT s.* FROM silver_sales s
       JOIN (SELECT client_id FROM silver_customers WHERE state = 'MOVED') m ON s.client_id = m.client_id""",
)
def _(lay):
    """Sales stored by day and sorted by client, then the history of the customers who moved."""
    path = scratch(lay, "sales-by-day")
    overwrite_days_sorted(lay.sales, path, "purchase_date", "client_id")
    moved = lay.customers.where(F.col("state") == "MOVED").select("client_id")
    return parquet(lay.spark, path).join(moved, "client_id", "left_semi").select(*lay.sales.columns)


@query("k2_idempotent_reload", "SELECT * FROM silver_sales")
def _(lay):
    path, known = scratch(lay, "sales-by-day"), staged(lay.sales, "sales")
    reload_days(known, path)
    reload_days(known.where(F.year("purchase_date") == 1999), path)
    return parquet(lay.spark, path).select(*lay.sales.columns)


@query("k2_corrected_days", "SELECT * FROM silver_sales")
def _(lay):
    """A month is loaded with wrong prices, twice over, and then delivered again, twice."""
    path, known = scratch(lay, "sales-by-day"), staged(lay.sales, "sales")  # read for five parts of the loads
    month = in_date_range(F.col("purchase_date"), "1996-03-01", "1996-03-31")
    wrong = known.where(month).withColumn("price", (F.col("price") / 2).cast("decimal(10,2)"))
    reload_days(known.where(~month).unionByName(wrong).unionByName(wrong), path)
    for _again in range(2):
        reload_days(known.where(month), path, replace=True)
    return parquet(lay.spark, path).select(*lay.sales.columns)
