"""Section A and B: catalog tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import GOLD_CUSTOMERS, SILVER_CUSTOMERS, read_through, require_contract
from ..operators.dedup import upsert, upsert_by_join
from ..plans import gold, silver
from ..sinks import create_bucketed, merge_buckets, merge_into, overwrite, overwrite_partitioned, replace_table
from ..sinks import rows_of_keys, save_query
from ..sinks import stage_then_attach, write_csv
from ..sources import attach_files, attach_files_sql, load_csv, load_parquet, table
from ..sources.testtables import AS_OF
from .registry import query, scratch, scratch_table


@query("a6_catalog_table_scan", "SELECT * FROM raw_customers")
def _(lay):
    name = scratch_table(lay, "customers")
    replace_table(lay.raw_customers, name, location=scratch(lay, "table"))
    return lay.spark.table(name)


@query("a7_quoted_table_scan", "SELECT * FROM raw_user_profiles")
def _(lay):
    name = scratch_table(lay, "profiles")
    replace_table(lay.raw_profiles, name, location=scratch(lay, "table"))
    return table(lay.spark, name)


@query("a8_external_table", "SELECT * FROM silver_customers")
def _(lay):
    path = scratch(lay, "silver-customers")
    overwrite(lay.customers, path)
    contract = StructType(SILVER_CUSTOMERS[:-1].fields)
    return attach_files(lay.spark, scratch_table(lay, "customers"), path, contract)


@query(
    "a9_external_ddl_glob",
    """SELECT product_name, count(*) AS sales, CAST(sum(price) AS DECIMAL(20,2)) AS revenue
       FROM silver_sales GROUP BY product_name""",
)
def _(lay):
    path = scratch(lay, "silver-sales")
    overwrite_partitioned(lay.sales.withColumn("year", F.year("purchase_date")), path, "year")
    name = scratch_table(lay, "sales").split(".")[1]
    attach_files_sql(lay.spark, name, path, recursive=True)
    return lay.spark.sql(
        f"SELECT product_name, count(*) AS sales, sum(price) AS revenue FROM {name} GROUP BY product_name"
    )


@query(
    "a10_temp_view_sql",
    """SELECT product_name, CAST(year(purchase_date) AS INT) AS year, count(*) AS sales
       FROM silver_sales GROUP BY 1, 2""",
)
def _(lay):
    lay.sales.createOrReplaceTempView("strataflow_sales")
    return lay.spark.sql(
        "SELECT product_name, year(purchase_date) AS year, count(*) AS sales FROM strataflow_sales GROUP BY 1, 2"
    )


@query(
    "a12_csv_load_inferred",
    "SELECT client_id, purchase_date, product_name, CAST(price AS DOUBLE) AS price FROM silver_sales",
)
def _(lay):
    path = scratch(lay, "sales-csv")
    write_csv(lay.sales, path)
    return load_csv(lay.spark, scratch_table(lay, "sales"), path, scratch(lay, "table"))


@query("a13_parquet_load", "SELECT * FROM silver_sales")
def _(lay):
    path = scratch(lay, "sales")
    overwrite(lay.sales, path)
    return load_parquet(lay.spark, scratch_table(lay, "sales"), path, scratch(lay, "table"))


def gold_with_stamp(lay):
    return gold.enrich_customers(lay.customers, lay.profiles, as_of=F.lit(AS_OF).cast("date"))


@query("b7_gold_table", "SELECT * FROM gold_customers")
def _(lay):
    name = scratch_table(lay, "user_profiles_enriched")
    return replace_table(gold_with_stamp(lay), name, GOLD_CUSTOMERS, scratch(lay, "gold")).drop("processed_at")


@query("b8_staged_table", "SELECT * FROM gold_customers")
def _(lay):
    name, location = scratch_table(lay, "staged"), scratch(lay, "gold")
    stage_then_attach(lay.enriched.limit(0), name, location)
    return stage_then_attach(lay.enriched, name, location)


@query("b9_query_to_table", "SELECT * FROM gold_customers WHERE age < 25")
def _(lay):
    lay.enriched.createOrReplaceTempView("strataflow_enriched")
    return save_query(
        lay.spark,
        "SELECT * FROM strataflow_enriched WHERE age < 25",
        scratch_table(lay, "young"),
        scratch(lay, "young"),
    )


def upsert_sides(lay):
    """Clients of the first two dumps, and those with a known state in the third."""
    dumps, last = lay.customer_deliveries, F.col("delivery_date") == F.lit("2001-08-03").cast("date")
    existing = silver.customers_silver(dumps.where(~last))
    updates = silver.customers_silver(dumps.where(last & F.col("State").isNotNull()))
    return existing.drop("processed_at"), updates.drop("processed_at")


UPSERTED = """
    WITH dumps AS (
      SELECT TRY_CAST(Id AS INTEGER) AS client_id, FirstName AS first_name, LastName AS last_name, Email AS email,
             CAST(try_strptime(RegistrationDate, '%Y-%m-%d') AS DATE) AS registration_date, State AS state,
             delivery_date FROM raw_customers WHERE TRY_CAST(Id AS INTEGER) IS NOT NULL),
    updates AS (SELECT * FROM dumps WHERE delivery_date = '2001-08-3' AND state IS NOT NULL),
    existing AS (SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY delivery_date DESC) AS place
                 FROM dumps WHERE delivery_date < '2001-08-3')
    SELECT client_id, first_name, last_name, email, registration_date, state FROM updates
    UNION ALL
    SELECT client_id, first_name, last_name, email, registration_date, state FROM existing
    WHERE place = 1 AND client_id NOT IN (SELECT client_id FROM updates)"""


@query("b10_merge_into_table", UPSERTED)
def _(lay):
    existing, updates = upsert_sides(lay)
    name = scratch_table(lay, "customers")
    replace_table(existing, name, location=scratch(lay, "customers"))
    return merge_into(updates, name, "client_id", scratch(lay, "merged"))


@query("b10_merge_touched_buckets", UPSERTED)
def _(lay):
    existing, updates = upsert_sides(lay)
    name = scratch_table(lay, "customers")
    create_bucketed(existing, name, "client_id", scratch(lay, "customers"), buckets=16)
    return merge_buckets(updates, name)


@query(
    "b10_rows_of_keys",
    """SELECT * FROM silver_customers WHERE client_id IN (
         SELECT client_id FROM silver_sales WHERE price = (SELECT max(price) FROM silver_sales))""",
)
def _(lay):
    """Buyers of the dearest article, from the buckets that hold them."""
    name = scratch_table(lay, "customers")
    create_bucketed(lay.customers, name, "client_id", scratch(lay, "customers"), buckets=16)
    dearest = lay.sales.agg(F.max("price").alias("price"))
    return rows_of_keys(lay.spark, name, lay.sales.join(dearest, "price").select("client_id"))


@query("b11_upsert", UPSERTED)
def _(lay):
    return upsert(*upsert_sides(lay), "client_id")


@query("b11_upsert_by_join", UPSERTED)
def _(lay):
    return upsert_by_join(*upsert_sides(lay), "client_id")


@query("b12_contract_gate", "SELECT * FROM gold_customers")
def _(lay):
    return require_contract(gold_with_stamp(lay), GOLD_CUSTOMERS).drop("processed_at")


@query(
    "b12_contract_versions",
    """SELECT client_id, email, first_name, last_name, registration_date, state, birth_date, age,
              CASE WHEN client_id % 2 = 1 THEN phone_number END AS phone_number FROM gold_customers""",
)
def _(lay):
    """Half of the customers were written with a narrow id and no telephone number, before these came in."""
    now = StructType(GOLD_CUSTOMERS[:-1].fields)
    old = StructType([*(f for f in now if f.name not in ("client_id", "phone_number"))]).add("client_id", "integer")
    early, late = scratch(lay, "gold-1"), scratch(lay, "gold-2")
    odd = F.col("client_id") % 2 == 1
    before = lay.enriched.where(~odd).withColumn("client_id", F.col("client_id").cast("int"))
    overwrite(require_contract(before.drop("phone_number"), old), early)
    overwrite(require_contract(lay.enriched.where(odd), now), late)
    return read_through(lay.spark, {early: old, late: now}, now)
