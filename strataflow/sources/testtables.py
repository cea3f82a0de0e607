"""Raw deliveries and layers derived from the star-schema test tables.

The dirt is placed by row keys, so each engine can derive the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import gold, silver

AS_OF = "2001-08-01"

# Fixed value: part types of the test tables and the products they stand for.
PRODUCTS = {"ECONOMY": "TV", "LARGE": "Laptop", "MEDIUM": "Phone", "PROMO": "Fridge", "SMALL": "Oven"}
OTHER_PRODUCT = "Camera"


def _every(key: str, n: int, remainder: int = 0) -> Column:
    return F.col(key) % n == remainder


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _email() -> Column:
    return F.concat(F.lit("user"), _text("c_custkey"), F.lit("@example.com"))


class Layers:
    """Lazily built frames over one folder of test tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def raw_sales(self) -> DataFrame:
        product = F.lit(OTHER_PRODUCT)
        for part_type, name in PRODUCTS.items():
            product = F.when(F.col("p_type") == part_type, name).otherwise(product)
        day = F.col("o_orderdate").cast("date")
        unpadded = F.concat(F.substring(day.cast("string"), 1, 8), F.dayofmonth(day).cast("string"))
        amount = F.col("l_extendedprice").cast("decimal(10,2)").cast("string")
        price = (
            F.when(_every("o_orderkey", 97), "")
            .when(_every("l_linenumber", 3), F.concat(amount, F.lit("$")))
            .when(_every("l_linenumber", 3, 1), F.concat(F.lit("USD "), amount))
            .otherwise(amount)
        )
        lines = self.read("lineitem").join(
            self.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        return lines.join(self.read("part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.when(_every("o_orderkey", 101), "N/A").otherwise(_text("o_custkey")).alias("CustomerId"),
            F.when(_every("o_orderkey", 103), "unknown").otherwise(unpadded).alias("PurchaseDate"),
            product.alias("Product"),
            price.alias("Price"),
        )

    @cached_property
    def raw_customers(self) -> DataFrame:
        """Three cumulative dumps; a customer first shows up in dump ``c_custkey % 3``."""
        key = F.col("c_custkey")
        dump = F.explode(F.sequence((key % 3).cast("int"), F.lit(2)))
        rows = self.read("customer").join(
            self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        rows = rows.select("c_custkey", "n_name", dump.alias("dump"))
        registered = F.concat_ws(
            "-", F.lit("1994"), (key % 12 + 1).cast("string"), (key % 28 + 1).cast("string")
        )
        return rows.select(
            F.when(_every("c_custkey", 211), "n/a").otherwise(_text("c_custkey")).alias("Id"),
            F.when(~_every("c_custkey", 5), F.concat(F.lit("First"), _text("c_custkey"))).alias("FirstName"),
            F.when(~_every("c_custkey", 7), F.concat(F.lit("Last"), _text("c_custkey"))).alias("LastName"),
            _email().alias("Email"),
            registered.alias("RegistrationDate"),
            F.when(_every("c_custkey", 4), None)
            .when(_every("c_custkey", 11) & (F.col("dump") == 2), "MOVED")
            .otherwise(F.col("n_name"))
            .alias("State"),
            F.concat(F.lit("2001-08-"), (F.col("dump") + 1).cast("string")).alias("delivery_date"),
        )

    @cached_property
    def raw_profiles(self) -> DataFrame:
        key = F.col("c_custkey")
        rows = self.read("customer").where(key % 10 != 9).join(
            self.read("nation"), (F.col("c_nationkey") + 1) % 25 == F.col("n_nationkey")
        )
        birth = F.date_add(F.lit("1965-01-01").cast("date"), (key * 37 % 11000).cast("int"))
        return rows.select(
            _email().alias("email"),
            F.when(_every("c_custkey", 13), F.concat(F.lit("Mono"), _text("c_custkey")))
            .otherwise(F.concat(F.lit("Given"), _text("c_custkey"), F.lit(" Mid Family"), _text("c_custkey")))
            .alias("full_name"),
            F.col("n_name").alias("state"),
            birth.cast("string").alias("birth_date"),
            F.concat(F.lit("+1-555-"), F.lpad(_text("c_custkey"), 7, "0")).alias("phone_number"),
        )

    @cached_property
    def sales(self) -> DataFrame:
        return silver.sales_silver(self.raw_sales).drop("processed_at")

    @cached_property
    def customer_deliveries(self) -> DataFrame:
        """Customer dumps with the delivery day as a date, as the bronze layer keeps it."""
        return self.raw_customers.withColumn("delivery_date", F.try_to_date("delivery_date", "yyyy-M-d"))

    @cached_property
    def customers(self) -> DataFrame:
        return silver.customers_silver(self.customer_deliveries).drop("processed_at")

    @cached_property
    def profiles(self) -> DataFrame:
        return silver.profiles_silver(self.raw_profiles).drop("processed_at")

    @cached_property
    def enriched(self) -> DataFrame:
        return gold.enrich_customers(
            self.customers, self.profiles, as_of=F.lit(AS_OF).cast("date")
        ).drop("processed_at")

    @cached_property
    def state_sales(self) -> DataFrame:
        """Silver sales with the state of the buyer."""
        return self.sales.join(self.customers.select("client_id", "state"), "client_id")
