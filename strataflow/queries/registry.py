"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import fresh_path
from ..sources.testtables import Layers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DATABASE = "strataflow_scratch"

# What the layers are, in SQL over the test tables. Each may use the ones above it.
LAYER_SQL = {
    "raw_sales": """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN 'N/A' ELSE CAST(o_custkey AS STRING) END AS CustomerId,
       CASE WHEN o_orderkey % 103 = 0 THEN 'unknown'
            ELSE concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'),
                        '-', CAST(day(o_orderdate) AS STRING)) END AS PurchaseDate,
       CASE p_type WHEN 'ECONOMY' THEN 'TV' WHEN 'LARGE' THEN 'Laptop' WHEN 'MEDIUM' THEN 'Phone'
                   WHEN 'PROMO' THEN 'Fridge' WHEN 'SMALL' THEN 'Oven' ELSE 'Camera' END AS Product,
       CASE WHEN o_orderkey % 97 = 0 THEN ''
            WHEN l_linenumber % 3 = 0 THEN concat(CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING), '$')
            WHEN l_linenumber % 3 = 1 THEN concat('USD ', CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING))
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) END AS Price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "raw_customers": """
SELECT CASE WHEN c_custkey % 211 = 0 THEN 'n/a' ELSE CAST(c_custkey AS STRING) END AS Id,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE concat('First', CAST(c_custkey AS STRING)) END AS FirstName,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE concat('Last', CAST(c_custkey AS STRING)) END AS LastName,
       concat('user', CAST(c_custkey AS STRING), '@example.com') AS Email,
       concat('1994-', CAST(c_custkey % 12 + 1 AS STRING), '-', CAST(c_custkey % 28 + 1 AS STRING)) AS RegistrationDate,
       CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 11 = 0 AND n = 2 THEN 'MOVED' ELSE n_name END AS State,
       concat('2001-08-', CAST(n + 1 AS STRING)) AS delivery_date
FROM customer JOIN nation ON c_nationkey = n_nationkey
     JOIN (SELECT n_nationkey AS n FROM nation WHERE n_nationkey < 3) d ON c_custkey % 3 <= n""",
    "raw_user_profiles": """
SELECT concat('user', CAST(c_custkey AS STRING), '@example.com') AS email,
       CASE WHEN c_custkey % 13 = 0 THEN concat('Mono', CAST(c_custkey AS STRING))
            ELSE concat('Given', CAST(c_custkey AS STRING), ' Mid Family', CAST(c_custkey AS STRING)) END AS full_name,
       n_name AS state,
       CAST(DATE '1965-01-01' + CAST((c_custkey * 37) % 11000 AS INT) AS STRING) AS birth_date,
       concat('+1-555-', lpad(CAST(c_custkey AS STRING), 7, '0')) AS phone_number
FROM customer JOIN nation ON (c_nationkey + 1) % 25 = n_nationkey
WHERE c_custkey % 10 <> 9""",
    "typed_sales": """
SELECT TRY_CAST(CustomerId AS INTEGER) AS client_id,
       CAST(try_strptime(PurchaseDate, '%Y-%m-%d') AS DATE) AS purchase_date,
       Product AS product_name,
       TRY_CAST(regexp_replace(Price, '[^0-9.]', '', 'g') AS DECIMAL(10,2)) AS price
FROM raw_sales""",
    "silver_sales": """
SELECT * FROM typed_sales
WHERE client_id IS NOT NULL AND purchase_date IS NOT NULL AND price IS NOT NULL""",
    "silver_customers": """
SELECT client_id, first_name, last_name, email, registration_date, state
FROM (SELECT TRY_CAST(Id AS INTEGER) AS client_id, FirstName AS first_name, LastName AS last_name, Email AS email,
             CAST(try_strptime(RegistrationDate, '%Y-%m-%d') AS DATE) AS registration_date, State AS state,
             row_number() OVER (PARTITION BY TRY_CAST(Id AS INTEGER) ORDER BY delivery_date DESC) AS place
      FROM raw_customers) t
WHERE place = 1 AND client_id IS NOT NULL""",
    "silver_profiles": """
SELECT email, state, CAST(birth_date AS DATE) AS birth_date, phone_number,
       split_part(full_name, ' ', 1) AS first_name,
       CASE WHEN strpos(full_name, ' ') > 0 THEN substr(full_name, strpos(full_name, ' ') + 1) END AS last_name
FROM raw_user_profiles""",
    "gold_customers": """
SELECT CAST(c.client_id AS BIGINT) AS client_id, c.email, coalesce(c.first_name, p.first_name) AS first_name,
       coalesce(c.last_name, p.last_name) AS last_name, c.registration_date, coalesce(c.state, p.state) AS state,
       p.birth_date, CAST(floor(date_diff('day', p.birth_date, DATE '2001-08-01') / 365.25) AS BIGINT) AS age,
       p.phone_number
FROM silver_customers c LEFT JOIN silver_profiles p ON c.email = p.email""",
    "gold_sales": """
SELECT s.purchase_date, s.client_id, c.first_name, c.last_name, lower(trim(c.email)) AS email,
       coalesce(p.state, c.state) AS state, c.registration_date, p.full_name,
       CAST(p.birth_date AS DATE) AS birth_date, p.phone_number, s.product_name, s.price
FROM silver_sales s LEFT JOIN silver_customers c ON s.client_id = c.client_id
     LEFT JOIN raw_user_profiles p ON lower(trim(c.email)) = lower(trim(p.email))""",
    "state_sales": """
SELECT s.client_id, s.purchase_date, s.product_name, s.price, c.state
FROM silver_sales s JOIN silver_customers c ON s.client_id = c.client_id""",
}


def _uses(text: str) -> set[str]:
    direct = {name for name in LAYER_SQL if re.search(rf"\b{name}\b", text)}
    return direct.union(*(_uses(LAYER_SQL[name]) for name in direct))


def with_layers(text: str) -> str:
    """``text`` led by the layers it names, directly or through another layer."""
    needed = _uses(text)
    layers = [f"{name} AS ({sql})" for name, sql in LAYER_SQL.items() if name in needed]
    if not layers:
        return text.strip()
    joiner = ",\n" if text.lstrip().upper().startswith("WITH ") else "\n"
    rest = text.strip()[5:] if joiner == ",\n" else text.strip()
    return "WITH " + ",\n".join(layers) + joiner + rest


def query(name: str, oracle: str | None = None):
    """Register a function from ``Layers`` to a frame, with the SQL for the same rows."""

    def register(build: Callable[[Layers], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: build(Layers(spark, folder))
        if oracle is not None:
            ORACLES[name] = with_layers(oracle)
        return build

    return register


def scratch(lay: Layers, label: str) -> str:
    return fresh_path(lay.spark, label)


def scratch_table(lay: Layers, label: str) -> str:
    """An unused table name in a database that lies in the shared folder."""
    if not lay.spark.catalog.databaseExists(DATABASE):
        lay.spark.sql(f"CREATE DATABASE {DATABASE} LOCATION '{fresh_path(lay.spark, DATABASE)}'")
    return f"{DATABASE}.{label}_{uuid.uuid4().hex[:12]}"
