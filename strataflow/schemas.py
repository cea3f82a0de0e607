"""Column contracts of every layer, and the check that guards an overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, StructField, StructType

MONEY = "decimal(10,2)"


def _columns(text: str) -> StructType:
    """``"a string, b date"`` as a schema, without needing a running session."""
    schema = StructType()
    for column in text.replace("decimal(10,2)", "money").split(", "):
        name, kind = column.split(" ")
        schema = schema.add(name, MONEY if kind == "money" else kind)
    return schema


# Table layouts that producers and readers of the layers rely on.
RAW_SALES = _columns("CustomerId string, PurchaseDate string, Product string, Price string")
RAW_CUSTOMERS = _columns(
    "Id string, FirstName string, LastName string, Email string, RegistrationDate string, State string"
)
RAW_PROFILES = _columns(
    "email string, full_name string, state string, birth_date string, phone_number string"
)
BRONZE_SALES = _columns(
    "CustomerId string, PurchaseDate string, Product string, Price string, ingested_at timestamp"
)
BRONZE_CUSTOMERS = _columns(
    "Id string, FirstName string, LastName string, Email string, RegistrationDate string, "
    "State string, delivery_date date, ingested_at timestamp"
)
SILVER_SALES = _columns(
    f"client_id integer, purchase_date date, product_name string, price {MONEY}, processed_at timestamp"
)
SILVER_CUSTOMERS = _columns(
    "client_id integer, first_name string, last_name string, email string, "
    "registration_date date, state string, processed_at timestamp"
)
SILVER_PROFILES = _columns(
    "email string, state string, birth_date date, phone_number string, "
    "first_name string, last_name string, processed_at timestamp"
)
GOLD_CUSTOMERS = _columns(
    "client_id long, email string, first_name string, last_name string, registration_date date, "
    "state string, birth_date date, age long, phone_number string, processed_at timestamp"
)
GOLD_SALES = _columns(
    "purchase_date date, client_id integer, first_name string, last_name string, email string, "
    "state string, registration_date date, full_name string, birth_date date, phone_number string, "
    f"product_name string, price {MONEY}"
)
# The same with prices as the lenient and normalised profiles read them.
GOLD_SALES_DOUBLE = StructType([StructField(f.name, DoubleType()) if f.name == "price" else f for f in GOLD_SALES])


class ContractError(ValueError):
    """A frame does not have the columns its target table declares."""


def contract_differences(df: DataFrame, contract: StructType) -> list[str]:
    """Readable list of missing, unexpected and differently typed columns (order is ignored)."""
    have = {f.name: f.dataType.simpleString() for f in df.schema}
    want = {f.name: f.dataType.simpleString() for f in contract}
    missing = [f"missing column {n} {want[n]}" for n in want if n not in have]
    extra = [f"unexpected column {n} {have[n]}" for n in have if n not in want]
    retyped = [f"column {n} is {have[n]}, expected {want[n]}" for n in want if n in have and have[n] != want[n]]
    return missing + extra + retyped


def require_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """Return ``df`` in contract column order, or fail before anything is written."""
    differences = contract_differences(df, contract)
    if differences:
        raise ContractError("; ".join(differences))
    return df.select(*contract.fieldNames())


# Types whose values all fit into the ones they are listed with.
WIDER = {
    "tinyint": {"smallint", "int", "bigint", "double"},
    "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp_ntz"},
}
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def widens(old: DataType, new: DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``, digits after the point included."""
    have, want = old.simpleString(), new.simpleString()
    if isinstance(new, DecimalType):
        whole = old.precision - old.scale if isinstance(old, DecimalType) else _DIGITS.get(have, 99)
        scale = old.scale if isinstance(old, DecimalType) else 0
        return new.scale >= scale and new.precision - new.scale >= whole
    return have == want or want in WIDER.get(have, ())


def breaking_changes(old: StructType, new: StructType) -> list[str]:
    """What keeps a contract from following another: columns that went, were narrowed or changed their type.

    Columns that are added or widened do not.
    """
    want = {f.name: f.dataType for f in new}
    gone = [f"column {f.name} {f.dataType.simpleString()} is gone" for f in old if f.name not in want]
    narrowed = [
        f"column {f.name} was {f.dataType.simpleString()}, {want[f.name].simpleString()} does not hold it"
        for f in old
        if f.name in want and not widens(f.dataType, want[f.name])
    ]
    return gone + narrowed


def require_successor(old: StructType, new: StructType) -> StructType:
    """``new``, or an error that lists what breaks readers of ``old``."""
    broken = breaking_changes(old, new)
    if broken:
        raise ContractError("; ".join(broken))
    return new


def through_contract(df: DataFrame, contract: StructType) -> DataFrame:
    """Rows of an earlier contract as rows of ``contract``: new columns are NULL, narrow ones are widened."""
    require_successor(df.schema, contract)
    have = set(df.columns)
    return df.select(*(
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in contract
    ))


def read_through(spark: SparkSession, paths: dict[str, StructType], contract: StructType) -> DataFrame:
    """Parquet folders of several versions, each with the contract it was written by, as rows of the newest."""
    parts = [through_contract(spark.read.schema(version).parquet(path), contract) for path, version in paths.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
