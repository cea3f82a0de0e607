"""Raw text with audit columns; nothing is typed or renamed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import RAW_CUSTOMERS, RAW_SALES


def _stamped(raw: DataFrame, source_columns: list[str], run_ts: Column | None) -> DataFrame:
    # Blank lines are judged on source columns alone: an audit column is never NULL.
    moment = F.current_timestamp() if run_ts is None else run_ts
    return raw.dropna("all", subset=source_columns).withColumn("ingested_at", moment)


def sales_bronze(raw: DataFrame, run_ts: Column | None = None) -> DataFrame:
    return _stamped(raw.select(*RAW_SALES.fieldNames()), RAW_SALES.fieldNames(), run_ts)


def customers_bronze(raw: DataFrame, run_ts: Column | None = None) -> DataFrame:
    """Keeps ``delivery_date``, which tells repeated dumps of one customer apart."""
    columns = RAW_CUSTOMERS.fieldNames()
    return _stamped(raw.select(*columns, "delivery_date"), columns, run_ts)
