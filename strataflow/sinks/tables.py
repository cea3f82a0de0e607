"""Catalog table sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators.dedup import upsert
from ..schemas import require_contract, require_successor
from ..sources.catalog import attach_files, quoted


def replace_table(
    df: DataFrame, name: str, contract: StructType | None = None, location: str | None = None, evolve: bool = False
) -> DataFrame:
    """Overwrite a table, in a schema that is made if there is none.

    A frame that breaks the contract fails before anything is written, and with ``evolve`` so does a contract that
    takes away, narrows or retypes a column which the table has now.
    """
    if contract is not None:
        df = require_contract(df, contract)
    if evolve and df.sparkSession.catalog.tableExists(quoted(name)):
        require_successor(df.sparkSession.table(quoted(name)).schema, df.schema)
    if "." in name:
        df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name.rpartition('.')[0])}")
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(quoted(name))
    return df.sparkSession.table(quoted(name))


def stage_then_attach(df: DataFrame, name: str, location: str) -> DataFrame:
    """Write a new folder below ``location``, then lay the table over it, so readers never see half a load.

    A table that is there already moves to the new folder; the folder of the load before stays.
    """
    target = f"{location.rstrip('/')}/load-{uuid.uuid4().hex}"
    df.write.parquet(target)
    if df.sparkSession.catalog.tableExists(quoted(name)):
        return _moved(df.sparkSession, name, target)
    return attach_files(df.sparkSession, name, target, df.schema)


def save_query(spark: SparkSession, query: str, name: str, location: str | None = None) -> DataFrame:
    """Replace a table by the result of a SQL text."""
    return replace_table(spark.sql(query), name, location=location)


def _moved(spark: SparkSession, name: str, location: str) -> DataFrame:
    escaped = location.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {quoted(name)} SET LOCATION '{escaped}'")
    spark.catalog.refreshTable(quoted(name))
    return spark.table(quoted(name))


def merge_into(updates: DataFrame, name: str, key: str, location: str) -> DataFrame:
    """Upsert into a Parquet table: write the merged rows beside it, then move the table over.

    The old files stay whole until the switch, so a failed run leaves the table as it was.
    """
    spark = updates.sparkSession
    upsert(spark.table(quoted(name)), updates, key).write.parquet(location)
    return _moved(spark, name, location)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    return df.limit(n)


def plan_text(spark: SparkSession, query: str, mode: str = "formatted") -> DataFrame:
    """The plan of a SQL text as a frame; nothing is run."""
    return spark.sql(f"EXPLAIN {mode.upper()} {query}")
