"""Catalog tables: scans, tables laid over existing files, and loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def quoted(name: str) -> str:
    """``db.table`` with each part in back quotes, so any character is allowed."""
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(quoted(name))


def attach_files(spark: SparkSession, name: str, path: str, schema: StructType) -> DataFrame:
    """A catalog table over Parquet files that already exist, with a declared schema.

    Replaces an external table of that name, whose files stay. A managed one is refused: it owns its files.
    """
    if spark.catalog.tableExists(quoted(name)):
        if spark.catalog.getTable(quoted(name)).tableType != "EXTERNAL":
            raise ValueError(f"{name} is not an external table")
        spark.sql(f"DROP TABLE {quoted(name)}")
    return spark.catalog.createTable(quoted(name), path=path, source="parquet", schema=schema)


def attach_files_sql(
    spark: SparkSession, name: str, path: str, files: str = "*.parquet", recursive: bool = False
) -> DataFrame:
    """The same in SQL over a path or glob, replacing an earlier view of that name.

    ``recursive`` takes the files of all folders below; ``key=value`` folders then give no column.
    """
    path, files = (text.replace("'", "\\'") for text in (path, files))
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {quoted(name)} USING parquet OPTIONS "
        f"(path '{path}', pathGlobFilter '{files}', recursiveFileLookup '{str(recursive).lower()}')"
    )
    return spark.table(quoted(name))


def load_parquet(spark: SparkSession, name: str, path: str, location: str) -> DataFrame:
    spark.read.parquet(path).write.mode("overwrite").option("path", location).saveAsTable(quoted(name))
    return table(spark, name)


def load_csv(
    spark: SparkSession,
    name: str,
    path: str,
    location: str,
    schema: StructType | None = None,
) -> DataFrame:
    """Load headed CSV files into a table. Without a schema the types are inferred: one more pass."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    reader.csv(path).write.mode("overwrite").option("path", location).saveAsTable(quoted(name))
    return table(spark, name)
