"""File scans. Schemas are always given, so no read costs an inference pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StringType, StructField, StructType

from ..functions import day_unpadded

MALFORMED = "_malformed_line"

# Fixed value: deliveries lie in folders named by day, with or without zero padding.
DAY_FOLDER = r"/(\d{4}-\d{1,2}-\d{1,2})/"


def _readable(schema: StructType, keep_malformed: bool) -> StructType:
    return StructType([*schema, StructField(MALFORMED, StringType())]) if keep_malformed else schema


def csv_delivery(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    recursive: bool = True,
    strict_header: bool = False,
    keep_malformed: bool = False,
    null_value: str | None = None,
    empty_value: str | None = None,
) -> DataFrame:
    """CSV files with a header line, one record per line so that large files stay splittable.

    ``strict_header`` fails on a file whose header disagrees with ``schema`` instead of reading
    values into the wrong columns. ``keep_malformed`` adds the text of short and long lines.
    """
    options = {
        "header": True,
        "multiLine": False,
        "recursiveFileLookup": recursive,
        "enforceSchema": not strict_header,
        "nullValue": null_value,
        "emptyValue": empty_value,
        "columnNameOfCorruptRecord": MALFORMED if keep_malformed else None,
    }
    given = {key: value for key, value in options.items() if value is not None}
    return spark.read.options(**given).schema(_readable(schema, keep_malformed)).csv(path)


def json_lines(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    recursive: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", recursive).option("multiLine", False)
    if keep_malformed:
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
    return reader.schema(_readable(schema, keep_malformed)).json(path)


def parquet(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """Parquet files or globs; ``column=value`` folders become a prunable column, of its type in ``schema``."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(*paths)


def delivery_date() -> Column:
    """The day in the name of the folder a row was read from."""
    return day_unpadded(F.regexp_extract(F.col("_metadata.file_path"), DAY_FOLDER, 1))


def with_delivery_date(scan: DataFrame, name: str = "delivery_date") -> DataFrame:
    """Only on a frame straight from a file scan, where file metadata is still known."""
    return scan.withColumn(name, delivery_date())


def split_malformed(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and quarantined rows with the text of their line."""
    sound = scan.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    return sound, scan.where(F.col(MALFORMED).isNotNull())


def drop_void_columns(df: DataFrame, contract: StructType | None = None) -> DataFrame:
    """Remove columns without a type; those the contract knows are typed and kept instead."""
    known = {f.name: f.dataType for f in contract or ()}
    kept = []
    for field in df.schema:
        if not isinstance(field.dataType, NullType):
            kept.append(F.col(field.name))
        elif field.name in known:
            kept.append(F.lit(None).cast(known[field.name]).alias(field.name))
    return df.select(*kept)
