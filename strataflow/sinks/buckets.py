"""Tables cut into buckets by the hash of their key, and a merge that rewrites only buckets with updates.

Each bucket is a partition of the catalog table with a folder of its own. A merge prunes its scan to the
buckets that the updates fall into, writes those anew into a folder of this load, and then moves the partitions
there one by one. All other buckets are neither read nor written, and the files of a bucket stay where they
are until no reader needs them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.dedup import one_per_key, without_keys
from ..schemas import require_contract
from ..session import staged
from ..sources.catalog import quoted

BUCKET = "_bucket"
KEY, COUNT, FOLDER = "strataflow.key", "strataflow.buckets", "strataflow.folder"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _write(df: DataFrame, folder: str) -> None:
    """One folder for each bucket, small ones by one task together, a large one cut over several."""
    df.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)


def _locate(spark: SparkSession, name: str, folder: str, buckets: Iterable[int]) -> None:
    """Let the partitions ``buckets`` of the table point below ``folder``."""
    there = {row[0] for row in spark.sql(f"SHOW PARTITIONS {quoted(name)}").toLocalIterator()}
    fresh = []
    for bucket in buckets:
        place = f"'{_escaped(folder)}/{BUCKET}={bucket}'"
        if f"{BUCKET}={bucket}" in there:
            spark.sql(f"ALTER TABLE {quoted(name)} PARTITION ({BUCKET}={bucket}) SET LOCATION {place}")
        else:
            fresh.append(f"PARTITION ({BUCKET}={bucket}) LOCATION {place}")
    if fresh:
        spark.sql(f"ALTER TABLE {quoted(name)} ADD {' '.join(fresh)}")
    spark.catalog.refreshTable(quoted(name))


def _buckets_in(df: DataFrame, most: int) -> list[int]:
    """The bucket numbers that occur; there are at most as many as the table has buckets."""
    return sorted(row[0] for row in df.select(BUCKET).distinct().take(most))


def create_bucketed(
    df: DataFrame, name: str, key: str, location: str, buckets: int = 256, contract: StructType | None = None
) -> DataFrame:
    """Make a bucketed table of rows that have one row for each key; ``location`` gets a folder for each load.

    Choose ``buckets`` so that one holds a few hundred MB: a merge reads and writes whole buckets.
    """
    spark = df.sparkSession
    if contract is not None:
        df = require_contract(df, contract)
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name.rpartition('.')[0])}")
    folder = f"{location.rstrip('/')}/load-{uuid.uuid4().hex}"
    rows = staged(df.withColumn(BUCKET, bucket_of(key, buckets)), "bucketed")
    _write(rows, folder)
    schema = StructType([*rows.schema.fields])
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)
    properties = {KEY: key, COUNT: str(buckets), FOLDER: location.rstrip("/")}
    told = ", ".join(f"'{k}' = '{_escaped(v)}'" for k, v in properties.items())
    spark.sql(
        f"CREATE TABLE {quoted(name)} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) "
        f"LOCATION '{_escaped(location.rstrip('/'))}/table' TBLPROPERTIES ({told})"
    )
    _locate(spark, name, folder, _buckets_in(rows, buckets))
    return bucketed_table(spark, name)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").toLocalIterator()}


def is_bucketed(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(quoted(name)) and COUNT in _properties(spark, name)


def bucketed_table(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a bucketed table, without the bucket."""
    return spark.table(quoted(name)).drop(BUCKET)


def rows_of_keys(spark: SparkSession, name: str, keys: DataFrame) -> DataFrame:
    """The rows whose key is in ``keys`` (one column, of the table's type), from the buckets of those keys only."""
    properties = _properties(spark, name)
    key, buckets = properties[KEY], int(properties[COUNT])
    keys = staged(keys.select(F.col(keys.columns[0]).alias("_key")).distinct().withColumn(BUCKET, bucket_of("_key", buckets)), "keys")
    stored = spark.table(quoted(name)).where(F.col(BUCKET).isin(_buckets_in(keys, buckets)))
    return stored.join(keys.select("_key"), F.col(key).eqNullSafe(F.col("_key")), "left_semi").drop(BUCKET)


def merge_buckets(updates: DataFrame, name: str) -> DataFrame:
    """Upsert into a bucketed table; of updates that repeat a key the first in the order of all columns counts.

    Old rows of the touched buckets are moved once, for the write; none is sorted or compared with others.
    A bucket changes at once, several one after the other: a reader between may see some buckets before and
    some after the merge, and a merge that failed half way is completed by running it again.
    """
    spark = updates.sparkSession
    properties = _properties(spark, name)
    if COUNT not in properties:
        raise ValueError(f"{name} is not a bucketed table")
    key, buckets = properties[KEY], int(properties[COUNT])
    stored = spark.table(quoted(name))
    names = [column for column in stored.columns if column != BUCKET]
    newest = one_per_key(updates.select(*names), key).withColumn(BUCKET, bucket_of(key, buckets))
    newest = staged(newest, "updates")
    touched = _buckets_in(newest, buckets)
    if touched:
        old = stored.where(F.col(BUCKET).isin(touched))
        folder = f"{properties[FOLDER]}/load-{uuid.uuid4().hex}"
        _write(without_keys(old, newest, key).unionByName(newest), folder)
        _locate(spark, name, folder, touched)
    return bucketed_table(spark, name)
