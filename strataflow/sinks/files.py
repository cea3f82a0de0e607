"""File sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staged


STREAM_LOG = "_spark_metadata"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows of Parquet files, from their footers."""
    return spark.read.parquet(path).select().count()


def overwrite(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the whole snapshot, with ``columns`` in a folder for each value; rows are not moved.

    A folder that a stream appends to is refused: its log would go, and the stream would fail on it.
    """
    if exists(df.sparkSession, f"{path.rstrip('/')}/{STREAM_LOG}"):
        raise ValueError(f"{path} belongs to an incremental load; give the snapshot a folder of its own")
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def _sized_by(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Bring the rows of a folder together for few files, but cut a large folder over many tasks."""
    return df.hint("rebalance", *columns)


def overwrite_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """Replace the table, in one folder per value of ``columns``."""
    writer = _sized_by(df, columns).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*columns).parquet(path)


def overwrite_days(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the folders ``df`` has rows for; loading the same days twice changes nothing."""
    writer = _sized_by(df, columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(path)


def overwrite_days_sorted(df: DataFrame, path: str, day: str, key: str, row_group: int = 32 << 20) -> None:
    """As ``overwrite_days``, with the rows of each file sorted by ``key`` in row groups of ``row_group`` bytes.

    A reader of a few keys skips the row groups and pages whose least and greatest key exclude them, and by the
    Bloom filters on the key those that merely span them. A large day is still cut over many tasks, each sorted for
    itself; rows without a key come first. The sort serves the folders too, so rows are sorted once.
    """
    writer = _sized_by(df, (day,)).sortWithinPartitions(day, key).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").option("parquet.block.size", row_group)
    writer.option(f"parquet.bloom.filter.enabled#{key}", True).partitionBy(day).parquet(path)


def among(column: Column, df: DataFrame) -> Column:
    """Whether ``column``, a day or month, has a value that it has in ``df``; NULL is a value, too.

    The calendar bounds their number, so they are told by value: a scan of a table with a folder for each day then
    reads these folders only. A join on NULL-safe equality would read them all.
    """
    listed = [row[0] for row in df.select(column).distinct().toLocalIterator()]
    found = column.isin([value for value in listed if value is not None])
    return found | column.isNull() if None in listed else found


def add_to_days(df: DataFrame, path: str, day: str, stamps: tuple[str, ...] = ()) -> None:
    """Append the rows that the table lacks, counting copies; nothing that is there is touched.

    Rows are equal when all columns but ``stamps`` are. The present rows of the days in ``df`` are read,
    no others. Loading the same rows twice changes nothing.
    """
    spark = df.sparkSession
    if exists(spark, path):
        df = staged(df, "delivery")  # it is read for its days and for its rows
        compared = [name for name in df.columns if name not in stamps]
        copy = F.row_number().over(Window.partitionBy(*compared).orderBy(F.lit(1)))
        there = spark.read.schema(df.schema).parquet(path).where(among(F.col(day), df))
        there = there.select(*compared).withColumn("_copy", copy)
        there = there.withColumnsRenamed({name: f"_{name}" for name in compared} | {"_copy": "__copy"})
        same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in [*compared, "_copy"]]
        df = df.withColumn("_copy", copy).join(there, same, "left_anti").drop("_copy")
    _sized_by(df, (day,)).write.mode("append").partitionBy(day).parquet(path)
