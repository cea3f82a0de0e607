"""What several operators share: reading, words, names that do not clash, running positions."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staged

# White space that separates words, [\x20\x09-\x0D], and a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Rows that one task of running() sorts.
SLICE = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """Sizes batches for rows that are whole texts, unless the cluster has its own setting.

    Ten thousand documents, the default, are tens of MB outside the heap, on both sides of every worker, and the
    4,096 rows that a scan holds at a time are tens of MB of the heap.
    """
    for setting, rows in {"spark.sql.execution.arrow.maxRecordsPerBatch": "250", "spark.sql.parquet.columnarReaderBatchSize": "512"}.items():
        if not spark.sparkContext.getConf().contains(setting):
            spark.conf.set(setting, rows)


def give_back() -> None:
    """Return the free memory of a worker, which may wait for other work, with others beside it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def unused(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name (case does not tell names apart)."""
    taken = {column.lower() for column in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def without_ids(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``dropped``. Rows without an id can't be named and stay."""
    return docs.join(dropped.select(id_col), id_col, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def running(df: DataFrame, order: list[str], sums: dict[str, str], group: str | None = None) -> DataFrame:
    """Add ``position`` (from 0) and, for each name of ``sums``, the sum of a column over the rows before.

    Rows count in the order of ``order``, all together or within each value of ``group``. The rows
    are range-partitioned by group and order, so that one group may fill many tasks; each task counts
    by itself and starts from the totals of the ranges before it, a table with one row for each range
    and group. ``df`` holds the few columns that are needed and is cheap to count; it is staged once.
    """
    keys = ([group] if group else []) + order
    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // SLICE))
    piece, place = unused(df.columns, "piece"), unused(df.columns, "position")
    ranged = staged(df.repartitionByRange(slices, *keys).withColumn(piece, F.spark_partition_id()), "ranges")
    by = [piece] + ([group] if group else [])
    inner = Window.partitionBy(*by).orderBy(*order)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.withColumn(place, F.row_number().over(inner).cast("long") - 1)
    for name, column in sums.items():
        counted = counted.withColumn(name, F.coalesce(F.sum(column).over(before), F.lit(0)))
    totals = ranged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(column).alias(f"_{name}") for name, column in sums.items()]
    )
    earlier = (Window.partitionBy(group) if group else Window.partitionBy()).orderBy(piece)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_start") for c in totals.columns if c not in by],
    )
    match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    joined = counted.join(starts, match, "left")
    added: dict[str, Column] = {place: F.col(place) + F.col("_rows_start")}
    added |= {name: F.col(name) + F.col(f"_{name}_start") for name in sums}
    return joined.withColumns(added).drop(piece, *starts.columns)
