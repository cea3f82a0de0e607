"""Incremental loads: new delivery files only, or one delivery day again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sinks.files import STREAM_LOG, add_to_days, exists, overwrite_days
from ..sources.files import delivery_date


def ingest_new_files(
    spark: SparkSession,
    raw: str,
    bronze: str,
    checkpoint: str,
    schema: StructType,
    shape: Callable[[DataFrame], DataFrame],
    max_files: int = 10_000,
    folders: tuple[str, ...] = (),
    unique: tuple[str, ...] = (),
    within: str = "30 days",
) -> int:
    """Append the rows of files not seen by an earlier run, then stop. Returns the rows read.

    The checkpoint remembers the files and the sink's log makes a repeated batch harmless.
    ``shape`` is the same step as in the batch load. ``max_files`` bounds one micro-batch;
    all pending files are still taken. ``folders`` names columns to have folders for. A folder that
    holds other rows is refused, because readers would no longer see them beside the sink's log.

    With ``unique``, a row equal in these columns (NULL equals NULL) to one taken no longer than ``within`` ago adds
    nothing, also when it comes in another file or run. What is remembered is bounded by the rows of that time. The
    time of a row is that of its micro-batch, which the checkpoint keeps: no row is ever late, so none is lost, and a
    batch that has to be repeated decides the same. A row that comes again after ``within`` is taken again.
    """
    if exists(spark, bronze) and not exists(spark, f"{bronze.rstrip('/')}/{STREAM_LOG}"):
        raise ValueError(f"{bronze} holds a snapshot; give the incremental load a folder of its own")
    lines = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("multiLine", False)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files)
        .csv(raw)
    )
    rows = shape(lines.withColumn("delivery_date", delivery_date()))
    if unique:
        taken = rows.withColumn("_taken_at", F.current_timestamp()).withWatermark("_taken_at", within)
        rows = taken.dropDuplicatesWithinWatermark(list(unique)).drop("_taken_at")
    writer = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    query = (writer.partitionBy(*folders) if folders else writer).start()
    # A query keeps the progress of its last hundred micro-batches, far more than run between two looks.
    read: dict[int, int] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        for progress in query.recentProgress:
            read[progress.batchId] = max(progress.numInputRows, read.get(progress.batchId, 0))
    return sum(read.values())


def reload_days(df: DataFrame, path: str, day: str = "purchase_date", replace: bool = False) -> None:
    """Bring a delivery into a day-partitioned table; doing it again changes nothing.

    By default rows are added: a delivery that was loaded before adds nothing, one that comes late adds its rows
    to what the day already has. With ``replace`` the delivery is the whole of its days: what the table has for
    them goes, so that corrected rows take the place of wrong ones. Rows without a day have a folder of their own.
    """
    if replace:
        overwrite_days(df, path, day)
    else:
        add_to_days(df, path, day)
