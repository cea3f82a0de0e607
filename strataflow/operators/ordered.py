"""Running totals, ranks and neighbours that hold up when one group owns much of the data.

A plain window puts a whole group into one task. Here the big data is only ever aggregated, range
partitioned or joined; windows run over per-day totals or over slices of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from ..session import staged


def _with_daily(
    df: DataFrame, group: str, day: str, totals: Sequence[Column], columns: dict[str, Column]
) -> DataFrame:
    """Add columns that depend only on group and day, worked out on one row per group and day.

    The rows are derived once and written, and read again for the summary and for the result. The summary is
    written too, so Spark knows its size when it plans the join: a small one is broadcast and the big data does
    not move at all, a large one is shuffled.
    """
    if not isinstance(df.schema[day].dataType, DateType):
        raise TypeError(f"{day} must be a date: the calendar is what bounds the rows per group")
    df = staged(df, "facts")
    daily = df.groupBy(group, day).agg(*totals).withColumns(columns)
    daily = staged(daily.select(F.col(group).alias("_group"), F.col(day).alias("_day"), *columns), "daily")
    same = df[group].eqNullSafe(daily["_group"]) & df[day].eqNullSafe(daily["_day"])
    return df.join(daily, same, "left").drop("_group", "_day")


def running_total(df: DataFrame, group: str, day: str, value: str, name: str = "running_total") -> DataFrame:
    """Sum of ``value`` up to and including the day; rows of one day share the total."""
    window = Window.partitionBy(group).orderBy(day)
    kind = df.schema[value].dataType
    total = F.sum("_total").over(window)
    if kind.typeName() == "decimal":
        total = total.cast(f"decimal({min(38, kind.precision + 10)},{kind.scale})")
    return _with_daily(df, group, day, [F.sum(value).alias("_total")], {name: total})


def rank_by_day(df: DataFrame, group: str, day: str, name: str = "rank") -> DataFrame:
    """1 + number of rows of the group on earlier days."""
    window = Window.partitionBy(group).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum("_rows").over(window), F.lit(0))
    return _with_daily(df, group, day, [F.count(F.lit(1)).alias("_rows")], {name: earlier + 1})


def running_by_row(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[str],
    value: str,
    total: str | None = "running_total",
    place: str | None = "place",
    slices: int | None = None,
) -> DataFrame:
    """Sum of ``value`` up to and including the row within its group, and the row's place from 1.

    For orders finer than days, where a summary by day does not help: a prefix scan in two levels. Rows are range
    partitioned by group and order and written, so a group is cut into as many slices as its size asks for. A
    summary of one row per slice and group gives each slice the sum and count of the slices before it, and windows
    run within slices. Ties of ``order_by`` are ordered by ``value``; NULL values add nothing, and the sum is NULL
    as long as all were. The number of slices is that of shuffle partitions, unless given.
    """
    columns = df.columns
    kind = df.schema[value].dataType
    order = [*order_by, *([] if value in order_by else [value]), "_from"]
    marked = df.withColumn("_from", F.spark_partition_id())
    ranged = marked.repartitionByRange(*([slices] if slices else []), *groups, *order)
    rows = staged(ranged.withColumn("_slice", F.spark_partition_id()), "running")

    sums = rows.groupBy("_slice", *groups).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_values"), F.count(F.lit(1)).alias("_rows")
    )
    before = Window.partitionBy(*groups).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("_slice").alias("_at"),
        *(F.col(name).alias(f"_at_{i}") for i, name in enumerate(groups)),
        *(F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"{name}_before") for name in ("_sum", "_values", "_rows")),
    )
    same = [F.col("_slice") == F.col("_at"), *(F.col(name).eqNullSafe(F.col(f"_at_{i}")) for i, name in enumerate(groups))]

    inside = Window.partitionBy("_slice", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = {
        "_sum_here": F.coalesce(F.sum(value).over(inside), F.lit(0)),
        "_values_here": F.count(value).over(inside),
        "_rows_here": F.count(F.lit(1)).over(inside),
    }
    joined = rows.withColumns(within).join(starts, same)
    summed = F.col("_sum_before") + F.col("_sum_here")
    if kind.typeName() == "decimal":
        summed = summed.cast(f"decimal({min(38, kind.precision + 10)},{kind.scale})")
    wanted = {total: F.when(F.col("_values_before") + F.col("_values_here") > 0, summed)} if total else {}
    wanted |= {place: F.col("_rows_before") + F.col("_rows_here")} if place else {}
    return joined.withColumns(wanted).select(*columns, *wanted)


def neighbours(
    df: DataFrame,
    groups: Sequence[str],
    order_by: Sequence[str],
    value: str,
    previous: str | None = "previous",
    following: str | None = "following",
    slices: int | None = None,
) -> DataFrame:
    """``value`` of the row before and after within its group, in the order of ``order_by``.

    Rows are range partitioned by group and order, so a group is cut into as many slices as its
    size asks for. Each slice then gets the last row of the slice before it and the first of the
    one after it as guests, found in a summary of one row per slice and group, and windows run per
    slice. The number of slices is that of shuffle partitions, unless given. Ties of ``order_by``
    are ordered by ``value``.
    """
    columns = df.columns
    ties = [] if value in order_by else [value]
    # Copies differ in nothing but the input partition they came from. That is the same when a
    # task runs again, and lets even one row repeated over much of the data be cut into slices.
    place = [*order_by, *ties, "_from"]
    marked = df.withColumn("_from", F.spark_partition_id())
    ranged = marked.repartitionByRange(*([slices] if slices else []), *groups, *place)
    rows = staged(ranged.withColumn("_slice", F.spark_partition_id()), "neighbours")

    ends = rows.groupBy("_slice", *groups).agg(
        F.min(F.struct(*place)).alias("_start"), F.max(F.struct(*place)).alias("_end")
    )
    across = Window.partitionBy(*groups).orderBy("_slice")
    beside = ends.select(
        "_slice", *groups, F.lag("_end").over(across).alias("_back"), F.lead("_start").over(across).alias("_ahead")
    )
    guests = F.filter(
        F.array(
            F.struct(F.lit(-1).alias("_guest"), F.col("_back").alias("_row")),
            F.struct(F.lit(1).alias("_guest"), F.col("_ahead").alias("_row")),
        ),
        lambda guest: guest["_row"].isNotNull(),
    )
    guests = beside.select("_slice", *groups, F.inline(guests)).select("_slice", *groups, "_guest", f"_row.{value}")

    complete = rows.withColumn("_guest", F.lit(0)).unionByName(guests, allowMissingColumns=True)
    inside = Window.partitionBy("_slice", *groups).orderBy("_guest", *place)
    wanted = {name: F.lag(value).over(inside) for name in [previous] if name}
    wanted |= {name: F.lead(value).over(inside) for name in [following] if name}
    return complete.withColumns(wanted).where("_guest = 0").select(*columns, *wanted)
