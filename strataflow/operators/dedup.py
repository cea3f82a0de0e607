"""One row per key, and upserts built on it.

All of them combine on the map side, so however often a key is delivered each map task passes on
at most one row of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_copy(df: DataFrame, *keys: str) -> DataFrame:
    """Whole-row copies go without keys; with keys the copies are taken to be equal."""
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` per key, as a maximum over structs.

    NULL sorts lowest. The remaining columns break ties, which makes the choice repeatable.
    """
    rest = [name for name in df.columns if name not in {*keys, *order_by}]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    kept = df.groupBy(*keys).agg(best)
    return kept.select(*(name if name in keys else F.col(f"_best.{name}") for name in df.columns))


def first_ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in a stated order.

    The filter on the row number lets Spark cut each key to one row before the shuffle.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """The first row of each key in the order of its other columns; NULL is a key like any other."""
    return first_ranked(df, [key], [F.col(name) for name in df.columns if name != key])


def without_keys(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key ``others`` does not have. Where ``others`` is small, the rows stay where they are."""
    return df.join(others.select(F.col(key).alias("_other")), F.col(key).eqNullSafe(F.col("_other")), "left_anti")


def upsert(existing: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """All keys of both frames; where both have one, the row of ``updates`` wins as a whole.

    ``existing`` is taken as it is, with one row for each key: its rows are looked up among the new keys, but
    neither sorted nor, where those are few, moved. Updates that repeat a key are cut to one row.
    """
    newest = one_per_key(updates, key)
    return newest.unionByName(without_keys(existing, newest, key))


def upsert_by_join(existing: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Same result for keys that are unique on each side, without sorting within keys."""
    columns = existing.columns
    old = existing.select(key, F.struct(*columns).alias("_old"))
    new = updates.select(key, F.struct(*columns).alias("_new"))
    merged = new.join(old, key, "full_outer").select(F.coalesce("_new", "_old").alias("_row"))
    return merged.select(*(F.col(f"_row.{name}") for name in columns))
