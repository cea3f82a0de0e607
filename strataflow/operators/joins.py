"""Equi-joins of facts and customer data.

The fact side is always on the left, where a runtime skew split is allowed, and is shuffled at
most once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_on_nullable(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key of any type that is often NULL on the left.

    Rows without a key would all hash to one partition. The join is on the key and a salt, which is 0
    for real keys and a hash of the other columns for rows without one; these match nothing. On the right
    the salt is computed from the key: as a literal the optimiser would take it out of the join keys.
    """
    others = [name for name in left.columns if name != key] or [key]
    salt = F.when(F.col(key).isNull(), F.hash(*others)).otherwise(0)
    keyed = left.withColumn("_salt", salt)
    found = right.where(F.col(key).isNotNull()).withColumnRenamed(key, "_found").withColumn("_salted", F.pmod(F.hash("_found"), F.lit(1)))
    matches = (F.col(key) == F.col("_found")) & (F.col("_salt") == F.col("_salted"))
    columns = [key, *(name for name in left.columns if name != key)]
    return keyed.join(found, matches, "left").select(*columns, *(n for n in right.columns if n != key))


def left_join_chain(
    facts: DataFrame, middle: DataFrame, middle_key: str, far: DataFrame, far_key: str
) -> DataFrame:
    """``facts`` left join ``middle`` left join ``far``, where ``far_key`` comes from ``middle``.

    The two small sides meet first: the result is the same, and the facts move once, not twice.
    """
    return facts.join(left_join_on_nullable(middle, far, far_key), middle_key, "left")


def left_join_to_many(few: DataFrame, many: DataFrame, key: str) -> DataFrame:
    """``few`` left join ``many``, where ``many`` may hold very many rows of one key.

    A skewed right side of a left join cannot be split at run time, that of an inner join can. So
    matches come from an inner join, and the rest from an anti join with the distinct keys.
    """
    matched = many.join(few, key)
    unmatched = few.join(many.select(key).distinct(), key, "left_anti")
    columns = [*few.columns, *(name for name in many.columns if name != key)]
    return matched.unionByName(unmatched, allowMissingColumns=True).select(*columns)


def small(df: DataFrame, rows: int, size: int) -> bool:
    """Whether ``df`` has at most so many rows, and bytes as JSON; reads no more rows than it has to."""
    width = F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("rows"), width).first()
    return found["rows"] <= rows and (found["size"] or 0) <= size


def lookup_join(
    facts: DataFrame, lookup: DataFrame, key: str, broadcast: bool = False, rows: int = 100_000, size: int = 64 << 20
) -> DataFrame:
    """Left join of facts with a lookup. Spark decides by the measured size whether to broadcast it.

    ``broadcast`` asks for it above that threshold too, but only a lookup of at most ``rows`` rows and
    ``size`` bytes is; a larger one is shuffled, whatever the caller says.
    """
    return facts.join(F.broadcast(lookup) if broadcast and small(lookup, rows, size) else lookup, key, "left")
