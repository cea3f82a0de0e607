"""Row counts of a layer step: as a small frame, or collected while the step is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` unchanged, with row counts gathered by whichever action runs it: no extra pass."""
    observation = Observation(name)
    rows = F.count(F.lit(1)).alias("rows")
    return df.observe(observation, rows, *(F.count_if(test).alias(key) for key, test in counts.items())), observation


def sales_quality(typed: DataFrame) -> DataFrame:
    """Counts per cause for typed, not yet filtered sales. A row may have several causes."""
    bad = {
        "bad_client_id": F.col("client_id").isNull(),
        "bad_purchase_date": F.col("purchase_date").isNull(),
        "bad_price": F.col("price").isNull(),
    }
    dropped = bad["bad_client_id"] | bad["bad_purchase_date"] | bad["bad_price"]
    return typed.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(~dropped).alias("rows_out"),
        F.count_if(dropped).alias("rows_dropped"),
        *(F.count_if(test).alias(name) for name, test in bad.items()),
    )


def key_quality(df: DataFrame, key: str) -> DataFrame:
    """Rows in, rows without a key, repeated deliveries of a key, and rows left."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col(key).isNull()).alias("rows_without_key"),
        F.count(key).alias("_keyed"),
        F.count_distinct(key).alias("rows_out"),
    ).select(
        "rows_in",
        "rows_without_key",
        (F.col("_keyed") - F.col("rows_out")).alias("duplicates_removed"),
        "rows_out",
    )
