"""Distinct buyers of any span of days from sketches of single days.

A HyperLogLog sketch is a few KB whatever it counted, and sketches of days unite without reading sales again.
The exact count is a plain aggregate; this one is for spans asked for over and over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REGISTERS = 12  # 2^12 registers: the estimate is off by 1.6 % as a standard deviation, by 5 % next to never


def day_sketches(sales: DataFrame, *also_by: str, value: str = "client_id", registers: int = REGISTERS) -> DataFrame:
    """A sketch of the distinct ``value`` for each purchase day (and further columns)."""
    return sales.groupBy("purchase_date", *also_by).agg(F.hll_sketch_agg(value, F.lit(registers)).alias("sketch"))


def distinct_in(sketches: DataFrame, *by: str | Column, name: str = "distinct_estimate") -> DataFrame:
    """Estimated distinct values of all days that ``sketches`` has, or of each group of them."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
