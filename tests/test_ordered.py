"""Ordered columns against plain windows, with hot groups, copies and NULLs."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows_of
from strataflow.operators.ordered import neighbours, rank_by_day, running_by_row, running_total


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows in one group, a third of that group equal copies, some NULLs."""
    n = F.col("id")
    return spark.range(0, 1800, 1, 7).select(
        F.when(n % 3 == 0, "hot").when(n % 41 == 0, None).otherwise(F.concat(F.lit("g"), n % 5)).alias("g"),
        F.when(n % 9 == 0, F.lit("2022-01-05").cast("date"))
        .when(n % 97 != 0, F.date_add(F.lit("2022-01-01").cast("date"), (n * 7 % 31).cast("int")))
        .alias("d"),
        F.when(n % 9 == 0, 1).otherwise(n * 13 % 50).cast("int").alias("c"),
        F.when(n % 9 == 0, 5).when(n % 17 != 0, n * 11 % 23).cast("decimal(10,2)").alias("price"),
    )


def test_running_total(facts):
    window = Window.partitionBy("g").orderBy("d")
    expected = facts.withColumn("t", F.sum("price").over(window))
    assert rows_of(running_total(facts, "g", "d", "price", "t")) == rows_of(expected)


def test_rank(facts):
    expected = facts.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy("d")).cast("long"))
    assert rows_of(rank_by_day(facts, "g", "d", "r")) == rows_of(expected)


def test_day_must_be_a_date(facts):
    with pytest.raises(TypeError):
        rank_by_day(facts, "g", "price")


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_neighbours(facts, slices):
    window = Window.partitionBy("g").orderBy("d", "c", "price")
    expected = facts.withColumns({"p": F.lag("price").over(window), "n": F.lead("price").over(window)})
    got = neighbours(facts, ["g"], ["d", "c", "price"], "price", "p", "n", slices=slices)
    assert rows_of(got.select("g", "d", "c", "price", "p")) == rows_of(expected.drop("n"))
    assert rows_of(got.select("g", "d", "c", "price", "n")) == rows_of(expected.drop("p"))


@pytest.mark.parametrize("slices", [1, 3, 40])
def test_running_by_row(facts, slices):
    """Rows that tie in all columns are equal, so any order of them gives the same rows."""
    window = Window.partitionBy("g").orderBy("d", "c", "price")
    sofar = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    expected = facts.withColumns({"t": F.sum("price").over(sofar), "n": F.row_number().over(window).cast("long")})
    got = running_by_row(facts, ["g"], ["d", "c"], "price", "t", "n", slices=slices)
    assert rows_of(got) == rows_of(expected)
    assert running_by_row(facts, ["g"], ["d"], "price", None).columns == [*facts.columns, "place"]


def test_running_by_row_over_everything_and_over_nothing(spark, facts):
    copies = spark.range(0, 4000, 1, 8).selectExpr("'hot' AS g", "1 AS o", "2L AS v")
    got = running_by_row(copies, ["g"], ["o"], "v", slices=8)
    assert rows_of(got.select("running_total")) == rows_of(spark.range(1, 4001).selectExpr("id * 2"))
    assert running_by_row(facts.limit(0), ["g"], ["d"], "price").count() == 0


def test_a_hot_group_of_copies_is_cut_into_slices(spark):
    copies = spark.range(0, 4000, 1, 8).select(
        F.lit("hot").alias("g"), F.lit("2022-01-01").cast("date").alias("d"), F.lit(1).alias("v")
    )
    marked = copies.withColumn("_from", F.spark_partition_id()).repartitionByRange(8, "g", "d", "v", "_from")
    sizes = marked.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 5 and max(size[1] for size in sizes) < 1500
    got = neighbours(copies, ["g"], ["d"], "v", "p", "n", slices=8)
    assert got.count() == 4000
    assert got.where("p IS NULL").count() == 1 and got.where("n IS NULL").count() == 1


def test_ties_are_ordered_by_value(spark):
    df = spark.range(0, 300, 1, 5).selectExpr("'g' AS g", "date'2022-01-01' AS d", "(id * 7) % 300 AS v")
    got = neighbours(df, ["g"], ["d"], "v", "p", "n", slices=6)
    assert got.where("p IS NOT NULL AND p <> v - 1 OR n IS NOT NULL AND n <> v + 1").count() == 0
    assert got.where("p IS NULL OR n IS NULL").count() == 2
