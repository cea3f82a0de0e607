"""What the plans must look like at scale."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, plan_of, rows_of
from strataflow.operators.dedup import first_ranked
from strataflow.plans import analytics, gold, silver
from strataflow.sinks import overwrite_partitioned
from strataflow.sources.testtables import Layers


def code() -> list[Path]:
    """The core; the optional subpackage has rules of its own, tested beside its other tests."""
    return sorted(f for f in (ROOT / "strataflow").rglob("*.py") if "llm" not in f.parts)


def test_no_python_functions_rdds_or_cross_joins_in_the_code():
    banned = re.compile(r"\.rdd\b|udf\(|InPandas|InArrow|crossJoin|toPandas|localCheckpoint|\.collect\(\)")
    assert [(f.name, m.group()) for f in code() for m in banned.finditer(f.read_text())] == []


@pytest.fixture(scope="module")
def stored(spark, lay):
    """Silver and gold as tables, the way questions are asked in production."""
    from strataflow.session import fresh_path, staged

    path = fresh_path(spark, "silver-sales")
    overwrite_partitioned(lay.sales.where("year(purchase_date) = 1998"), path, "purchase_date")
    return spark.read.parquet(path), staged(lay.enriched, "gold")


def test_calendar_filters_prune_folders(stored):
    sales, _ = stored
    plan = plan_of(sales.where(analytics.in_days_of_month(F.col("purchase_date"), 9, 1, 10)))
    assert re.search(r"PartitionFilters: \[[^\]]*month\(purchase_date", plan)
    plan = plan_of(sales.where(analytics.in_date_range(F.col("purchase_date"), "1998-09-01", "1998-09-10")))
    assert re.search(r"PartitionFilters: \[[^\]]*purchase_date#\d+ >= 1998-09-01", plan)


def test_flagship_reads_two_columns_and_sums_before_joining(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(analytics.top_state(*stored))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [IsNotNull(product_name), EqualTo(product_name,TV)" in plan
    assert "ReadSchema: struct<client_id:int,product_name:string>" in plan
    assert plan.index("SortMergeJoin") < plan.index("partial_count(1)")
    assert plan.count("Exchange hashpartitioning(") == 3  # sales per client, customers, states


def test_facts_move_once_in_gold_sales(spark, lay):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sales = spark.createDataFrame([], "client_id int, purchase_date date, product_name string, price decimal(10,2)")
        customers = spark.createDataFrame([], lay.customers.schema)
        profiles = spark.createDataFrame([], silver.profiles_distinct(lay.raw_profiles).schema)
        plan = plan_of(gold.sales_enriched(sales, customers, profiles))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(client_id") == 2  # facts once, people once


def test_each_key_is_cut_to_one_row_before_the_shuffle(spark, lay):
    deliveries = silver.customers_typed(lay.customer_deliveries)
    assert plan_of(silver.customers_silver(lay.customer_deliveries)).count("partial_max") == 1
    ranked = plan_of(first_ranked(deliveries, ["client_id"], [F.col("delivery_date").desc()]))
    assert re.search(r"WindowGroupLimit .* Final[\s\S]*Exchange[\s\S]*WindowGroupLimit .* Partial", ranked)


def test_no_registered_query_has_a_nested_loop_or_cartesian_join(spark):
    from strataflow.queries import QUERIES
    from strataflow.session import shared_folder

    assert shared_folder(spark)
    quick = [n for n in QUERIES if n[0] in "cdefghijm" and not n.startswith(("m1_", "m3_", "m5c_", "m7_sales_enriched_by", "h5_client_day"))]
    for name in quick:
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
        assert "Python" not in plan, name


def test_dirty_text_is_parsed_once_and_product_filters_still_reach_the_scan(spark, folder):
    spark.range(3).selectExpr(
        "'1' AS CustomerId", "'2022-9-1' AS PurchaseDate", "'TV' AS Product", "'5' AS Price"
    ).write.parquet(folder)
    plan = plan_of(silver.sales_silver(spark.read.parquet(folder)).where("product_name = 'TV'"))
    assert plan.count("gettimestamp(") == 1 and plan.count("regexp_replace(") == 1
    assert "EqualTo(Product,TV)" in plan


def hot_sales(spark):
    """One client with a third of all sales."""
    return spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias("client_id"),
        F.lit("TV").alias("product_name"),
        F.lit("x" * 40).alias("payload"),
    )


def test_a_hot_client_is_split_by_the_runtime_skew_join(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        people = spark.range(6000).select(F.col("id").cast("int").alias("client_id"), F.lit("s").alias("state"))
        joined = hot_sales(spark).join(people, "client_id", "left")
        joined.write.format("noop").mode("overwrite").save()
        joined.collect()
        assert "skew=true" in plan_of(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("kind", ["string", "int", "bigint"])
def test_null_keys_are_spread(spark, kind):
    """Half of the keys are NULL; without care they would all be in one of the eight partitions."""
    from strataflow.operators.joins import left_join_on_nullable

    key = F.when(F.col("id") % 2 == 0, F.col("id")).cast(kind)
    left = spark.range(0, 8000, 1, 4).select(key.alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 8000, 3).select(F.col("id").cast(kind).alias("k"), F.col("id").alias("w"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = {}
        for join in (left_join_on_nullable, lambda a, b, k: a.join(b, k, "left")):
            joined = join(left, right, "k").groupBy(F.spark_partition_id()).count().collect()
            sizes[join] = max(size[1] for size in joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    spread, plain = sizes.values()
    assert spread < 1500 and plain > 4000
    assert rows_of(left_join_on_nullable(left, right, "k")) == rows_of(left.join(right, "k", "left"))


def test_a_hot_day_is_written_by_several_tasks(spark, folder):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "50000")
    try:
        day = F.when(F.col("id") % 3 == 0, "2022-09-01").otherwise("2022-09-02").cast("date")
        rows = spark.range(0, 90000, 1, 8).select("id", F.xxhash64("id").alias("h"), day.alias("purchase_date"))
        overwrite_partitioned(rows, folder, "purchase_date")
    finally:
        spark.conf.set(key, before)
    assert len(list(Path(folder).glob("purchase_date=2022-09-01/*.parquet"))) > 1
    assert spark.read.parquet(folder).count() == 90000


def test_test_layers_add_up(spark, lay):
    got = lay.sales.agg(F.count(F.lit(1)), F.sum("price")).first()
    assert (got[0], str(got[1])) == (5832, "308170931.11")
    assert lay.customers.count() == lay.enriched.count() == 149
    assert rows_of(lay.customers.groupBy("client_id").count().where("count > 1")) == []
    assert isinstance(lay, Layers)
