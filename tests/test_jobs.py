"""Jobs that replace days, keep the summary, merge by bucket, and count right when a task ran twice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from strataflow import jobs
from strataflow.plans import summary
from strataflow.sinks import bucketed_table, is_bucketed, overwrite

SALES = "CustomerId string, PurchaseDate string, Product string, Price string"
CUSTOMERS = "Id string, FirstName string, LastName string, Email string, RegistrationDate string, State string, delivery_date string"


def bronze(spark, path, *rows, schema=SALES):
    df = spark.createDataFrame(rows, schema).withColumn("ingested_at", F.current_timestamp())
    if "delivery_date" in df.columns:
        df = df.withColumn("delivery_date", F.col("delivery_date").cast("date")).select(*jobs.BRONZE_CUSTOMERS.fieldNames())
    overwrite(df, path)
    return path


def test_a_delivery_with_corrections_replaces_its_days_and_their_summary(spark, folder):
    silver, kept = f"{folder}/silver", f"{folder}/summary"
    first = bronze(spark, f"{folder}/b1", ("1", "2022-9-1", "TV", "1"), ("2", "2022-9-2", "TV", "2$"), ("2", "2022-10-2", "TV", "x"))
    counts = jobs.sales_to_silver(spark, first, silver, summary_path=kept)
    assert counts == {"rows_in": 3, "rows_out": 2, "rows_dropped": 1, "bad_client_id": 0, "bad_purchase_date": 0, "bad_price": 1}
    again = bronze(spark, f"{folder}/b2", ("2", "2022-9-2", "TV", "5"), ("3", "2022-9-2", "Oven", "7"))
    for _ in range(2):
        jobs.sales_to_silver(spark, again, silver, replace_days=True, summary_path=kept)
        found = spark.read.parquet(silver).selectExpr("client_id", "cast(price AS string)")
        assert rows_of(found) == [(1, "1.00"), (2, "5.00"), (3, "7.00")]
    late = bronze(spark, f"{folder}/b3", ("9", "2022-9-1", "TV", "1"))
    jobs.sales_to_silver(spark, late, silver, only_days=True, summary_path=kept)
    names = sorted(summary.client_days(spark.read.parquet(silver)).columns)
    stored = summary.stored_summary(spark, kept)
    assert rows_of(stored.select(*names)) == rows_of(summary.client_days(spark.read.parquet(silver)).select(*names))
    with pytest.raises(ValueError, match="not both"):
        jobs.sales_to_silver(spark, late, silver, only_days=True, replace_days=True)


def test_counts_are_right_when_what_was_observed_counts_twice(spark, folder, monkeypatch):
    observed = jobs.observed

    class Doubled:
        def __init__(self, seen):
            self.seen = seen

        @property
        def get(self):
            return {name: 2 * count for name, count in self.seen.get.items()}

    monkeypatch.setattr(jobs, "observed", lambda df, name, **counts: (lambda f, o: (f, Doubled(o)))(*observed(df, name, **counts)))
    path = bronze(spark, f"{folder}/b", ("1", "2022-9-1", "TV", "1"), ("a", "2022-9-1", "TV", "1"), ("4", "soon", "TV", ""))
    counts = jobs.sales_to_silver(spark, path, f"{folder}/silver")
    assert counts == {"rows_in": 3, "rows_out": 1, "rows_dropped": 2, "bad_client_id": 1, "bad_purchase_date": 1, "bad_price": 1}


def test_customers_merge_by_bucket(spark, folder):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS strataflow_jobs LOCATION '{folder}/database'")
    name = f"strataflow_jobs.c_{folder[-8:]}"
    people = [(str(i), "A", "B", f"p{i}@x", "2022-01-01", "Ohio", "2022-08-01") for i in range(50)]
    jobs.merge_customers(spark, bronze(spark, f"{folder}/b1", *people, schema=CUSTOMERS), name, f"{folder}/t", buckets=8)
    assert is_bucketed(spark, name) and bucketed_table(spark, name).count() == 50
    newer = [("7", "A", "B", "p7@x", "2022-01-01", "Utah", "2022-08-02"), ("99", "N", "N", "n@x", None, None, "2022-08-02")]
    dumps = bronze(spark, f"{folder}/b2", *people, *newer, schema=CUSTOMERS)
    before = set(spark.table(name).inputFiles())
    jobs.merge_customers(spark, dumps, name, f"{folder}/unused", since="2022-08-02")
    found = {r.client_id: r.state for r in bucketed_table(spark, name).collect()}
    assert len(found) == 51 and found[7] == "Utah" and found[99] is None and found[8] == "Ohio"
    assert len(before & set(spark.table(name).inputFiles())) >= len(before) - 2
