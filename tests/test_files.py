"""Sources, sinks, catalog tables, jobs and incremental loads, as round trips."""

from __future__ import annotations

import json
import time
from datetime import date
from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from strataflow import jobs
from strataflow.plans import bronze, summary
from strataflow.queries import registry
from strataflow.queries.registry import DATABASE
from strataflow.schemas import (
    BRONZE_CUSTOMERS,
    GOLD_CUSTOMERS,
    RAW_CUSTOMERS,
    RAW_SALES,
    SILVER_SALES,
    ContractError,
    breaking_changes,
    contract_differences,
    read_through,
    require_contract,
    through_contract,
)
from strataflow.session import fresh_path, shared_folder
from strataflow.sinks import merge_into, overwrite, overwrite_days, overwrite_days_sorted, overwrite_partitioned, plan_text, preview
from strataflow.sinks import replace_table
from strataflow.sources import attach_files, attach_files_sql, csv_delivery, drop_void_columns, json_lines
from strataflow.sources import parquet, split_malformed, with_delivery_date
from strataflow.streaming import ingest_new_files, reload_days


def put(folder: str, name: str, text: str) -> None:
    from pathlib import Path

    target = Path(folder) / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


SALES = "CustomerId,PurchaseDate,Product,Price\n"
CUSTOMERS = "Id,FirstName,LastName,Email,RegistrationDate,State\n"


def test_recursive_scan_finds_day_folders_and_dates_them(spark, folder):
    put(folder, "2022-09-1/2022-09-1__sales.csv", SALES + '1,2022-09-1,TV,609$\n2,2022-09-1,TV,""\n')
    put(folder, "2022-09-12/more.csv", SALES + "3,2022-09-12,TV,\n,,,\n")
    assert csv_delivery(spark, folder, RAW_SALES, recursive=False).count() == 0
    rows = rows_of(with_delivery_date(csv_delivery(spark, folder, RAW_SALES)))
    assert rows == [
        ("1", "2022-09-1", "TV", "609$", date(2022, 9, 1)),
        ("2", "2022-09-1", "TV", None, date(2022, 9, 1)),
        ("3", "2022-09-12", "TV", None, date(2022, 9, 12)),
        (None, None, None, None, date(2022, 9, 12)),
    ]
    assert bronze.sales_bronze(csv_delivery(spark, folder, RAW_SALES)).count() == 3


def test_strict_header_refuses_reordered_columns(spark, folder):
    put(folder, "a.csv", "PurchaseDate,CustomerId,Product,Price\n2022-09-1,1,TV,5\n")
    assert csv_delivery(spark, folder, RAW_SALES).first()["CustomerId"] == "2022-09-1"
    with pytest.raises(Exception, match="header does not conform"):
        csv_delivery(spark, folder, RAW_SALES, strict_header=True).collect()


def test_malformed_lines_are_quarantined(spark, folder):
    put(folder, "a.csv", SALES + "1,2022-09-1,TV,5\n2,2022-09-1\n3,2022-09-1,TV,5,extra\n")
    sound, bad = split_malformed(csv_delivery(spark, folder, RAW_SALES, keep_malformed=True))
    assert rows_of(sound) == [("1", "2022-09-1", "TV", "5")]
    assert sorted(r["_malformed_line"] for r in bad.collect()) == ["2,2022-09-1", "3,2022-09-1,TV,5,extra"]


def test_null_tokens(spark, folder):
    put(folder, "a.csv", SALES + "1,NULL,TV,5\n")
    assert csv_delivery(spark, folder, RAW_SALES, null_value="NULL").first()["PurchaseDate"] is None


def test_json_lines_with_missing_field_and_bad_line(spark, folder):
    from strataflow.schemas import RAW_PROFILES

    put(folder, "x/a.json", json.dumps({"email": "a@x", "full_name": "Ann Lee"}) + "\nnot json\n")
    scan = json_lines(spark, folder, RAW_PROFILES, recursive=True, keep_malformed=True)
    sound, bad = split_malformed(scan)
    assert rows_of(sound) == [("a@x", "Ann Lee", None, None, None)]
    assert bad.first()["_malformed_line"] == "not json"


def test_void_columns(spark):
    df = spark.range(1).select("id", F.lit(None).alias("email"), F.lit(None).alias("other"))
    assert drop_void_columns(df).columns == ["id"]
    typed = drop_void_columns(df, GOLD_CUSTOMERS)
    assert typed.dtypes == [("id", "bigint"), ("email", "string")]


def sales(spark, *rows):
    return spark.createDataFrame(
        [(c, date.fromisoformat(d), "TV", Decimal(p)) for c, d, p in rows],
        "client_id int, purchase_date date, product_name string, price decimal(10,2)",
    )


def test_late_rows_join_their_day_and_reloads_add_nothing(spark, folder):
    overwrite_partitioned(sales(spark, (1, "2022-09-01", "1"), (2, "2022-09-02", "2")), folder, "purchase_date")
    again = sales(spark, (3, "2022-09-02", "3"))
    for _ in range(2):
        reload_days(again, folder)
    read = lambda: rows_of(spark.read.parquet(folder).select("client_id"))
    assert read() == [(1,), (2,), (3,)]
    dayless = sales(spark, (5, "2022-09-02", "5")).withColumn("purchase_date", F.lit(None).cast("date"))
    for _ in range(2):
        reload_days(dayless, folder)
        reload_days(sales(spark, (6, "2022-09-02", "6"), (6, "2022-09-02", "6")), folder)
    assert read() == [(1,), (2,), (3,), (5,), (6,), (6,)]
    overwrite_days(sales(spark, (4, "2022-09-02", "4")), folder, "purchase_date")
    assert read() == [(1,), (4,), (5,)]
    overwrite_partitioned(again, folder, "purchase_date")
    assert read() == [(3,)]


def test_a_day_delivered_again_with_corrections_is_replaced(spark, folder):
    overwrite_partitioned(sales(spark, (1, "2022-09-01", "1"), (2, "2022-09-02", "1"), (3, "2022-09-02", "3")), folder, "purchase_date")
    for _ in range(2):
        reload_days(sales(spark, (2, "2022-09-02", "2")), folder, replace=True)
    found = rows_of(spark.read.parquet(folder).selectExpr("client_id", "cast(price AS string)"))
    assert found == [(1, "1.00"), (2, "2.00")]


def test_contract_is_checked_before_anything_is_written(spark, folder):
    good = sales(spark, (1, "2022-09-01", "1"))
    overwrite(good, folder)
    bad = good.withColumn("price", F.col("price").cast("double")).withColumn("extra", F.lit(1))
    assert contract_differences(bad, SILVER_SALES) == [
        "missing column processed_at timestamp",
        "unexpected column extra int",
        "column price is double, expected decimal(10,2)",
    ]
    with pytest.raises(ContractError):
        overwrite(require_contract(bad, SILVER_SALES), folder)
    assert spark.read.parquet(folder).count() == 1


def test_contracts_may_grow_and_widen_and_nothing_else(spark, folder, database):
    declared = lambda text: spark.createDataFrame([], text).schema
    old = declared("id int, price decimal(10,2), day date")
    wider = declared("id bigint, price decimal(14,3), day date, note string")
    assert breaking_changes(old, wider) == []
    assert breaking_changes(wider, old) == [
        "column note string is gone",
        "column id was bigint, int does not hold it",
        "column price was decimal(14,3), decimal(10,2) does not hold it",
    ]
    changes = [("int", "decimal(10,0)", True), ("int", "decimal(10,2)", False), ("bigint", "double", False), ("float", "double", True)]
    changes += [("string", "int", False), ("date", "timestamp", False), ("decimal(10,2)", "decimal(11,3)", True), ("decimal(10,2)", "decimal(10,3)", False)]
    for have, want, fits in changes:
        one, two = declared(f"a {have}"), declared(f"a {want}")
        assert (breaking_changes(one, two) == []) == fits, (have, want)
    rows = spark.createDataFrame([(1, Decimal("2.50"), date(2022, 9, 1))], old)
    overwrite(rows, f"{folder}/1")
    overwrite(through_contract(rows, wider), f"{folder}/2")
    both = read_through(spark, {f"{folder}/1": old, f"{folder}/2": wider}, wider)
    assert both.schema.simpleString() == wider.simpleString()
    assert rows_of(both) == [(1, Decimal("2.500"), date(2022, 9, 1), None)] * 2
    name = f"{database}.e_{folder[-8:]}"
    replace_table(rows, name, old, f"{folder}/t", evolve=True)
    replace_table(through_contract(rows, wider), name, wider, f"{folder}/t", evolve=True)
    with pytest.raises(ContractError, match="note string is gone; column id was bigint"):
        replace_table(rows, name, old, f"{folder}/t", evolve=True)
    assert spark.table(name).columns == wider.fieldNames()


@pytest.fixture
def database(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{shared_folder(spark)}/strataflow/{DATABASE}'")
    return DATABASE


def test_tables(spark, folder, database):
    rows = sales(spark, (1, "2022-09-01", "1"), (2, "2022-09-02", "2"))
    overwrite(rows, f"{folder}/day=1")
    name = f"{database}.t_{folder[-8:]}"
    assert rows_of(attach_files(spark, name, f"{folder}/day=1", rows.schema)) == rows_of(rows)
    assert attach_files_sql(spark, "by_glob", f"{folder}/day=*").count() == 2
    assert attach_files_sql(spark, "by_tree", folder, recursive=True).columns == rows.columns
    assert preview(rows, 1).count() == 1
    assert "HashAggregate" in plan_text(spark, "SELECT client_id, count(*) FROM by_glob GROUP BY 1").first()[0]


def test_merge_moves_the_table_and_keeps_old_files(spark, folder, database):
    name = f"{database}.m_{folder[-8:]}"
    old, new = f"{folder}/old", f"{folder}/new"
    replace_table(sales(spark, (1, "2022-09-01", "1"), (2, "2022-09-02", "2")), name, location=old)
    merged = merge_into(sales(spark, (2, "2022-09-05", "9"), (3, "2022-09-03", "3")), name, "client_id", new)
    assert [(r[0], str(r[3])) for r in rows_of(merged)] == [(1, "1.00"), (2, "9.00"), (3, "3.00")]
    assert spark.read.parquet(old).count() == 2


def test_incremental_ingest_takes_each_file_once(spark, folder):
    where = {"raw": f"{folder}/raw", "bronze": f"{folder}/bronze", "checkpoint": f"{folder}/state"}
    run = lambda: ingest_new_files(
        spark, **where, schema=RAW_CUSTOMERS, shape=bronze.customers_bronze, max_files=1
    )
    put(where["raw"], "2022-08-1/a.csv", CUSTOMERS + "1,A,,a@x,2022-08-1,Ohio\n,,,,,\n")
    put(where["raw"], "2022-08-2/a.csv", CUSTOMERS + "1,A,,a@x,2022-08-1,Ohio\n2,B,,b@x,2022-08-2,\n")
    assert run() == 4
    assert run() == 0
    put(where["raw"], "2022-08-3/a.csv", CUSTOMERS + "3,C,,c@x,2022-08-3,\n")
    assert run() == 1
    got = spark.read.parquet(where["bronze"])
    assert got.count() == 4
    assert [str(r[0]) for r in got.select("delivery_date").distinct().orderBy("delivery_date").collect()] == [
        "2022-08-01",
        "2022-08-02",
        "2022-08-03",
    ]


def test_jobs_from_files_to_answer(spark, folder, database, capsys):
    raw, at = f"{folder}/raw", lambda name: f"{folder}/{name}"
    put(raw, "sales/2022-09-1/s.csv", SALES + "1,2022-09-1,TV,609$\n2,2022-09-1,TV,5\nx,2022-09-1,TV,5\n,,,\n")
    put(raw, "customers/2022-09-1/c.csv", CUSTOMERS + "1,,L,a@x,2022-8-1,\n2,F,,b@x,2022-8-1,Ohio\n")
    put(raw, "customers/2022-09-2/c.csv", CUSTOMERS + "1,,L,a@x,2022-8-1,\n2,F,,b@x,2022-8-1,Maine\n")
    profile = {"full_name": "Ann Lee", "state": "Texas", "birth_date": "2000-01-01", "phone_number": "1"}
    put(raw, "profiles/p.json", "\n".join(json.dumps({"email": e, **profile}) for e in ("a@x", "a@x", "b@x")))
    table = f"{database}.gold_{folder[-8:]}"

    def run(*argv: str) -> dict:
        return jobs.main(list(argv))

    assert run("sales-bronze", "--raw", f"{raw}/sales", "--bronze", at("bs")) == {
        "rows_in": 4,
        "rows_out": 3,
        "rows_dropped": 1,
    }
    for job, rows in (("sales", [4, 0]), ("customers", [4, 0])):
        folders = ("--raw", f"{raw}/{job}", "--bronze", at(f"new-{job}"), "--checkpoint", at(f"state-{job}"))
        assert [run(f"{job}-ingest", *folders)["rows_in"] for _ in range(2)] == rows
    assert rows_of(spark.read.parquet(at("new-sales")).drop("ingested_at")) == rows_of(
        spark.read.parquet(at("bs")).drop("ingested_at")
    )
    counts = run("sales-silver", "--bronze", at("bs"), "--silver", at("ss"))
    assert (counts["rows_in"], counts["rows_out"], counts["bad_client_id"], counts["bad_price"]) == (3, 2, 1, 0)
    assert run("sales-silver", "--bronze", at("bs"), "--silver", at("ss"), "--only-days")["rows_out"] == 2
    assert spark.read.parquet(at("ss")).count() == 2
    assert run("customers-bronze", "--raw", f"{raw}/customers", "--bronze", at("bc"))["undated"] == 0
    counts = run("customers-silver", "--bronze", at("bc"), "--silver", at("sc"))
    assert counts == {"rows_in": 4, "rows_without_key": 0, "duplicates_removed": 2, "rows_out": 2}
    merged = ("--bronze", at("bc"), "--table", f"{table}_clients")
    assert run("customers-merge", *merged, "--location", at("m1")) == {"rows": 2}
    assert run("customers-merge", *merged, "--location", at("m2"), "--since", "2022-09-02") == {"rows": 2}
    once = rows_of(spark.read.parquet(at("sc")).drop("processed_at"))
    assert rows_of(spark.table(f"{table}_clients").drop("processed_at")) == once
    counts = run("profiles-silver", "--raw", f"{raw}/profiles", "--silver", at("sp"))
    assert (counts["duplicates_removed"], counts["rows_out"]) == (1, 2)
    argv = ("--customers", at("sc"), "--profiles", at("sp"), "--table", table, "--location", at("gold"))
    assert run("customers-gold", *argv, "--as-of", "2022-09-10") == {"rows": 2, "without_birth_date": 0}
    gold_sales = ("--sales", at("ss"), "--customers", at("sc"), "--raw-profiles", f"{raw}/profiles")
    assert run("sales-gold", *gold_sales, "--gold", at("gs"))["without_profile"] == 0
    assert [tuple(r) for r in jobs.top_state_report(spark, at("ss"), table, 2).collect()] == [
        ("Maine", 1),
        ("Texas", 1),
    ]
    assert json.loads(capsys.readouterr().out.splitlines()[0])["rows_in"] == 4


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == named.rstrip("/") if named else shared_folder(spark) == shared_folder(spark)
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


class Unnamed:
    """A session whose cluster names no shared folder."""

    def __init__(self, master):
        self.sparkContext = SimpleNamespace(master=master)
        self.conf = SimpleNamespace(get=lambda key, default: default)


def test_only_a_local_master_may_do_without_a_shared_folder():
    assert shared_folder(Unnamed("local[2]")) == shared_folder(Unnamed("local[2]"))
    with pytest.raises(RuntimeError):
        shared_folder(Unnamed("yarn"))


def test_merge_without_a_table_needs_the_old_snapshot(spark, folder):
    with pytest.raises(ValueError, match="old snapshot"):
        jobs.merge_customers(spark, f"{folder}/none", "no_such_table", f"{folder}/new", since="2022-09-02")


def test_a_bronze_folder_has_one_owner(spark, folder):
    put(f"{folder}/raw", "2022-08-1/a.csv", CUSTOMERS + "1,A,,a@x,2022-08-1,Ohio\n")
    raw, batch, stream, state = (f"{folder}/{name}" for name in ("raw", "batch", "stream", "state"))
    jobs.customers_to_bronze(spark, raw, batch)
    assert jobs.ingest_customers(spark, raw, stream, state) == {"rows_in": 1}
    with pytest.raises(ValueError, match="incremental load"):
        jobs.customers_to_bronze(spark, raw, stream)
    with pytest.raises(ValueError, match="snapshot"):
        jobs.ingest_customers(spark, raw, batch, f"{folder}/other")
    for path in (batch, stream):
        assert jobs.customers_to_silver(spark, path, f"{folder}/silver")["rows_out"] == 1


def test_a_merge_reads_the_folders_of_new_dumps_only(spark, folder):
    for day in (1, 2):
        put(f"{folder}/raw", f"2022-08-{day}/a.csv", CUSTOMERS + f"{day},A,,a@x,2022-08-1,Ohio\n")
    put(f"{folder}/raw", "undated/a.csv", CUSTOMERS + "3,A,,a@x,2022-08-1,Ohio\n")
    assert jobs.customers_to_bronze(spark, f"{folder}/raw", f"{folder}/bronze")["undated"] == 1
    dumps = parquet(spark, f"{folder}/bronze", schema=BRONZE_CUSTOMERS)
    assert dumps.dtypes[-1] == ("delivery_date", "date") and dumps.where("delivery_date IS NULL").count() == 1
    new = dumps.where("delivery_date >= date'2022-08-02'")
    assert new.count() == 1 and "PartitionFilters: [isnotnull(delivery_date" in plan_of(new)


def test_malformed_lines_of_jobs_go_to_the_quarantine(spark, folder):
    put(f"{folder}/s", "2022-09-1/a.csv", SALES + "1,2022-09-1,TV,5\n2,2022-09-1\n3,2022-09-1,TV,5,extra\n")
    put(f"{folder}/c", "2022-09-1/a.csv", CUSTOMERS + "1,A,,a@x,2022-08-1,Ohio\n2\n")
    put(f"{folder}/p", "a.json", json.dumps({"email": "a@x"}) + "\nnot json\n")
    for job, raw, bad in ((jobs.sales_to_bronze, "s", 2), (jobs.customers_to_bronze, "c", 1), (jobs.profiles_to_silver, "p", 1)):
        counts = job(spark, f"{folder}/{raw}", f"{folder}/{raw}-out", f"{folder}/{raw}-bad")
        assert (counts["malformed"], counts["rows_in"], counts["rows_out"]) == (bad, 1, 1)
        assert spark.read.parquet(f"{folder}/{raw}-bad").where("_malformed_line IS NOT NULL").count() == bad


@pytest.mark.parametrize("profile", ["strict", "lenient", "normalised"])
def test_sales_of_every_profile_reach_gold(spark, folder, profile):
    put(f"{folder}/s", "2022-09-1/a.csv", SALES + "1,2022-09-01,TV,609$\n")
    put(f"{folder}/c", "2022-09-1/a.csv", CUSTOMERS + "1,A,,a@x,2022-08-1,Ohio\n")
    put(f"{folder}/p", "a.json", json.dumps({"email": "a@x", "full_name": "Ann Lee"}) + "\n")
    jobs.sales_to_bronze(spark, f"{folder}/s", f"{folder}/bs")
    jobs.sales_to_silver(spark, f"{folder}/bs", f"{folder}/ss", profile)
    jobs.customers_to_bronze(spark, f"{folder}/c", f"{folder}/bc")
    jobs.customers_to_silver(spark, f"{folder}/bc", f"{folder}/sc")
    assert jobs.sales_to_gold(spark, f"{folder}/ss", f"{folder}/sc", f"{folder}/p", f"{folder}/gold")["rows"] == 1
    assert float(spark.read.parquet(f"{folder}/gold").first()["price"]) == 609


def test_external_tables_are_replaced_and_schemas_made(spark, folder, database):
    name = f"{database}.x_{folder[-8:]}"
    for k in (1, 2):
        overwrite(sales(spark, (k, "2022-09-01", "1")), f"{folder}/{k}")
        attached = attach_files(spark, name, f"{folder}/{k}", spark.read.parquet(f"{folder}/{k}").schema)
        assert [r.client_id for r in attached.collect()] == [k]
    assert spark.read.parquet(f"{folder}/1").count() == 1
    made = f"made_{folder[-8:]}".replace("-", "_")
    replace_table(sales(spark, (1, "2022-09-01", "1")), f"{made}.t", location=f"{folder}/t")
    assert spark.table(f"{made}.t").count() == 1
    spark.sql(f"DROP SCHEMA {made} CASCADE")


def test_ingest_counts_every_micro_batch(spark, folder):
    for k in range(130):
        put(f"{folder}/raw", f"2022-08-1/{k}.csv", SALES + f"{k},2022-08-1,TV,1\n")
    args = (f"{folder}/raw", f"{folder}/bronze", f"{folder}/state", RAW_SALES, bronze.sales_bronze)
    assert ingest_new_files(spark, *args, max_files=1) == 130


def test_redelivered_lines_add_nothing_within_the_time(spark, folder):
    """Across files, micro-batches and runs; a line that is new on an old day is not lost, NULL equals NULL."""
    where = {"raw": f"{folder}/raw", "bronze": f"{folder}/bronze", "checkpoint": f"{folder}/state"}
    line = (*RAW_CUSTOMERS.fieldNames(), "delivery_date")
    run = lambda within="1 hour": ingest_new_files(
        spark, **where, schema=RAW_CUSTOMERS, shape=bronze.customers_bronze, max_files=1, unique=line, within=within
    )
    ids = lambda: sorted(int(r.Id) for r in spark.read.parquet(where["bronze"]).select("Id").collect())
    put(where["raw"], "2022-08-2/a.csv", CUSTOMERS + "1,A,,,2022-08-1,\n1,A,,,2022-08-1,\n")
    put(where["raw"], "2022-08-2/b.csv", CUSTOMERS + "1,A,,,2022-08-1,\n2,B,,b@x,,\n")
    assert run() == 4 and ids() == [1, 2]
    put(where["raw"], "2022-08-2/c.csv", CUSTOMERS + "2,B,,b@x,,\n3,C,,,,\n")
    put(where["raw"], "2001-01-1/late.csv", CUSTOMERS + "1,A,,,2022-08-1,\n")  # another, much older dump
    assert run() == 3 and ids() == [1, 1, 2, 3]
    assert run() == 0 and ids() == [1, 1, 2, 3]


def test_remembered_lines_are_bounded_by_the_time(spark, folder):
    where = {"raw": f"{folder}/raw", "bronze": f"{folder}/bronze", "checkpoint": f"{folder}/state"}
    kept = []
    for k in range(4):
        put(where["raw"], f"2022-08-2/{k}.csv", CUSTOMERS + f"7,G,,,,\n{k},A,,,,\n")
        ingest_new_files(
            spark, **where, schema=RAW_CUSTOMERS, shape=bronze.customers_bronze, unique=("Id",), within="1 second"
        )
        kept.append(spark.read.format("statestore").load(where["checkpoint"]).count())
        time.sleep(1.5)
    assert max(kept) <= 4  # lines of two runs at most, of five ids in all
    again = spark.read.parquet(where["bronze"]).where("Id = '7'").count()
    assert 2 <= again <= 4  # taken again when it is no longer remembered


def rows_scanned(df) -> int:
    """Rows that the file scan of ``df`` hands on, before any filter."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_days_sorted_by_client_skip_row_groups(spark, folder):
    rows = spark.range(200_000, numPartitions=4).selectExpr(
        "date_add(date'2022-09-01', cast(id % 2 AS int)) AS purchase_date",
        "cast(xxhash64(id) % 20000 * 2 AS int) AS client_id",
        "cast(id AS string) AS product_name",
    )
    rows = rows.unionByName(spark.sql("SELECT date'2022-09-01' AS purchase_date, cast(null AS int) AS client_id, 'x' AS product_name"))
    overwrite_days_sorted(rows, f"{folder}/sorted", "purchase_date", "client_id", row_group=64 << 10)
    overwrite_days(rows, f"{folder}/plain", "purchase_date")
    got, plain = spark.read.parquet(f"{folder}/sorted"), spark.read.parquet(f"{folder}/plain")
    assert got.count() == 200_001 and got.where("client_id IS NULL").count() == 1
    client = got.where("client_id > 0").agg(F.min("client_id")).first()[0]  # in the middle of the bounds
    one = got.where(F.col("client_id") == client)
    assert rows_of(one.select("product_name")) == rows_of(plain.where(F.col("client_id") == client).select("product_name"))
    few, many = rows_scanned(one), rows_scanned(plain.where(F.col("client_id") == client))
    print(f"rows read: {few} sorted, {many} unsorted")
    assert 0 < few * 5 < many
    assert rows_scanned(got.where(F.col("client_id") == 1)) == 0  # within the bounds, but no client has an odd id
    # A day that is written again replaces the day and leaves the other as it is.
    overwrite_days_sorted(rows.where("purchase_date = date'2022-09-01'").limit(5), f"{folder}/sorted", "purchase_date", "client_id")
    assert spark.read.parquet(f"{folder}/sorted").count() == 100_005


def counting(spark, df):
    """``df`` with a column computed by a function that counts its rows, and the counter."""
    seen = spark.sparkContext.accumulator(0)
    tick = F.udf(lambda x: seen.add(1) or x, "int").asNondeterministic()
    return df.withColumn("client_id", tick("client_id")), seen


@pytest.mark.parametrize("name", ["k2_corrected_days", "k2_idempotent_reload", "b3_dynamic_partition_overwrite"])
def test_sales_are_derived_once_for_all_their_loads(spark, monkeypatch, name):
    days = ("1996-02-29", "1996-03-01", "1996-03-31", "1996-04-01", "1997-05-06", "1999-01-01")
    known = sales(spark, *[(i, day, f"{i}.50") for i, day in enumerate(days * 3)])
    derived, seen = counting(spark, known)
    monkeypatch.setattr(registry, "Layers", lambda spark, folder: SimpleNamespace(spark=spark, sales=derived))
    got = registry.QUERIES[name](spark, "unused")
    expected = known
    if name.startswith("b3"):
        expected = known.withColumn("price", F.expr("cast(price + if(year(purchase_date) = 1997, 1, 0) AS decimal(10,2))"))
    assert rows_of(got.select(*known.columns)) == rows_of(expected)
    assert seen.value == known.count()


@pytest.mark.parametrize("replace", [False, True])
def test_the_summary_derives_a_delivery_once(spark, folder, replace):
    table, path = f"{folder}/sales", f"{folder}/summary"
    overwrite_partitioned(sales(spark, (1, "2022-09-01", "1")), table, "purchase_date")
    summary.build_summary(spark.read.parquet(table), path)
    late, seen = counting(spark, sales(spark, (2, "2022-09-01", "2"), (3, "2022-10-01", "3")))
    (summary.replace_sales if replace else summary.add_sales)(late, table, path)
    assert rows_of(summary.stored_summary(spark, path).select("client_id")) == [(1,), (2,), (3,)][replace:]
    assert seen.value == 2


def test_added_days_read_no_other_days(spark, folder):
    dayless = sales(spark, (5, "2022-09-02", "5")).withColumn("purchase_date", F.lit(None).cast("date"))
    overwrite_partitioned(sales(spark, (1, "2022-09-01", "1")).unionByName(dayless), folder, "purchase_date")
    put(folder, "purchase_date=2022-09-02/broken.parquet", "no reader gets past this")
    new = sales(spark, (1, "2022-09-01", "1"), (2, "2022-09-01", "2"), (3, "2022-09-03", "3")).unionByName(dayless)
    reload_days(new, folder)
    left = spark.read.schema(new.schema).parquet(folder).where("coalesce(purchase_date <> '2022-09-02', true)")
    assert rows_of(left.select("client_id")) == [(1,), (2,), (3,), (5,)]
