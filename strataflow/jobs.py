"""The layer steps as jobs: read, shape, write once, and report row counts of that one pass.

    spark-submit --py-files strataflow.zip run_job.py sales-bronze --raw RAW --bronze BRONZE
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import functions as fn
from .operators.dedup import upsert
from .operators.quality import observed, sales_quality
from .plans import analytics, bronze, gold, silver, summary
from .schemas import (
    BRONZE_CUSTOMERS,
    BRONZE_SALES,
    GOLD_CUSTOMERS,
    GOLD_SALES,
    GOLD_SALES_DOUBLE,
    RAW_CUSTOMERS,
    RAW_PROFILES,
    RAW_SALES,
    SILVER_CUSTOMERS,
    SILVER_PROFILES,
    SILVER_SALES,
    require_contract,
)
from .session import session
from .sinks import add_to_days, create_bucketed, is_bucketed, merge_buckets, merge_into, overwrite, overwrite_days
from .sinks import overwrite_partitioned, replace_table, stored_rows
from .sources import csv_delivery, json_lines, parquet, split_malformed, with_delivery_date
from .streaming import ingest_new_files

Counts = dict[str, int]


def _set_aside(scan: DataFrame, quarantine: str | None) -> tuple[DataFrame, Counts]:
    """Sound lines, after the others are written to ``quarantine`` with their text.

    Without a quarantine all lines go on, short ones padded and long ones cut.
    """
    if not quarantine:
        return scan, {}
    sound, bad = split_malformed(scan)
    bad, seen = observed(bad, "malformed")
    overwrite(bad, quarantine)
    return sound, {"malformed": seen.get["rows"]}


def sales_to_bronze(spark: SparkSession, raw: str, bronze_path: str, quarantine: str | None = None) -> Counts:
    scan, malformed = _set_aside(csv_delivery(spark, raw, RAW_SALES, keep_malformed=bool(quarantine)), quarantine)
    read, rows_in = observed(scan, "read")
    kept, rows_out = observed(require_contract(bronze.sales_bronze(read), BRONZE_SALES), "kept")
    overwrite(kept, bronze_path)
    return _dropped(rows_in.get["rows"], rows_out.get["rows"]) | malformed


def customers_to_bronze(spark: SparkSession, raw: str, bronze_path: str, quarantine: str | None = None) -> Counts:
    """One folder for each delivery date, so that a merge reads the new dumps only."""
    scan = with_delivery_date(csv_delivery(spark, raw, RAW_CUSTOMERS, keep_malformed=bool(quarantine)))
    scan, malformed = _set_aside(scan, quarantine)
    read, rows_in = observed(scan, "read", undated=F.col("delivery_date").isNull())
    kept, rows_out = observed(require_contract(bronze.customers_bronze(read), BRONZE_CUSTOMERS), "kept")
    overwrite(kept, bronze_path, "delivery_date")
    return _dropped(rows_in.get["rows"], rows_out.get["rows"]) | {"undated": rows_in.get["undated"]} | malformed


def sales_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    profile: str = "strict",
    only_days: bool = False,
    replace_days: bool = False,
    summary_path: str | None = None,
) -> Counts:
    """Rebuild the table; with ``only_days`` add the rows that it lacks to their days; with ``replace_days`` let the
    days of this bronze folder take the place of what the table has for them, so that corrections count.

    ``summary_path`` is a summary by client, product and day that is brought up to date with what was written.
    """
    if only_days and replace_days:
        raise ValueError("days are added to or replaced, not both")
    raw = parquet(spark, bronze_path)
    typed, seen = observed(
        silver.sales_typed(raw, profile),
        "typed",
        bad_client_id=F.col("client_id").isNull(),
        bad_purchase_date=F.col("purchase_date").isNull(),
        bad_price=F.col("price").isNull(),
    )
    kept, rows_out = observed(silver.usable_sales(typed, profile), "kept")
    stamped = kept.withColumn("processed_at", F.current_timestamp())
    if profile == "strict":
        stamped = require_contract(stamped, SILVER_SALES)
    if only_days:
        add_to_days(stamped, silver_path, "purchase_date", stamps=("processed_at",))
    elif replace_days:
        overwrite_days(stamped, silver_path, "purchase_date")
    else:
        overwrite_partitioned(stamped, silver_path, "purchase_date")
    if summary_path and (only_days or replace_days):
        summary.refresh_months(spark, silver_path, summary_path, silver.usable_sales(silver.sales_typed(raw, profile), profile))
    elif summary_path:
        summary.build_summary(parquet(spark, silver_path), summary_path)
    counts = dict(seen.get)
    if counts["rows"] != stored_rows(spark, bronze_path):
        # Some task of the pass ran twice, so what it observed counts twice.
        exact = silver.sales_typed(raw, profile)
        counts = sales_quality(exact).drop("rows_out", "rows_dropped").withColumnRenamed("rows_in", "rows").first().asDict()
        out = silver.usable_sales(exact, profile).count()
    else:
        out = rows_out.get["rows"]
    causes = {name: value for name, value in counts.items() if name != "rows"}
    return _dropped(counts["rows"], out) | causes


def customers_to_silver(spark: SparkSession, bronze_path: str, silver_path: str) -> Counts:
    raw, seen = observed(
        parquet(spark, bronze_path, schema=BRONZE_CUSTOMERS), "read", bad_client_id=fn.whole_number(F.col("Id")).isNull()
    )
    kept, rows_out = observed(require_contract(silver.customers_silver(raw), SILVER_CUSTOMERS), "kept")
    overwrite(kept, silver_path)
    return _deduplicated(seen.get["rows"], seen.get["bad_client_id"], rows_out.get["rows"])


def merge_customers(
    spark: SparkSession,
    bronze_path: str,
    table: str,
    location: str,
    since: str | None = None,
    old: str | None = None,
    buckets: int | None = None,
) -> Counts:
    """Bring a silver customer table up to date with the dumps delivered from ``since`` on.

    Reads the new dumps and the table instead of every dump ever delivered. ``location`` is a new
    folder for the merged rows. ``old`` names the folder of the snapshot to merge into, for processes
    whose catalog doesn't know the table. Without either, only all dumps make a whole table, so
    ``since`` is refused. With ``buckets`` a new table is cut by the hash of its key; a merge into such a
    table reads and writes only the buckets that the dumps fall into, below the folder the table was made with.
    """
    known = old is None and spark.catalog.tableExists(table)
    if since and not old and not known:
        raise ValueError(f"no table {table} to merge into; give the old snapshot, or all deliveries")
    dumps = parquet(spark, bronze_path, schema=BRONZE_CUSTOMERS)
    if since:
        dumps = dumps.where(F.col("delivery_date") >= F.lit(since).cast("date"))
    newest, counts = observed(require_contract(silver.customers_silver(dumps), SILVER_CUSTOMERS), "newest")
    if known and is_bucketed(spark, table):
        merge_buckets(newest, table)
    elif known:
        merge_into(newest, table, "client_id", location)
    elif buckets:
        rows = upsert(parquet(spark, old), newest, "client_id") if old else newest
        create_bucketed(rows, table, "client_id", location, buckets, SILVER_CUSTOMERS)
    elif old:
        replace_table(upsert(parquet(spark, old), newest, "client_id"), table, SILVER_CUSTOMERS, location)
    else:
        replace_table(newest, table, SILVER_CUSTOMERS, location)
    return dict(counts.get)


def profiles_to_silver(spark: SparkSession, raw: str, silver_path: str, quarantine: str | None = None) -> Counts:
    scan, malformed = _set_aside(json_lines(spark, raw, RAW_PROFILES, keep_malformed=bool(quarantine)), quarantine)
    read, seen = observed(scan, "read", no_email=F.col("email").isNull())
    kept, rows_out = observed(require_contract(silver.profiles_silver(read), SILVER_PROFILES), "kept")
    overwrite(kept, silver_path)
    return _deduplicated(seen.get["rows"], seen.get["no_email"], rows_out.get["rows"]) | malformed


def customers_to_gold(
    spark: SparkSession,
    customers: str,
    profiles: str,
    table: str,
    location: str | None = None,
    as_of: str | None = None,
) -> Counts:
    day = F.lit(as_of).cast("date") if as_of else F.current_date()
    rows = gold.enrich_customers(parquet(spark, customers), parquet(spark, profiles), as_of=day)
    kept, counts = observed(rows, "gold", without_birth_date=F.col("birth_date").isNull())
    replace_table(kept, table, GOLD_CUSTOMERS, location)
    return dict(counts.get)


def sales_to_gold(spark: SparkSession, sales: str, customers: str, raw_profiles: str, gold_path: str) -> Counts:
    """Every sale with its buyer; the profiles are read raw because their full names are kept.

    Prices stay as the profile of silver sales reads them, decimal or double.
    """
    profiles = silver.profiles_distinct(json_lines(spark, raw_profiles, RAW_PROFILES))
    rows = gold.sales_enriched(parquet(spark, sales), parquet(spark, customers), profiles)
    contract = GOLD_SALES_DOUBLE if dict(rows.dtypes)["price"] == "double" else GOLD_SALES
    kept, counts = observed(
        require_contract(rows, contract), "gold", without_profile=F.col("full_name").isNull()
    )
    overwrite_partitioned(kept, gold_path, "purchase_date")
    return dict(counts.get)


def ingest_sales(spark: SparkSession, raw: str, bronze_path: str, checkpoint: str) -> Counts:
    """Only files that no earlier run has taken; the batch job above rebuilds everything."""
    return {"rows_in": ingest_new_files(spark, raw, bronze_path, checkpoint, RAW_SALES, bronze.sales_bronze)}


def ingest_customers(
    spark: SparkSession, raw: str, bronze_path: str, checkpoint: str, unique_within: str | None = None
) -> Counts:
    """New dumps only. With ``unique_within`` a line of a dump that is delivered again within that time adds nothing."""
    line = (*RAW_CUSTOMERS.fieldNames(), "delivery_date")
    again = {"unique": line, "within": unique_within} if unique_within else {}
    rows = ingest_new_files(
        spark, raw, bronze_path, checkpoint, RAW_CUSTOMERS, bronze.customers_bronze, folders=("delivery_date",), **again
    )
    return {"rows_in": rows}


def top_state_report(spark: SparkSession, sales: str, table: str, k: int = 1, of_summary: bool = False) -> DataFrame:
    return analytics.top_state(parquet(spark, sales), spark.table(table), k=k, orders="orders" if of_summary else None)


def top_state(spark: SparkSession, sales: str, table: str, k: int = 1, of_summary: bool = False) -> dict:
    """The last question of the chain, as a job: the first ``k`` states with their counts.

    With ``of_summary`` the folder ``sales`` is a summary by client, product and day.
    """
    return {"top": [row.asDict() for row in top_state_report(spark, sales, table, k, of_summary).take(k)]}


def _dropped(rows_in: int, rows_out: int) -> Counts:
    return {"rows_in": rows_in, "rows_out": rows_out, "rows_dropped": rows_in - rows_out}


def _deduplicated(rows_in: int, without_key: int, rows_out: int) -> Counts:
    return {
        "rows_in": rows_in,
        "rows_without_key": without_key,
        "duplicates_removed": rows_in - without_key - rows_out,
        "rows_out": rows_out,
    }


# Job name -> function and the names of its path arguments, in call order.
JOBS = {
    "sales-bronze": (sales_to_bronze, ("raw", "bronze")),
    "sales-silver": (sales_to_silver, ("bronze", "silver")),
    "customers-bronze": (customers_to_bronze, ("raw", "bronze")),
    "customers-silver": (customers_to_silver, ("bronze", "silver")),
    "customers-merge": (merge_customers, ("bronze", "table", "location")),
    "profiles-silver": (profiles_to_silver, ("raw", "silver")),
    "customers-gold": (customers_to_gold, ("customers", "profiles", "table")),
    "sales-gold": (sales_to_gold, ("sales", "customers", "raw-profiles", "gold")),
    "top-state": (top_state, ("sales", "table")),
    "sales-ingest": (ingest_sales, ("raw", "bronze", "checkpoint")),
    "customers-ingest": (ingest_customers, ("raw", "bronze", "checkpoint")),
}


def main(argv: list[str] | None = None) -> Counts:
    parser = argparse.ArgumentParser(prog="strataflow.jobs")
    commands = parser.add_subparsers(dest="job", required=True)
    for job, (_, paths) in JOBS.items():
        command = commands.add_parser(job)
        for path in paths:
            command.add_argument(f"--{path}", required=True)
    commands.choices["sales-silver"].add_argument(
        "--profile", choices=("strict", "lenient", "normalised"), default="strict"
    )
    commands.choices["sales-silver"].add_argument("--only-days", action="store_true")
    commands.choices["sales-silver"].add_argument("--replace-days", action="store_true")
    commands.choices["sales-silver"].add_argument("--summary", dest="summary_path")
    for job in ("sales-bronze", "customers-bronze", "profiles-silver"):
        commands.choices[job].add_argument("--quarantine")
    commands.choices["customers-merge"].add_argument("--since")
    commands.choices["customers-merge"].add_argument("--old")
    commands.choices["customers-merge"].add_argument("--buckets", type=int)
    commands.choices["top-state"].add_argument("--k", type=int, default=1)
    commands.choices["top-state"].add_argument("--of-summary", action="store_true")
    commands.choices["customers-ingest"].add_argument("--unique-within")
    commands.choices["customers-gold"].add_argument("--location")
    commands.choices["customers-gold"].add_argument("--as-of")
    given = vars(parser.parse_args(argv))
    run, paths = JOBS[given.pop("job")]
    arguments = [given.pop(path.replace("-", "_")) for path in paths]
    counts = run(session("strataflow"), *arguments, **given)
    print(json.dumps(counts, default=str))
    return counts


if __name__ == "__main__":
    main()
