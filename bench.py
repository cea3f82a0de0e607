"""Times the headline queries, the better of two runs each, and prints one JSON line.

BENCH_SF_DIR names the folder of test tables, BENCH_CPUS the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession

from strataflow.queries import QUERIES
from strataflow.session import session

HEADLINES = [
    "h1_top_state_tv_buyers",
    "h5_sales_by_state_and_age",
    "m1_sales_raw_to_bronze",
    "m2_sales_silver",
    "m4_customers_silver",
    "m5_profiles_silver",
    "m6_enrich_customers",
    "m7_sales_enriched",
    "f3_multi_key_aggregates",
    "f7_sales_quality",
    "g1_keep_latest",
    "g4_running_total",
    "g5_rank_in_group",
    "g6_previous_value",
    "b4_partitioned_by_year_month",
    "b11_upsert",
    "e2_left_join_chain",
    "e6_lookup_join",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    run(QUERIES[name](spark, folder))
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINES:
        seconds[name.split("_")[0]] = round(min(timed(spark, name, folder) for _ in range(2)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
