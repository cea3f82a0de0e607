"""Silver sales summed by client, product and day: what the questions need, kept up by the months that change.

The summary lies in a folder for each month, as a day of it would be a very small file. Counts, sums and extremes
of days can be put together for any span without loss, so a question reads the summary and no sales. When sales
are added or replaced, the months of the delivery are summed anew from the stored sales and take the place of
their folders: running that again, also after a failure half way, gives the same summary.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from ..sinks import add_to_days, among, overwrite_days, overwrite_partitioned
from .analytics import PER_CLIENT_MONEY, client_totals

DAY, MONTH = "purchase_date", "purchase_month"


def client_days(sales: DataFrame) -> DataFrame:
    """``client_id, product_name, purchase_date`` with orders, revenue, priced orders and the range of prices."""
    return client_totals(sales, "product_name", DAY)


def _by_month(sales: DataFrame) -> DataFrame:
    return client_days(sales).withColumn(MONTH, F.trunc(DAY, "month"))


def build_summary(sales: DataFrame, path: str) -> None:
    overwrite_partitioned(_by_month(sales), path, MONTH)


def stored_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(MONTH)


def refresh_months(spark: SparkSession, sales: str, path: str, days: DataFrame) -> None:
    """Sum the months of ``days`` (a frame with the day column) anew from the sales stored in ``sales``.

    The scan reads the folders of the days of these months only. A month that has sales in the summary but none in
    ``sales`` any more keeps its folder.
    """
    wanted = among(F.trunc(DAY, "month"), days)
    overwrite_days(_by_month(spark.read.parquet(sales).where(wanted)), path, MONTH)


def add_sales(df: DataFrame, sales: str, path: str, stamps: tuple[str, ...] = ()) -> None:
    """Add the rows that the stored sales lack, then bring the summary of their months up to date."""
    df = staged(df, "delivery")  # the months are asked of it again
    add_to_days(df, sales, DAY, stamps)
    refresh_months(df.sparkSession, sales, path, df)


def replace_sales(df: DataFrame, sales: str, path: str) -> None:
    """Replace the stored sales of the days in ``df``, then the summary of their months."""
    df = staged(df, "delivery")
    overwrite_days(df, sales, DAY)
    refresh_months(df.sparkSession, sales, path, df)


def totals(summary: DataFrame, *also_by: str) -> DataFrame:
    """What ``client_totals`` gives for the sales, from their summary."""
    return summary.groupBy("client_id", *also_by).agg(
        F.sum("orders").alias("orders"),
        F.sum("revenue").cast(PER_CLIENT_MONEY).alias("revenue"),
        F.sum("priced").alias("priced"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )
