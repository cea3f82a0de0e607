"""Session settings for the jobs, and the shared folder they stage data in."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Used where neither the cluster nor the caller says otherwise. Runtime re-planning sizes the
# partitions, so no partition counts are fixed here; set spark.sql.shuffle.partitions for the data.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def session(app: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """Build or join a session; names in ``conf`` have ``__`` for dots."""
    given = {key.replace("__", "."): value for key, value in conf.items()}
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in given.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    settled = spark.sparkContext.getConf()
    for key, value in DEFAULTS.items():
        if key not in given and not settled.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a master of one process may fall back to a folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="strataflow-")


@cache
def _staging(folder: str, app: str) -> str:
    """One folder per application, which the JVM deletes when it ends."""
    spark = SparkSession.active()
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/strataflow/{app}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return f"{folder}/strataflow/{app}"


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; it lasts as long as the application."""
    folder = _staging(shared_folder(spark), spark.sparkContext.applicationId)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and carry on from the files.

    Cuts the lineage and fixes non-repeatable columns (partition numbers, row marks), so a lost
    executor can only cause files to be read again. The files go when the application ends.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
