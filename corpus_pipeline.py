"""From raw documents to token ids, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and gives the documents that stay, with the columns of
``documents``; the last gives their ids. Stages see rows of their predecessor only.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.byte_bpe import BytePairEncoder
from strataflow.llm.exact_dedup import exact_dedup
from strataflow.llm.mixing import mixed
from strataflow.llm.near_dedup import Params, near_dedup
from strataflow.llm.quality import quality_filter
from strataflow.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, of hosts that do."""
    return quality_filter(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words to a shingle, a similarity of 0.8 or more."""
    return near_dedup(docs, p=Params(width=5))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the budget of their source draws them."""
    return mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``. An error if the ids of a text don't decode to its bytes."""
    codec = BytePairEncoder(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    text = F.coalesce("text", F.lit(""))
    coded = docs.select("doc_id", "lang", "source", text.cast("binary").alias("bytes"), codec.encode(text).alias("ids"))
    coded = coded.withColumn("decoded", codec.decode("ids"))
    wrong = F.raise_error(F.concat(F.lit("ids do not decode to the text of document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    ids = F.when(F.col("decoded") == F.col("bytes"), F.col("ids")).otherwise(wrong.cast("array<int>"))
    coded = coded.select("doc_id", "lang", "source", ids.alias("ids"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixing", mix_sources),
    ("byte bpe", token_ids),
]

#: Neither registers of sketches nor merges of bytes are SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
