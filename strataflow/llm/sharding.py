"""Shards of near equal size by sampled splitters.

Records are ordered by a key that keeps equal texts together. A sample weighted by size gives splitters
for many ranges; ranges that turn out overfull are sampled again and subdivided. Within each range rows
are numbered and their sizes summed, so every record knows how many bytes precede it in the whole table,
and the shards are cut at equal shares of the bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import unused

RANGE_ROWS = 250_000  # rows aimed at in a range
SAMPLES = 24  # drawn for each range; 24 bytes each on the driver
ROUNDS = 8  # of subdividing


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str | None = None) -> DataFrame:
    """``doc_id, size, text_crc32`` and the key: hashes of text and id, and a row mark to part what is left.

    Staged, which fixes the mark, unless ``mark`` names a column that has one. The size is the bytes of the text and one; a null text has no bytes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return staged(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("k1"),
            F.xxhash64(F.col(id_col).cast("long")).alias("k2"),
            (F.col(mark) if mark else F.monotonically_increasing_id()).alias("row"),
        ),
        "keyed",
    )


KEY = ["k1", "k2", "row"]


def _sampled(rows: DataFrame, total: int, wanted: int, seed: int) -> np.ndarray:
    """About ``wanted`` keys, drawn with a chance in proportion to size; repeatable."""
    unit = F.pmod(F.xxhash64(*KEY, F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52))
    chosen = rows.where(unit * F.lit(float(total)) < F.col("size") * F.lit(float(wanted))).select(*KEY).toArrow()
    return np.rec.fromarrays([chosen[name].to_numpy() for name in KEY], names=",".join(KEY))


def _quantiles(keys: np.ndarray, parts: int) -> np.ndarray:
    keys = np.sort(keys, order=KEY)
    at = (np.arange(1, parts) * len(keys)) // parts
    return keys[np.unique(at[at < len(keys)])] if len(keys) else keys


def _range_of(splitters: np.ndarray):
    """Number of splitters at or below a key, by binary search over all three parts."""
    first, second, third = (np.ascontiguousarray(splitters[name]) for name in KEY)

    @F.arrow_udf("int")
    def range_of(k1: pa.Array, k2: pa.Array, row: pa.Array) -> pa.Array:
        a, b, c = k1.to_numpy(), k2.to_numpy(), row.to_numpy()
        low, high = np.searchsorted(first, a, "left"), np.searchsorted(first, a, "right")
        while (open_ := low < high).any():
            middle = np.where(open_, (low + high) // 2, 0)
            below = open_ & ((second[middle] < b) | ((second[middle] == b) & (third[middle] <= c)))
            low, high = np.where(below, middle + 1, low), np.where(open_ & ~below, middle, high)
        return pa.array(low.astype(np.int32))

    return range_of


def ranged(rows: DataFrame) -> DataFrame:
    """``rows`` with ``piece``, the number of their range; ranges follow the order of the key.

    A range twice as full as aimed at is sampled by itself and subdivided. The mark of the row is part of the key,
    so rows of one text and one id, or of none, fill as many ranges as others. The splitters are a few for each
    250,000 rows: 1 MB on the driver for 10^10 rows.
    """
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    if not total["n"]:
        return rows.withColumn("piece", F.lit(0))
    parts = max(16, -(-total["n"] // RANGE_ROWS))
    splitters = _quantiles(_sampled(rows, total["size"], parts * SAMPLES, 0), parts)
    for turn in range(1, ROUNDS):
        placed = rows.withColumn("piece", _range_of(splitters)(*KEY)) if len(splitters) else rows.withColumn("piece", F.lit(0))
        counts = placed.groupBy("piece").agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"), (F.min(F.struct(*KEY)) < F.max(F.struct(*KEY))).alias("wide")
        )
        full = counts.where(((F.col("n") > 2 * RANGE_ROWS) | (F.col("size") > 2 * total["size"] / parts)) & F.col("wide")).toArrow()
        if not full.num_rows:
            return placed
        overfull = placed.where(F.col("piece").isin(full["piece"].to_pylist()))
        size = sum(full["size"].to_pylist())
        pieces = max(2 * full.num_rows, int(2 * parts * size / total["size"]))
        more = _quantiles(_sampled(overfull, size, pieces * SAMPLES, turn), pieces)
        merged = np.unique(np.concatenate([splitters, more]))
        if len(merged) == len(splitters):
            return placed
        splitters = np.rec.fromarrays([merged[name] for name in KEY], names=",".join(KEY))
    return rows.withColumn("piece", _range_of(splitters)(*KEY))


def assigned(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    The law is ``bytes``: shards are cut where their share of all bytes is full, so each differs from an
    equal share by less than the largest record. Records of equal text follow each other and part only at
    a cut. Slots number the rows of a shard from 0. Null texts count as empty, null ids sort by the hash
    of null, repeated rows are rows each. An empty table gives no rows. Other columns are not read.
    """
    return placed(docs, shards, id_col, text_col).drop("row")


def placed(docs: DataFrame, shards: int, id_col: str, text_col: str, mark: str | None = None) -> DataFrame:
    """:func:`assigned`, and ``row``, the mark of the row."""
    rows = staged(ranged(keyed(docs, id_col, text_col, mark)), "ranged")
    inner = Window.partitionBy("piece").orderBy(*KEY)
    before = inner.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("place", F.row_number().over(inner) - 1)
    rows = rows.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    pieces = rows.groupBy("piece").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    earlier = Window.partitionBy().orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "piece",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_place"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("first_offset"),
        F.sum("bytes").over(Window.partitionBy()).alias("total"),
    )
    rows = rows.join(starts, "piece").withColumn("place", F.col("place") + F.col("first_place"))
    # The middle of a record decides, so that cuts fall on either side of it alike.
    middle = F.col("offset") + F.col("first_offset") + (F.col("size") / 2)
    shard = F.least(F.floor(middle * shards / F.col("total")), F.lit(shards - 1)).cast("int")
    rows = staged(rows.select("row", "doc_id", "size", "text_crc32", "place", shard.alias("shard")), "placed")
    firsts = rows.groupBy("shard").agg(F.min("place").alias("first"))
    return rows.join(F.broadcast(firsts), "shard").select(  # a row for each shard
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row",
    )


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as Parquet under ``path/shard=<n>/``, each shard by several tasks, in order of the slot.

    Every row is written once, with its ``slot``, rows without an id and rows that repeat one too. Where
    ``docs`` has columns of these names, underscores are added to the new ones.
    """
    mark, shard, slot = (unused(docs.columns, name) for name in ("row", "shard", "slot"))
    marked = staged(docs.withColumn(mark, F.monotonically_increasing_id()), "marked")
    places = placed(marked, shards, id_col, text_col, mark).select(
        F.col("row").alias(mark), F.col("shard").alias(shard), F.col("slot").alias(slot)
    )
    joined = marked.join(places, mark).drop(mark)
    files = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards)
    joined.repartitionByRange(files, shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
