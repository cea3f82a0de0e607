"""Near-duplicate groups by SimHash fingerprints, compared exactly tile by tile.

Fingerprints differ in at least as many bits as their population counts do, taken part by part and added up.
So fingerprints are laid into buckets by the counts of their parts, large buckets are cut into tiles, and a pair
of tiles is skipped where the counts of its buckets differ by more than the radius. What is left is compared in
full, with numpy's exclusive-or and bit counts. A task holds a tile and one tile of each bucket around it. It
gives links that join up what it found, not all pairs, so a dense group costs no more rows than a sparse one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import text_batches, unused, without_ids
from .components import components

SEED = 42
TILE = 4096  # fingerprints in a tile, as the mean over the tiles of its bucket
ROWS = 64  # of a tile held against another at a time, so that the matrix stays in the cache
GROUPS = 16  # pairs of tiles with those around them that a task compares, as the mean over many
BLOCK = 1 << 16  # hashes whose bits are counted at a time

# Fingerprints up to which so many parts do: with more parts more pairs are skipped, and more copies are dealt out.
PARTS = ((1 << 20, 2), (1 << 27, 4))
MOST_PARTS = 8


def fingerprint(words: list[bytes], width: int) -> int:
    """Bits that are set in over half of the hashes of all shingles; 0 without words."""
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(word) + 1 for word in words))
    width = min(width, len(words))
    starts = [0, *ends[: len(words) - width]]
    spans = zip(starts, ends[width - 1 :], strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a : b - 1], SEED) for a, b in spans), dtype="<u8", count=len(starts))
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = hashes[i : i + BLOCK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes)).view("<u8")[0])


def _fingerprint_udf(width: int):
    @F.arrow_udf("bigint")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [fingerprint(text.lower().split(), width) for text in batch.to_pylist()]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return prints


def fingerprints(text: Column, width: int = 3) -> Column:
    """SimHash of a text column as a long: words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, ``width`` to a shingle."""
    return _fingerprint_udf(width)(F.coalesce(text, F.lit("")).cast("binary"))


def _bucket(bits: Column, parts: int, radius: int) -> Column:
    """Population counts of the parts as the digits of one number; digits within the radius never carry."""
    size = 64 // parts
    base = size + 1 + 2 * radius
    key = F.lit(0).cast("long")
    for k in range(parts):
        part = F.shiftrightunsigned(bits, k * size).bitwiseAND(F.lit((1 << size) - 1 if size < 64 else -1))
        key = key * base + F.bit_count(part) + radius
    return key


def _steps(parts: int, radius: int) -> list[int]:
    """Differences of bucket numbers, 0 and above, whose counts differ by ``radius`` in all at most."""
    base = 64 // parts + 1 + 2 * radius
    found = [0]
    vectors = [()]
    for _ in range(parts):
        vectors = [(*v, d) for v, d in product(vectors, range(-radius, radius + 1)) if sum(map(abs, v)) + abs(d) <= radius]
    for vector in vectors:
        step = 0
        for digit in vector:
            step = step * base + digit
        if step > 0:
            found.append(step)
    return sorted(found)


def joined_within(home: np.ndarray, guests: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links between ``home`` and ``guests`` (uint64) that join up all pairs within the radius."""
    every, labels = np.unique(np.concatenate([home, guests]), return_inverse=True)
    root = np.arange(len(every))
    rows, columns = labels[: len(home)], labels[len(home) :]
    links: list[tuple[int, int]] = []
    for i in range(0, len(home), ROWS):
        bits = np.bitwise_count(home[i : i + ROWS, None] ^ guests[None, :])
        u, v = np.nonzero(bits <= radius)
        u, v = rows[i : i + ROWS][u], columns[v]
        apart = root[u] != root[v]
        if not apart.any():
            continue
        u, v = u[apart], v[apart]
        _, first = np.unique(root[u] * len(every) + root[v], return_index=True)
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        for a, b in zip(u[first].tolist(), v[first].tolist(), strict=True):
            low, high = sorted((top(int(root[a])), top(int(root[b]))))
            if low != high:
                up[high] = low
                links.append((a, b))
        moved = np.arange(len(every))
        for x in up:
            moved[x] = top(x)
        root = moved[root]
    signed = every.view(np.int64)
    return [(int(signed[a]), int(signed[b])) for a, b in links]


def _compare(radius: int):
    def compare(group: pd.DataFrame) -> pd.DataFrame:
        bits, guest = group["bits"].to_numpy().astype(np.int64).view(np.uint64), group["guest"].to_numpy()
        links = joined_within(bits[~guest], bits[guest], radius)
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return compare


def links(distinct: DataFrame, radius: int = 2, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """``u, v``: links that join up all ``bits`` (distinct longs, staged) at most ``radius`` bits apart.

    ``parts`` divides 64. Without it the number of fingerprints decides; the result is the same.
    """
    parts = parts or next((p for most, p in PARTS if distinct.count() <= most), MOST_PARTS)
    keyed = distinct.select("bits", _bucket(F.col("bits"), parts, radius).alias("bucket"))
    tiles = F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")
    buckets = staged(keyed.groupBy("bucket").agg(tiles), "buckets")
    steps = F.explode(F.array(*[F.lit(step).cast("long") for step in _steps(parts, radius)]))
    around = buckets.select(F.col("bucket").alias("home"), F.col("tiles").alias("own"), steps.alias("step"))
    around = around.select("home", "own", (F.col("home") + F.col("step")).alias("bucket")).join(buckets, "bucket")
    around = staged(around, "around")
    widest = around.groupBy(F.col("home").alias("bucket")).agg(F.max("tiles").alias("widest"))

    def numbers(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    placed = keyed.join(buckets, "bucket").withColumn("tile", F.pmod(F.xxhash64("bits"), "tiles").cast("int")).drop("tiles")
    placed = staged(placed, "placed")
    # The tile itself once for each set of guests: one tile of each bucket around it.
    own = placed.join(widest, "bucket").select(
        F.col("bucket").alias("home"), F.col("tile").alias("own_tile"), numbers("widest").alias("their_tile"),
        "bits", F.lit(False).alias("guest"),
    )
    guests = placed.join(around.drop("tiles"), "bucket").select(
        "home", numbers("own").alias("own_tile"), F.col("tile").alias("their_tile"), "bits", F.lit(True).alias("guest"), "bucket"
    )
    guests = guests.where("home <> bucket OR own_tile <= their_tile").drop("bucket")
    # The work is in the pairs, not in the bytes that runtime re-planning would go by: tasks by their groups.
    groups = buckets.join(widest, "bucket").agg(F.sum(F.col("tiles").cast("long") * F.col("widest"))).first()[0] or 0
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(groups // GROUPS, 100_000))
    key = ["home", "own_tile", "their_tile"]
    dealt = own.unionByName(guests).repartition(tasks, *key).groupBy(*key)
    return dealt.applyInPandas(_compare(radius), "u long, v long")


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, parts: int | None = None
) -> DataFrame:
    """For each row: ``doc_id, fingerprint, component_id``.

    Texts are linked when their fingerprints (long, its bits unsigned) differ in ``radius`` bits at most. Null
    texts and texts without words have the fingerprint 0 and are linked like any other; with fewer words than
    ``width`` the whole sequence is the one shingle. The component is the smallest id reachable, so ties need no
    rule. Rows that repeat an id each have their own fingerprint. Rows without an id link others and take the
    component of their group, null where none of it has an id. An empty table gives no rows. Other columns are
    not read.
    """
    text_batches(docs.sparkSession)
    prints = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), fingerprints(F.col(f"`{text_col}`"), width).alias("bits"))
    prints = staged(prints, "fingerprints")
    classes = staged(prints.groupBy("bits").agg(F.min("doc_id").alias("doc_id")), "classes")
    labels = components(staged(links(classes.select("bits"), radius, parts), "links"))
    rooted = classes.join(labels.withColumnRenamed("node", "bits"), "bits", "left").withColumn("root", F.coalesce("root", "bits"))
    rooted = staged(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    found = rooted.select("bits", "root").join(least, "root").select("bits", "component_id")
    return prints.join(found, "bits").select("doc_id", F.col("bits").alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each group, the one with the smallest id, rows without an id last.

    Rows are told apart by a mark of their own, so rows that repeat an id or have none count each.
    """
    mark = unused(docs.columns, "row")
    marked = staged(docs.withColumn(mark, F.monotonically_increasing_id()), "marked")
    found = groups(marked, mark, text_col, width, radius).select(F.col("doc_id").alias("node"), "component_id")
    found = staged(found.join(marked.select(F.col(mark).alias("node"), F.col(f"`{id_col}`").alias("id")), "node"), "grouped")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("kept"))
    dropped = found.select("node").join(first.select("kept.node"), "node", "left_anti")
    left = without_ids(marked, staged(dropped.select(F.col("node").alias(mark)), "dropped"), mark)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
