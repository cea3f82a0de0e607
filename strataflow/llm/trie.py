"""The prefix trie of conversations: a node for each distinct sequence of first turns.

Turns are laid out in order by range partitions, so one conversation may fill many tasks. A prefix is told by
running sums of two 64-bit hashes of turn and place, held as four 32-bit sums: 128 bits, and never a list of
turns. Texts are read once and never shuffled; what moves are digests and lengths. What a node gathers from
below comes by centroid decomposition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .centroids import subtree_sums
from .common import running

PARTS = ["h1", "h2", "h3", "h4"]
CHUNK_BITS = 12  # ids of a stretch of 4,096 numbers are joined to one text


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, place, digest, points``: the turns of each conversation in order, from place 0.

    The order is that of ``turn``, nulls first; turns that tie are ordered by the digest of role and text, so that
    only equal ones may change places. A null role or text is an empty one. Rows without a conversation belong to
    none and are left out.
    """
    part = lambda name: F.md5(F.coalesce(F.col(f"`{name}`"), F.lit("")).cast("binary"))
    rows = conversations.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.md5(F.concat(part(role), part(text)).cast("binary")).alias("digest"),
        F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("long").alias("points"),
        F.spark_partition_id().alias("read_by"),  # equal turns of one conversation may part
    )
    placed = running(rows, ["turn", "digest", "read_by"], {}, group="conv_id")
    return staged(placed.select("conv_id", F.col("position").alias("place"), "digest", "points"), "turns")


def _hashes() -> list[Column]:
    """Four 32-bit parts of two 64-bit hashes of a turn and its place."""
    whole = [F.xxhash64(F.lit(salt), "depth", "digest") for salt in (1, 2)]
    low = [h.bitwiseAND(F.lit(0xFFFFFFFF)) for h in whole]
    high = [F.shiftrightunsigned(h, 32) for h in whole]
    return [column.alias(name) for column, name in zip([*low, *high], PARTS, strict=True)]


def trie(laid: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and paths, both staged, of conversations given by their turns.

    ``laid``: ``conv_id, depth`` (from 1, without gaps), ``digest, points``. ``members``: ``conv_id, n_turns``, each
    conversation once, also those without turns. Paths: ``path`` (the conversation), ``depth, node`` (least member of
    the node there), ``above`` (that of the node above, null at the top), ``n_turns``. Nodes: ``path`` (least member),
    ``depth, above, n_convs, points`` (of the last turn), ``weight`` (turns below, its own included, summed over
    the members), ``top``.
    """
    first = members.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").alias("digest"), F.lit(0).cast("long").alias("points"))
    every = laid.unionByName(first).select("conv_id", "depth", "points", *_hashes())
    # An empty prefix is the same for all, so the sums of place 0 may stay in.
    summed = running(staged(every, "laid"), ["depth"], {f"s_{name}": name for name in PARTS}, group="conv_id")
    keys = [(F.col(f"s_{name}") + F.col(name)).alias(name) for name in PARTS]
    known = summed.select("conv_id", "depth", "points", *keys).join(members, "conv_id")
    known = staged(known, "prefixes")
    here = known.groupBy("depth", *PARTS).agg(
        F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.first("points").alias("points"),
        F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight"),
    )
    here = staged(here, "nodes")
    paths = known.select(F.col("conv_id").alias("path"), "depth", "n_turns", *PARTS).join(here.select("depth", "node", *PARTS), ["depth", *PARTS])
    paths = staged(paths.select("path", "depth", "node", "n_turns"), "paths")
    above = paths.select("path", (F.col("depth") + 1).alias("depth"), F.col("node").alias("above"))
    paths = staged(paths.join(above, ["path", "depth"], "left"), "paths")
    own = paths.where("path = node").select("path", "depth", "above")
    top = members.agg(F.min("conv_id")).first()[0]
    nodes = here.withColumnRenamed("node", "path").drop(*PARTS).join(own, ["path", "depth"])
    return staged(nodes.withColumn("top", F.lit(top).cast("long")), "nodes"), paths


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the texts of each node, joined by commas; rows come sorted by node and stretch."""
    names = ["path", "depth", "ends_sha256"]
    node, digest = None, None
    for batch in batches:
        done = []
        for path, depth, text in zip(*(batch.column(name).to_pylist() for name in ("path", "depth", "ids")), strict=True):
            if (path, depth) != node:
                if node:
                    done.append((*node, digest.hexdigest()))
                node, digest = (path, depth), hashlib.sha256(text.encode())
            else:
                digest.update(b"," + text.encode())
        if done:
            yield pa.RecordBatch.from_pydict(dict(zip(names, zip(*done, strict=True), strict=True)))
    if node:
        yield pa.RecordBatch.from_pydict(dict(zip(names, ([x] for x in (*node, digest.hexdigest())), strict=True)))


def ends(paths: DataFrame) -> DataFrame:
    """``path, depth, ends_sha256`` of nodes at which conversations end: their ids, ascending.

    Ids are first joined by stretches of numbers, so a node at which a third of all conversations end reaches its
    one digest as a stream of long texts.
    """
    over = paths.where("depth = n_turns").select(F.col("node").alias("path"), "depth", F.col("path").alias("conv_id"))
    stretch = F.shiftright("conv_id", CHUNK_BITS).alias("stretch")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    joined = over.groupBy("path", "depth", stretch).agg(ids)
    ordered = joined.repartition("path", "depth").sortWithinPartitions("path", "depth", "stretch")
    return ordered.mapInArrow(_digests, "path long, depth long, ends_sha256 string")


def measured(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """A row for each node, with its children, leaves, saved tokens and the digest of the ids that end at it."""
    children = nodes.where("depth > 0").groupBy(F.col("above").alias("path"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["path", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = nodes.withColumns({
        "n_leaves": (F.col("n_children") == 0).cast("long"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("points"),
    })
    nodes = staged(nodes, "nodes")
    values = ["n_leaves", "saved_tokens"]
    sums = subtree_sums(nodes.select("path", "depth", "weight", "top", *values), paths.select("path", "depth", "node", "above"), values)
    found = nodes.select("path", "depth", "above", "n_convs", "n_children").join(sums, ["path", "depth"])
    found = found.join(ends(paths), ["path", "depth"], "left")
    return found.select(
        F.col("path").alias("conv_id"), "depth", F.col("above").alias("parent_conv_id"), "n_convs", "n_children", *values,
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of ``conversations`` as they are: see ``turns`` for their order and ``measured`` for the columns.

    A node is named by its smallest member and its depth. Null, repeated and tied turns count as ``turns`` says,
    texts are counted whole, in code points. Other columns are not read. An empty table gives no rows.
    """
    placed = turns(conversations)
    members = staged(placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns")), "members")
    if members.isEmpty():
        return _nothing(conversations)
    return measured(*trie(placed.withColumn("depth", F.col("place") + 1).drop("place"), members))


def _nothing(conversations: DataFrame) -> DataFrame:
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return conversations.sparkSession.createDataFrame([], ", ".join(f"{n} long" for n in names) + ", ends_sha256 string")


def shared_heads(placed: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """``laid`` and ``members`` of conversations that are rebuilt on a common beginning.

    Conversation c begins with the first h turns of conversation c - c % ``block`` (remainders as in SQL), all where it
    has fewer, none where there is no such conversation; its own turns after its first h follow. h is the CRC-32 of
    the decimal id modulo ``most``.
    """
    convs = placed.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    convs = staged(convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % block), "conversations")
    bases = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("n_base"))
    members = convs.join(bases, "base", "left")
    members = members.withColumn("lent", F.least("h", F.coalesce("n_base", F.lit(0).cast("long"))))
    members = staged(members.withColumn("n_turns", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "members")
    first = placed.where((F.col("place") < most - 1) & (F.col("conv_id") % block == 0)).withColumnRenamed("conv_id", "base")
    heads = first.join(members.select("conv_id", "base", "lent"), "base").where("place < lent")
    heads = heads.select("conv_id", (F.col("place") + 1).alias("depth"), "digest", "points")
    rest = placed.join(members.select("conv_id", "h", "lent"), "conv_id").where("place >= h")
    rest = rest.select("conv_id", (F.col("place") - F.col("h") + F.col("lent") + 1).alias("depth"), "digest", "points")
    return heads.unionByName(rest), members.select("conv_id", "n_turns")


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """``prefix_trie`` of the conversations as ``shared_heads`` rebuilds them."""
    laid, members = shared_heads(turns(conversations))
    return _nothing(conversations) if members.isEmpty() else measured(*trie(laid, members))
