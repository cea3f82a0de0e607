"""Near-duplicate groups by SetSketch registers.

A register holds floor(1 - log_b(h)) of the smallest h that any shingle of a text draws from an
exponential distribution, cut off to 16 bits. Registers of a union are the maxima of the registers, and
two sets agree in a register about as often as their similarity says, so bands of registers find
candidates. The counts of greater, smaller and equal registers give the likelihood of every similarity;
pairs for which 0.8 is out of the question are left out, the others are confirmed on the full sets.

Texts with equal sets are one class from the start. Pairs of a band bucket are not listed: members are
held against the leader of their bucket. Then the members that still stand apart from the largest group
around their leader are compared in full with all others around it, part by part inside tasks, from
which nothing but links comes out. So no link between members of a bucket is lost, however large it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import give_back, text_batches, unused, without_ids
from .components import between, joined_up
from .words import mix, shingles, stream, word_hashes


@dataclass(frozen=True)
class Params:
    """A pair of similarity 0.8 meets in no band with probability (1 - 0.8^rows)^bands, here 1e-7."""

    width: int = 2  # words in a shingle
    percent: int = 80  # similarity from which texts are linked
    bands: int = 40
    rows: int = 5  # registers in a band
    base: float = 1.01  # of the exponential spacing
    doubt: float = 30.0  # twice the log likelihood ratio beyond which a pair is not confirmed
    part: int = 100_000  # shingles of a part of a cluster that one task holds in full

    @property
    def registers(self) -> int:
        return self.bands * self.rows


BLOCK = 2048  # shingles hashed at a time


@cache
def _factors(seed: int, n: int) -> np.ndarray:
    return (stream(seed, n).astype(np.uint32) | np.uint32(1))[:, None]


def registers(sets: np.ndarray, p: Params) -> np.ndarray:
    """Registers of a set of 64-bit shingle hashes."""
    a, b = _factors(101, p.registers), _factors(102, p.registers)
    low, high = sets.astype(np.uint32), (sets >> np.uint64(32)).astype(np.uint32)
    least = np.full(p.registers, 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(sets), BLOCK):
        drawn = low[i : i + BLOCK] * a + high[i : i + BLOCK] * b
        np.minimum(least, drawn.min(axis=1), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**32
    height = np.floor(1 - np.log(-np.log1p(-uniform)) / np.log(p.base)) + 400  # the rate, as an offset
    return np.clip(height, 0, 65535).astype("<u2")


def band_keys(sketches: np.ndarray, p: Params) -> np.ndarray:
    """One 64-bit key for each row of registers and each band."""
    parts = sketches.reshape(len(sketches), p.bands, p.rows).astype(np.uint64)
    keys = np.broadcast_to(stream(103, p.bands), (len(sketches), p.bands)).copy()
    with np.errstate(over="ignore"):
        for k in range(p.rows):
            keys = mix(keys + parts[:, :, k])
    return keys.view(np.int64)


def _step(x: np.ndarray, base: float) -> np.ndarray:
    """Probability that one register is above another, as a function of the share of the union it owns."""
    return -np.log1p(-x * (base - 1) / base) / np.log(base)


def log_likelihood(j, greater, smaller, equal, share_u, share_v, base):
    up = np.clip(_step(share_u - share_v * j, base), 1e-12, 1)
    down = np.clip(_step(share_v - share_u * j, base), 1e-12, 1)
    same = np.clip(1 - up - down, 1e-12, 1)
    return greater * np.log(up) + smaller * np.log(down) + equal * np.log(same)


def doubtful(u: np.ndarray, v: np.ndarray, n_u: np.ndarray, n_v: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of greatest likelihood for rows of registers, and whether the wanted one is out of the question."""
    greater, smaller = (u > v).sum(axis=1), (u < v).sum(axis=1)
    equal = u.shape[1] - greater - smaller
    share_u, share_v = n_u / (n_u + n_v), n_v / (n_u + n_v)
    # |A ∩ B| / |A ∪ B| is at most the ratio of the sizes; the likelihood has one peak below it.
    most = np.minimum(n_u, n_v) / np.maximum(n_u, n_v)
    low, high = np.zeros(len(n_u)), most.astype(np.float64)
    args = (greater, smaller, equal, share_u, share_v, p.base)
    for _ in range(40):
        third = (high - low) / 3
        better = log_likelihood(low + third, *args) < log_likelihood(high - third, *args)
        low, high = np.where(better, low + third, low), np.where(better, high, high - third)
    best, want = (low + high) / 2, p.percent / 100
    gap = 2 * (log_likelihood(best, *args) - log_likelihood(np.minimum(want, most), *args))
    too_far = (100 * np.minimum(n_u, n_v) < p.percent * np.maximum(n_u, n_v)) | ((best < want) & (gap > p.doubt))
    return best, too_far


def _sketch_udf(p: Params):
    @F.arrow_udf("struct<n_shingles:bigint,digest:binary,registers:binary>")
    def sketch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            sizes, digests, drawn = [], [], []
            for words in word_hashes(texts, fold=True):
                found = shingles(words, p.width)
                sizes.append(len(found))
                digests.append(blake2b(found.tobytes(), digest_size=16).digest())
                drawn.append(registers(found, p).tobytes() if len(found) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(drawn, pa.binary())],
                ["n_shingles", "digest", "registers"],
            )
            del texts
        give_back()

    return sketch


def _matrix(column: pa.Array, p: Params) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u2").reshape(len(column), p.registers)


def _bands_udf(p: Params):
    @F.arrow_udf("array<bigint>")
    def bands(column: pa.Array) -> pa.Array:
        keys = band_keys(_matrix(column, p), p).reshape(-1)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(keys) + 1, p.bands), pa.int32()), pa.array(keys))

    return bands


def _estimate_udf(p: Params):
    @F.arrow_udf("double")
    def estimate(u: pa.Array, v: pa.Array, n_u: pa.Array, n_v: pa.Array) -> pa.Array:
        if not len(u):
            return pa.array([], pa.float64())
        sizes = n_u.to_numpy(zero_copy_only=False).astype(float), n_v.to_numpy(zero_copy_only=False).astype(float)
        best, too_far = doubtful(_matrix(u, p), _matrix(v, p), *sizes, p)
        return pa.array(best, mask=too_far)

    return estimate.asNondeterministic()  # else a filter on it is pushed below and estimates again, in a second worker


def _confirm_udf(p: Params):
    @F.arrow_udf("boolean")
    def confirm(u: pa.Array, v: pa.Array) -> pa.Array:
        found = []
        for a, b in zip(word_hashes(u, fold=True), word_hashes(v, fold=True), strict=True):
            a, b = shingles(a, p.width), shingles(b, p.width)
            common = len(np.intersect1d(a, b, assume_unique=True))
            found.append(100 * common >= p.percent * (len(a) + len(b) - common))
        return pa.array(found, pa.bool_())

    return confirm


def _sided(df: DataFrame, end: str, names: dict[str, str]) -> DataFrame:
    return df.select(F.col("node").alias(end), *[F.col(k).alias(v) for k, v in names.items()])


def _candidates_of(pairs: DataFrame, sketches: DataFrame, p: Params) -> DataFrame:
    """The ``pairs`` (``u, v``) that their registers don't rule out, with the likeliest similarity."""
    for end in ("u", "v"):
        pairs = pairs.join(_sided(sketches, end, {"registers": f"r_{end}", "n_shingles": f"n_{end}"}), end)
    likely = _estimate_udf(p)("r_u", "r_v", "n_u", "n_v")
    return staged(pairs.select("u", "v", likely.alias("likely")).where("likely IS NOT NULL"), "possible")


def _linked(labels: DataFrame, pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """``labels`` joined up along the ``pairs`` that the full sets confirm."""
    for end in ("u", "v"):
        pairs = pairs.join(_sided(texts, end, {"text": f"t_{end}"}), end)
    return joined_up(labels, staged(pairs.where(_confirm_udf(p)("t_u", "t_v")).select("u", "v"), "links"))


def _stragglers(p: Params):
    """Compares the members of one part of a cluster that stand apart with the members of another part.

    Sets are compared in full, one straggler with all members at a time; nothing but links comes out,
    for each straggler one to every group that it touches.
    """

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles(w, p.width) for w in word_hashes(pa.array(group["text"], pa.string()), fold=True)]
        roots, nodes, apart = (group[c].to_numpy() for c in ("root", "node", "apart"))
        whole = np.flatnonzero(~apart)
        vocabulary, ids = np.unique(np.concatenate(sets), return_inverse=True)
        sizes = np.array([len(x) for x in sets])
        ids = np.split(ids, np.cumsum(sizes)[:-1])
        links: list[tuple[int, int]] = []
        if len(whole):
            flat = np.concatenate([ids[i] for i in whole])
            starts = np.append(0, np.cumsum(sizes[whole])[:-1])
            mark = np.zeros(len(vocabulary), dtype=bool)
            for i in np.flatnonzero(apart):
                mark[ids[i]] = True
                common = np.add.reduceat(mark[flat], starts, dtype=np.int64)
                mark[ids[i]] = False
                near = 100 * common >= p.percent * (sizes[i] + sizes[whole] - common)
                hit = whole[near & (roots[whole] != roots[i])]
                links += [(int(nodes[i]), int(nodes[hit[k]])) for k in np.unique(roots[hit], return_index=True)[1]]
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return compare


def _rest(led: DataFrame, labels: DataFrame, alone: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """Links within clusters (``leader, node``) that the comparison with the leader left open.

    In a cluster only members outside its largest group can have such links. They are held against all
    members, part by part: a part holds about ``p.part`` shingles, so no task sees a whole cluster.
    """
    rooted = led.join(labels, "node", "left").select("leader", "node", F.coalesce("root", "node").alias("root"))
    rooted = staged(rooted.join(alone.select("node", "n_shingles"), "node"), "rooted")
    sizes = rooted.groupBy("leader", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    clusters = sizes.groupBy("leader").agg(
        F.max_by("root", "n").alias("major"), F.count(F.lit(1)).alias("roots"),
        F.sum("shingles").alias("all"), (F.sum("shingles") - F.max("shingles")).alias("outside"),
    ).where("roots > 1")
    parts = lambda c: F.ceil(F.col(c) / p.part).cast("int")
    clusters = staged(
        clusters.select("leader", "major", parts("all").alias("rows"), F.greatest(parts("outside"), F.lit(1)).alias("columns")),
        "clusters",
    )
    live = rooted.join(clusters, "leader")
    spread = F.xxhash64("node")
    every = live.select(
        "leader", F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"),
        F.pmod(spread, "rows").cast("int").alias("row"), "node", "root", F.lit(False).alias("apart"),
    )
    apart = live.where("root <> major").select(
        "leader", F.pmod(spread, "columns").cast("int").alias("column"),
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), "node", "root", F.lit(True).alias("apart"),
    )
    dealt = every.unionByName(apart).join(texts, "node")
    return staged(dealt.groupBy("leader", "column", "row").applyInPandas(_stragglers(p), "u long, v long"), "rest")


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """For each row: ``doc_id, n_shingles, component_id, kept``.

    A text's set are its distinct shingles of ``p.width`` words, A-Z lower-cased; with fewer words the
    whole sequence is the one shingle. Null texts and texts without words have the empty set and are
    linked with nothing. Ties need no rule: the component is the smallest id reachable. Rows that repeat
    an id count as one document. Rows without an id take the component of their class, else none, and
    are kept only in the latter case. An empty table gives no rows. Other columns are not read.
    """
    text_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sketched = base.select("doc_id", _sketch_udf(p)("text").alias("s")).select("doc_id", "s.*")
    sketched = staged(sketched, "sketches")
    some = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("node"))
    classes = staged(classes, "classes")

    # One row for each class, then the buckets that hold more than one class.
    alone = sketched.withColumnRenamed("doc_id", "node").join(classes, ["digest", "node"])
    alone = staged(alone.dropDuplicates(["digest", "node"]).select("node", "n_shingles", "registers"), "class_sketches")
    banded = alone.select("node", F.explode(_bands_udf(p)("registers")).alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = staged(banded.join(shared, "band"), "members")

    # The member that meets most others leads its buckets: in a group of copies the one nearest to all.
    meets = members.groupBy("node").agg(F.sum("n").alias("meets"))
    leaders = members.join(meets, "node").groupBy("band").agg(F.max_by("node", "meets").alias("leader"))
    led = staged(members.join(leaders, "band").select("leader", "node").distinct(), "led")

    candidates = staged(led.select("node").distinct(), "candidates")
    sketches = staged(alone.join(candidates, "node"), "candidate_sketches")
    texts = staged(base.join(candidates, F.col("doc_id") == F.col("node")).select("node", "text"), "candidate_texts")

    # The likeliest leader of each member first; what that joins up need not be confirmed again.
    pairs = led.where("leader <> node").select(F.col("leader").alias("u"), F.col("node").alias("v"))
    pairs = _candidates_of(pairs, sketches, p)
    first = staged(pairs.groupBy("v").agg(F.max_by("u", "likely").alias("u")), "first")
    none = docs.sparkSession.createDataFrame([], "node long, root long")
    labels = _linked(none, first.select("u", "v"), texts, p)
    later = between(labels, pairs.select("u", "v").join(first, ["u", "v"], "left_anti"))
    labels = _linked(labels, staged(later.select("u", "v"), "later"), texts, p)
    labels = joined_up(labels, _rest(led, labels, sketches, texts, p))

    final = sketched.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    final = final.join(labels, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "node", "doc_id")).otherwise(F.col("doc_id"))
    return final.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", p: Params = Params()) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, the one with the smallest id.

    Rows are linked by a mark of their own, not by their id: a row without an id is linked like others, and
    of rows that repeat an id only those go that are near copies themselves. Rows without an id stay only
    where their group has none with one. Texts without words all stay.
    """
    mark = unused(docs.columns, "row")
    marked = staged(docs.withColumn(mark, F.monotonically_increasing_id()), "marked")
    found = groups(marked, mark, text_col, p).where("n_shingles > 0").select(F.col("doc_id").alias("node"), "component_id")
    found = found.join(marked.select(F.col(mark).alias("node"), F.col(id_col).alias("id")), "node")
    found = staged(found, "grouped")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "node")).alias("kept"))
    # By mark, of which each row has its own; by component a large group would meet in one task.
    dropped = found.select("node").join(first.select("kept.node"), "node", "left_anti")
    left = without_ids(marked, staged(dropped.select(F.col("node").alias(mark)), "dropped"), mark)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
