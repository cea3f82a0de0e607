"""SimHash groups against all pairs, on odd rows, test tables and dense groups."""

from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash
from llm.conftest import TEXTS
from pyspark.sql import functions as F

from conftest import TESTDATA
from strataflow.llm import registry, simhash
from strataflow.llm.components import components
from strataflow.session import staged

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 3]) for i in range(max(len(w) - 2, 1))] if w else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, radius=2):
    """Smallest id reachable for each (id, fingerprint)."""
    bits = np.array([p for _, p in prints], dtype=np.uint64)
    root = list(range(len(prints)))
    changed = True
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= radius
    while changed:
        low = [min(root[j] for j in np.flatnonzero(near[i])) for i in range(len(prints))]
        changed, root = low != root, low
    ids = {}
    for (i, _), r in zip(prints, root, strict=True):
        if i is not None:
            ids[r] = min(i, ids.get(r, i))
    return [(i, p, ids.get(r)) for (i, p), r in zip(prints, root, strict=True)]


def got(df):
    return sorted(((r.doc_id, r.fingerprint & (2**64 - 1), r.component_id) for r in df.collect()), key=repr)


def test_groups_on_odd_rows(odd):
    prints = [(t[0], brute_print(t[1])) for t in TEXTS]
    assert got(simhash.groups(odd)) == sorted(brute_groups(prints), key=repr)


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_on_the_test_tables(spark, folder):
    path = TESTDATA.replace("sf0.001", folder)
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    expected = [(i, f"{p:016x}", c) for i, p, c in brute_groups([(r[0], brute_print(r[1])) for r in docs])]
    found = registry.QUERIES["op11_simhash"](spark, path)
    assert sorted(map(tuple, found.select("doc_id", "fingerprint", "component_id").collect())) == sorted(expected)


def test_empty_table(empty):
    assert simhash.groups(empty).collect() == [] and simhash.simhash_dedup(empty).collect() == []


def test_dedup_keeps_the_smallest_id_of_each_group(odd):
    left = simhash.simhash_dedup(odd)
    assert left.columns == odd.columns
    groups = brute_groups([(t[0], brute_print(t[1])) for t in TEXTS])
    assert sorted(r.doc_id for r in left.collect()) == sorted({c for _, _, c in groups})


def partition(labels, nodes):
    return {n: labels.get(n, n) for n in nodes}


@pytest.mark.parametrize("parts, tile", [(1, 4096), (2, 20), (4, 4096), (8, 20)])
def test_links_join_up_what_all_pairs_do(spark, parts, tile):
    """Random fingerprints, a path of single bits, a dense ball and the ends of the range, over many tiles."""
    rng = np.random.default_rng(parts)
    centre = int(rng.integers(0, 1 << 63))
    ball = [centre ^ (1 << a) ^ (1 << b) for a in range(0, 64, 5) for b in range(64)]
    path = [(1 << k) - 1 for k in range(65)]
    some = rng.integers(0, 1 << 63, 300).tolist()
    near = [x ^ (1 << int(a)) ^ (1 << int(b)) ^ (1 << int(c)) for x in some[:50] for a, b, c in rng.integers(0, 64, (2, 3))]
    prints = sorted({x & (2**64 - 1) for x in [*ball, *path, *some, *near]})
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = staged(spark.createDataFrame([(x,) for x in signed], "bits long"), "bits")
    found = simhash.links(df, 2, parts, tile).collect()
    bits = dict(zip(signed, prints, strict=True))
    assert all(0 < (bits[r.u] ^ bits[r.v]).bit_count() <= 2 for r in found)
    links = spark.createDataFrame([(r.u, r.v) for r in found], "u long, v long")
    labels = dict(map(tuple, components(links).collect()))
    wanted = {i: c for i, _, c in brute_groups(list(zip(signed, prints, strict=True)))}
    assert partition(labels, signed) == wanted


def test_a_dense_group_gives_few_links():
    every = np.array([1 << a | 1 << b for a in range(64) for b in range(64)], dtype=np.uint64)
    every = np.unique(every)
    links = simhash.joined_within(every, every, 2)
    assert len(links) == len(every) - 1


def test_skipped_buckets_hold_no_pair_within_the_radius():
    """A step between buckets is listed exactly if the population counts allow it."""
    for parts in (1, 2, 4):
        size, base = 64 // parts, 64 // parts + 5
        rng = np.random.default_rng(parts)
        steps = set(simhash._steps(parts, 2))
        for _ in range(2000):
            a = rng.integers(0, size + 1, parts)
            b = np.clip(a + rng.integers(-2, 3, parts), 0, size)
            key = lambda v: sum((int(x) + 2) * base ** (parts - 1 - k) for k, x in enumerate(v))
            step = abs(key(a) - key(b))
            assert (step in steps) == (int(np.abs(a - b).sum()) <= 2)


def test_half_of_all_fingerprints_in_one_bucket_fill_many_tasks(spark):
    prints = [(1 << a | 1 << b | 1 << c) for a in range(20) for b in range(20, 40) for c in range(40, 60)]
    df = staged(spark.createDataFrame([(x,) for x in prints[:3000]], "bits long"), "bits")
    calls = simhash.links(df, 2, 1, 250)
    sizes = calls.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(sizes) > 4
