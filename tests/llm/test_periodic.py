"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.conftest import TEXTS

from conftest import TESTDATA
from strataflow.llm import periodic, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(ids, times=4):
    ids, out = np.asarray(ids), []
    for q in range(1, len(ids) // times + 1):
        same = np.flatnonzero(ids[:-q] == ids[q:])
        for part in np.split(same, np.flatnonzero(np.diff(same) > 1) + 1) if len(same) else []:
            start, end = int(part[0]), int(part[-1]) + 1 + q
            if end - start >= times * q and not any((ids[start : end - p] == ids[start + p : end]).all() for p in range(1, q)):
                out.append((start, end - start, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute(words, least=6):
    numbers = {}
    found = [r for r in brute_runs([numbers.setdefault(w, len(numbers)) for w in words]) if r[1] >= least]
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return found, " ".join(w for i, w in enumerate(words) if i not in gone)


pieces = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 8), st.integers(0, 4))


@settings(max_examples=300, deadline=None)
@given(st.lists(pieces, max_size=6), st.integers(1, 3))
def test_runs_of_stitched_pieces(parts, modulus):
    ids = [x % (modulus + 1) for unit, times, cut in parts for x in (unit * times)[cut:]]
    assert periodic.runs(np.array(ids, dtype=np.int64)) == brute_runs(ids)


def test_runs_within_runs_and_words_of_sequences_without_powers():
    inner = [1, 1, 1, 1, 1, 2]
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for ids in (inner * 9, ([0, 1] * 5 + [2]) * 5, b, [bin(i).count("1") % 2 for i in range(512)], [7] * 1000, list(range(500))):
        assert periodic.runs(np.array(ids, dtype=np.int64)) == brute_runs(ids)


def test_positions_are_chosen_by_their_contexts_alone():
    """In a run the chosen positions come back every period, and equal contexts are chosen alike everywhere."""
    rng = np.random.default_rng(3)
    unit = rng.integers(0, 50, 37)
    ids = np.concatenate([rng.integers(0, 50, 300), np.tile(unit, 12), rng.integers(0, 50, 300), unit, unit])
    prints, scale = periodic.mix(ids.astype(np.uint64) + np.uint64(1)), 1
    while scale < 32:
        with np.errstate(over="ignore"):
            prints = periodic.mix(prints[:-scale] * np.uint64(0x9E3779B97F4A7C15) + prints[scale:])
        scale *= 2
    chosen = set(periodic.synchronising(prints, scale, []).tolist())
    contexts = {}
    for i in range(len(ids) - 2 * scale + 1):
        contexts.setdefault(tuple(ids[i : i + 2 * scale]), set()).add(i in chosen)
    assert all(len(x) == 1 for x in contexts.values())
    assert all(any(j in chosen for j in range(i, i + scale)) for i in range(len(ids) - 3 * scale))


def test_periodic_runs_on_odd_rows(odd):
    left = periodic.periodic_runs(odd)
    assert left.columns == [*odd.columns, "periodic"]
    for row in left.collect():
        words = WORD.findall(row.text or "")
        found, text = brute(words)
        assert row.periodic.n_words == len(words)
        assert [tuple(r) for r in row.periodic.runs] == found and row.periodic.collapsed == text


def test_texts_of_a_batch_do_not_run_into_each_other(spark):
    texts = [(i, "a b a b a b a") for i in range(50)] + [(50, "a " * 40_000 + "b"), (51, None), (52, " ".join(["x", "y"] * 3))]
    df = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    found = {r.doc_id: [tuple(x) for x in r.periodic.runs] for r in periodic.periodic_runs(df).collect()}
    assert found == {**{i: [] for i in range(50)}, 50: [(0, 40_000, 1)], 51: [], 52: []}
    assert periodic.periodic_runs(df, least=3).where("doc_id = 52").first().periodic.runs == []


def test_empty_table_and_taken_name(empty):
    taken = empty.withColumnRenamed("kept", "periodic")
    assert periodic.periodic_runs(taken).columns == [*taken.columns, "periodic_"]
    assert periodic.periodic_runs(taken).collect() == []


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    expected = []
    for doc_id, text in docs:
        found, left = brute(planted(doc_id, WORD.findall(text or "")))
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        milli = 1000 * best[1] // best[2] if found else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        expected.append((doc_id, len(found), *best, milli, sha(lines), sha(left)))
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = registry.QUERIES["op13_periodic_runs"](spark, TESTDATA)
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert sum(r[1] for r in expected) >= 10
