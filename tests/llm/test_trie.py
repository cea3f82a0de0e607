"""The prefix trie against one built turn by turn."""

from __future__ import annotations

import hashlib
import math
import zlib

import pytest

from conftest import TESTDATA
from strataflow.llm import centroids, registry, trie
from strataflow.session import staged

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """Turns by conversation, as (role, text)."""
    convs = {}
    key = lambda t: hashlib.md5((hashlib.md5((t[2] or "").encode()).hexdigest() + hashlib.md5((t[3] or "").encode()).hexdigest()).encode()).hexdigest()
    for row in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, key(r))):
        convs.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    return convs


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute_trie(convs):
    nodes = {}
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            nodes.setdefault(tuple(convs[c][:d]), []).append(c)
    out = []
    for prefix, members in nodes.items():
        below = [p for p in nodes if p[: len(prefix)] == prefix]
        inner = {p[:-1] for p in nodes if p}
        out.append((
            members[0], len(prefix), nodes[prefix[:-1]][0] if prefix else None, len(members),
            sum(len(p) == len(prefix) + 1 for p in below), sum(p not in inner for p in below),
            sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in below if p),
            hashlib.sha256(",".join(str(c) for c in members if len(convs[c]) == len(prefix)).encode()).hexdigest(),
        ))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.select(*NAMES).collect()))


ODD = [
    (0, 1, "user", "Hello there"), (0, 2, "assistant", "naïve 漢字🙂"), (0, 3, "user", None), (0, 4, None, "x"), (0, None, "system", "s"),
    (0, 5, "user", "x" * 200_000),
    *[(c, t, "user", f"turn {t}") for c in range(1, 40) for t in range(8)],
    *[(c, t, "user", f"own {c} {t}") for c in range(100, 120) for t in range(c % 5)],
    *[(200 + i, t, "user", "same") for i in range(30) for t in range(3)],
    (300, 1, "user", "short base"), *[(300 + i, t, "user", "tail") for i in range(1, 9) for t in range(7)],
    (407, 3, "b", "tie"), (407, 3, "a", "tie"), (407, 3, "a", "tie"), (408, None, None, None), (408, None, None, None),
    (-5, 1, "user", "below zero"), (-205, 1, "user", "no base"), (None, 1, "user", "belongs to none"), (None, None, None, None),
    *[(501, t, "user", f"deep {t}") for t in range(300)],
]


@pytest.fixture(scope="module")
def chats(spark):
    schema = "conv_id long, turn int, role string, text string, node string, depth string, path string, position string"
    return spark.createDataFrame([(*row, "x", "y", "z", "w") for row in ODD], schema)


def test_rebuilt_trie_on_odd_rows(chats):
    assert got(trie.rebuilt_trie(chats)) == brute_trie(rebuilt(ordered(ODD)))


def test_plain_trie_on_odd_rows(chats):
    assert got(trie.prefix_trie(chats)) == brute_trie(ordered(ODD))


def test_query_on_a_larger_table(spark):
    path = TESTDATA.replace("sf0.001", "sf0.01")
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(registry.QUERIES["op12_conversation_trie"](spark, path)) == brute_trie(rebuilt(ordered(rows)))


def test_empty_table(spark, chats):
    empty = spark.createDataFrame([], chats.schema)
    for build in (trie.prefix_trie, trie.rebuilt_trie):
        assert build(empty).collect() == [] and build(empty).columns == NAMES


def test_a_path_of_many_nodes_takes_few_rounds(spark, monkeypatch):
    """A path of 3,000 nodes, and one of 500 that a thousand paths share: rounds by the logarithm, not by depth."""
    rounds = []
    written = centroids.staged
    monkeypatch.setattr(centroids, "staged", lambda df, label: (rounds.append(label), written(df, label))[1])
    n = 3000
    nodes = staged(spark.range(n).selectExpr("0L AS path", "id AS depth", f"{n} - id AS weight", "0L AS top", "id AS value"), "nodes")
    paths = staged(spark.range(n).selectExpr("0L AS path", "id AS depth", "0L AS node", "if(id = 0, null, 0L) AS above"), "paths")
    sums = {r.depth: r.value for r in centroids.subtree_sums(nodes, paths, ["value"]).collect()}
    assert sums == {d: (n * (n - 1) - d * (d - 1)) // 2 for d in range(n)}
    assert len(rounds) <= 1 + math.log2(n)


def test_ids_of_a_node_are_joined_by_stretches(spark):
    ids = [3, 4095, 4096, 4097, 9000, -1, 12, 100_000, 20_000]
    paths = spark.createDataFrame([(c, 0, -1, 0) for c in ids] + [(c, 1, c, 2) for c in ids], "path long, depth long, node long, n_turns long")
    row = trie.ends(paths).collect()
    assert [tuple(r) for r in row] == [(-1, 0, hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest())]
