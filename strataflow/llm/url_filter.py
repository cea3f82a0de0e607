"""Judging URLs by a list of host and path rules.

The list is a file: its strings by ascending xxhash64, and the hashes as an array that tasks map into
memory. Every host suffix with every path prefix that a rule could have is looked up by binary search
over whole batches, and a hit counts only if the stored string is the one looked for.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MOST_BYTES = 1 << 30  # of a list; each node fetches it once


def address(url: Column) -> tuple[Column, Column]:
    """Host and path. Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased;
    path: then up to ``?``, ``#`` or the end. A null url and one without ``://`` have both empty."""
    rest = F.substring(url, F.locate("://", url) + 3, F.length(url))
    rest = F.when(F.locate("://", url) > 0, rest).otherwise(F.lit(""))
    whole = F.regexp_extract(rest, r"(?s)^[^?#]*", 0)
    host = F.regexp_extract(whole, r"(?s)^[^/]*", 0)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), F.regexp_extract(whole, r"(?s)^[^/]*(.*)$", 1)


class RuleList:
    """A sorted digest array on disk, mapped into memory, with the strings and verdicts beside it."""

    def __init__(self, path: str):
        n, w, self.longest_host = map(int, np.memmap(path, "<u8", "r", shape=(3,)))
        self.lengths = np.memmap(path, "<u8", "r", 24, (w,)) if w else np.zeros(0, np.uint64)
        at = 24 + 8 * w
        self.digests = np.memmap(path, "<u8", "r", at, (n,)) if n else np.zeros(0, np.uint64)
        self.ends = np.memmap(path, "<u8", "r", at + 8 * n, (n + 1,))
        self.allows = np.memmap(path, "u1", "r", at + 16 * n + 8, (n,)) if n else np.zeros(0, np.uint8)
        self.texts = np.memmap(path, "u1", "r", at + 17 * n + 8) if self.ends[-1] else np.zeros(0, np.uint8)

    @staticmethod
    def write(rules: dict[str, str], path: str) -> None:
        """``rules``: host and path, joined, to ``allow`` or ``block``. A rule's path starts at its first slash."""
        raw = {rule.encode("utf-8"): verdict for rule, verdict in rules.items()}
        by = sorted(raw, key=lambda rule: (xxhash.xxh64_intdigest(rule), rule))
        lengths = sorted({len(rule) - rule.find(b"/") for rule in by})
        with open(path, "wb") as file:
            for part in (
                [len(by), len(lengths), max((rule.find(b"/") for rule in by), default=0)], lengths, [xxhash.xxh64_intdigest(rule) for rule in by],
                np.append(0, np.cumsum([len(rule) for rule in by])),
            ):
                file.write(np.array(part, dtype="<u8").tobytes())
            file.write(bytes(raw[rule] == "allow" for rule in by) + b"".join(by))
        if os.path.getsize(path) > MOST_BYTES:
            raise ValueError(f"the list is larger than {MOST_BYTES} bytes")

    def text(self, i: int) -> bytes:
        return self.texts[int(self.ends[i]) : int(self.ends[i + 1])].tobytes()

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The place of each key in the list, or -1."""
        wanted = np.array([xxhash.xxh64_intdigest(key) for key in keys], dtype=np.uint64)
        at = np.searchsorted(self.digests, wanted)
        found = np.full(len(keys), -1)
        for k in np.flatnonzero((at < len(self.digests)) & (self.digests[np.minimum(at, len(self.digests) - 1)] == wanted)) if len(self.digests) else ():
            i = int(at[k])
            while i < len(self.digests) and self.digests[i] == wanted[k]:  # equal digests stand side by side
                if self.text(i) == keys[k]:
                    found[k] = i
                i += 1
        return found

    def longest(self, hosts: list[str], paths: list[str]) -> list[tuple[str, str] | None]:
        """For each host and path the longest rule that fits, with its verdict; of equally long ones that of the longer host."""
        keys: list[bytes] = []
        owner: list[int] = []
        lengths = [int(n) for n in self.lengths]
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            raw, way = host.encode("utf-8"), path.encode("utf-8")
            if len(raw) > self.longest_host:  # no rule has a longer host; go on after the next dot
                raw = raw[len(raw) - self.longest_host - 1 :].partition(b".")[2]
            while raw:
                fitting = [raw + way[:n] for n in lengths if n <= len(way)]
                keys += fitting
                owner += [i] * len(fitting)
                raw = raw.partition(b".")[2]
        best: list[tuple[str, str] | None] = [None] * len(hosts)
        for k in np.flatnonzero((places := self.find(keys)) >= 0):
            i, rule = owner[k], keys[k].decode("utf-8", "replace")
            if best[i] is None or len(keys[k]) > len(best[i][0].encode("utf-8")):
                best[i] = (rule, "allow" if self.allows[places[k]] else "block")
        return best


def rule_column(spark: SparkSession, rules: dict[str, str], host: Column, path: Column) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, or null."""
    folder = tempfile.mkdtemp(prefix="rules-")
    name = os.path.basename(folder)
    RuleList.write(rules, os.path.join(folder, name))
    spark.sparkContext.addFile(os.path.join(folder, name))  # each node gets its own copy to map

    @F.arrow_udf("struct<rule:string,verdict:string>")
    def judge(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        listed = RuleList(SparkFiles.get(name))
        for hosts, paths in batches:
            seen = hosts.to_pylist(), paths.to_pylist()
            found = [(h or "", p or "") for h, p in zip(*seen, strict=True)]
            verdicts = listed.longest([h for h, _ in found], [p for _, p in found])
            yield pa.array(
                [None if v is None else {"rule": v[0], "verdict": v[1]} for v in verdicts],
                pa.struct([("rule", pa.string()), ("verdict", pa.string())]),
            )

    return judge(host, path)


def judged(pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """For each row: ``page_id, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's. A url that no rule fits,
    a null or an unreadable one is not on the list and is allowed, with a null rule. Repeated rows are
    rows each; an empty table gives no rows. Other columns are not read.
    """
    host, path = address(F.coalesce(F.col(url_col), F.lit("")))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", rule_column(pages.sparkSession, rules, F.col("host"), F.col("path")))
    verdict = F.coalesce("found.verdict", F.lit("allow"))
    return rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"))
