"""Stretches of words that repeat with a period, by string synchronising sets.

At each scale t = 1, 2, 4, ... a set of positions is chosen by hash alone: a position stands if the least hash
among the windows of t words that begin up to t words on is that of the first or the last of them. Whether it
stands depends on the 2t words from it and on nothing else, so in a run of period p the positions come back
every p words. A run of t <= p < 2t and at least 4p words holds a position and its copy p words on, both with
their whole contexts of 2t words, and no equal context between them. So the next equal context of each position
proposes all periods of the scale; the run is then read off the words themselves, to both sides.

Windows of a period up to t / 4 are left out of the choice: their runs have been found at smaller scales, and
without them the positions stay about t words apart. All steps are linear in the words, but for the sorting.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches, unused
from .words import mix

TIMES = 4  # periods in a run at least; the choice of scales rests on it
CHUNK = 1 << 15  # words looked at together; a longer text is looked at alone

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
Run = tuple[int, int, int]  # start, length, period


def _least(values: np.ndarray, scale: int) -> np.ndarray:
    """Least of the ``scale + 1`` values from each position on; ``scale`` is a power of two."""
    low, width = values, 1
    while width < scale:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    return np.minimum(low[:-1], values[scale:])


def synchronising(prints: np.ndarray, scale: int, periodic: list[Run]) -> np.ndarray:
    """Positions of the set, given a hash for each window of ``scale`` words and the runs of short periods."""
    open_to = prints.copy()
    for start, length, _ in periodic:
        open_to[start : start + length - scale + 1] = _NONE
    least = _least(open_to, scale)
    return np.flatnonzero(((least == open_to[: len(least)]) | (least == open_to[scale:])) & (least != _NONE))


def _right(ids: np.ndarray, at: int, period: int) -> int:
    """The first place from ``at`` on that differs from the one a period later."""
    end, step = len(ids) - period, 64
    while at < end:
        stop = min(at + step, end)
        other = np.flatnonzero(ids[at:stop] != ids[at + period : stop + period])
        if len(other):
            return at + int(other[0])
        at, step = stop, 2 * step
    return end


def _left(ids: np.ndarray, at: int, period: int) -> int:
    """The first place of those before ``at`` that equal the one a period later, without a gap."""
    step = 64
    while at > 0:
        stop = max(at - step, 0)
        other = np.flatnonzero(ids[stop:at] != ids[stop + period : at + period])
        if len(other):
            return stop + int(other[-1]) + 1
        at, step = stop, 2 * step
    return 0


def runs(ids: np.ndarray, longest: int | None = None) -> list[Run]:
    """All maximal runs of at least TIMES periods in a sequence of word numbers, by start and period.

    ``longest`` bounds the length of a run where the caller knows one.
    """
    found: list[Run] = []
    n = len(ids)
    prints, scale = mix(ids.astype(np.uint64) + np.uint64(1)), 1
    while TIMES * scale <= min(n, longest or n):
        short = [run for run in found if TIMES * run[2] <= scale <= run[1]]
        places = synchronising(prints, scale, short)
        with np.errstate(over="ignore"):
            prints = mix(prints[:-scale] * np.uint64(0x9E3779B97F4A7C15) + prints[scale:])
        contexts = prints[places]
        order = np.argsort(contexts, kind="stable")
        contexts, places = contexts[order], places[order]
        gaps = places[1:] - places[:-1]
        pairs = np.flatnonzero((contexts[1:] == contexts[:-1]) & (gaps >= scale) & (gaps < 2 * scale))
        pairs = pairs[np.argsort(places[pairs], kind="stable")]
        ends: dict[int, int] = {}
        for at, period in zip(places[pairs].tolist(), gaps[pairs].tolist(), strict=True):
            if at + period >= ends.get(period, 0):  # else within the run that was found last
                start, end = _left(ids, at, period), _right(ids, at, period) + period
                ends[period] = end
                if end - start >= TIMES * period:
                    found.append((start, end - start, period))
        scale *= 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def _chunks(texts: list[bytes]) -> Iterator[tuple[list[list[bytes]], list[list[Run]]]]:
    """Words and runs of each text. Texts are looked at together, parted by numbers that come only once."""
    words: list[list[bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        words.append(text.split())
        size += len(words[-1])
        if size >= CHUNK or i == len(texts) - 1:
            numbers: dict[bytes, int] = {}
            flat: list[int] = []
            starts = []
            for k, own in enumerate(words):
                starts.append(len(flat))
                flat += [numbers.setdefault(word, len(numbers)) for word in own]
                flat.append(-1 - k)
            each: list[list[Run]] = [[] for _ in words]
            ids = np.array(flat, dtype=np.int64)
            for start, length, period in runs(ids, max(map(len, words))):
                k = int(np.searchsorted(starts, start, side="right")) - 1
                each[k].append((start - starts[k], length, period))
            yield words, each
            words, size = [], 0


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """The words without what runs repeat: all that a run holds after its first period goes."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept)]


RESULT = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


def _runs_udf(least: int):
    @F.arrow_udf(RESULT)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, ends, flat, texts = [], [0], [], []
            for words, each in _chunks(batch.to_pylist()):
                for own, found in zip(words, each, strict=True):
                    found = [run for run in found if run[1] >= least]
                    counts.append(len(own))
                    flat += found
                    ends.append(len(flat))
                    texts.append(b" ".join(collapsed(own, found)))
            parts = list(zip(*flat, strict=True)) or [(), (), ()]
            names = ["start", "length", "period"]
            structs = pa.StructArray.from_arrays([pa.array(part, pa.int64()) for part in parts], names)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs)
            columns = [pa.array(counts, pa.int64()), lists, pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.StructArray.from_arrays(columns, ["n_words", "runs", "collapsed"])
            del batch, texts

    return find


def found_in(text: Column, least: int = 6) -> Column:
    """``n_words, runs, collapsed`` of a text column, as a struct; see ``periodic_runs``."""
    return _runs_udf(least)(F.coalesce(text, F.lit("")).cast("binary"))


def periodic_runs(docs: DataFrame, text_col: str = "text", least: int = 6) -> DataFrame:
    """``docs`` with a struct ``periodic``: ``n_words``, ``runs`` (``start, length, period``) and ``collapsed``.

    Words are ``[^\\x20\\x09-\\x0D]+``, counted from 0. A run is a stretch of consecutive words with smallest
    period ``period``, of at least ``least`` words and four periods, that no neighbouring word extends; runs are
    ordered by start, then period. ``collapsed`` are the words joined by one space, without those that a run
    holds after its first period. Null texts count as empty: no words, no runs, an empty text. Runs may overlap;
    no two of the same start and length have different periods. A text is taken whole, however long, by the task
    that reads it; rows that repeat give repeated results, an empty table gives no rows. A column of the name
    ``periodic`` stays, the new one then gets an underscore.
    """
    text_batches(docs.sparkSession)
    return docs.withColumn(unused(docs.columns, "periodic"), found_in(F.col(f"`{text_col}`"), least))
