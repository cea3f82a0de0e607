"""Words and shingles of texts as 64-bit numbers, with numpy over whole Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19  # bytes hashed at a time; longer texts are cut between words

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = stream(11, 256)
_FOLDED = _BYTE.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_weights = stream(12, 4096) | np.uint64(1)


def _place(n: int) -> np.ndarray:
    global _weights
    if len(_weights) < n:
        _weights = stream(12, 2 * n) | np.uint64(1)
    return _weights


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, where, data = texts.buffers()
    ends = np.frombuffer(where, dtype=kind, count=len(texts) + 1 + texts.offset)[texts.offset :].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def _hashes(raw: np.ndarray, begins: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of ``raw``; a word also ends where a text begins."""
    inside = np.flatnonzero(~_IS_SPACE[raw])
    if not len(inside):
        return np.zeros(0, dtype=np.uint64), inside
    first = np.empty(len(inside), dtype=bool)
    first[0] = True
    np.not_equal(inside[1:], inside[:-1] + 1, out=first[1:])
    at = np.searchsorted(inside, begins)
    at = at[at < len(inside)]
    first[at] = True
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(inside)))
    within = np.arange(len(inside)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        values = table[raw[inside]] * _place(int(lengths.max()))[within]
        return mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64)), inside[starts]


def _cut(raw: np.ndarray) -> Iterator[np.ndarray]:
    """``raw`` in pieces of about CHUNK bytes that end between words."""
    start, probe = 0, CHUNK
    while probe < len(raw):
        spaces = np.flatnonzero(_IS_SPACE[raw[probe : probe + CHUNK]])
        if len(spaces):
            end = probe + int(spaces[0])
            yield raw[start:end]
            start = end
        probe += CHUNK
    yield raw[start:]


def word_hashes(texts: pa.Array, fold: bool) -> Iterator[np.ndarray]:
    """For each text the hashes of its words in order; ``fold`` lower-cases A-Z."""
    table = _FOLDED if fold else _BYTE
    raw, ends = utf8(texts)
    i, n = 0, len(texts)
    while i < n:
        j = max(int(np.searchsorted(ends, ends[i] + CHUNK, side="right")) - 1, i + 1)
        if j == i + 1:
            parts = [_hashes(x, np.zeros(0, dtype=np.int64), table)[0] for x in _cut(raw[ends[i] : ends[j]])]
            yield np.concatenate(parts)
        else:
            hashes, starts = _hashes(raw[ends[i] : ends[j]], ends[i:j] - ends[i], table)
            yield from np.split(hashes, np.searchsorted(starts, ends[i + 1 : j] - ends[i]))
        i = j


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``width`` words; of all words as one run where there are fewer."""
    if not len(words):
        return words
    width = min(width, len(words))
    with np.errstate(over="ignore"):
        out = words[: len(words) - width + 1] + np.uint64(width)
        for k in range(1, width):
            out = mix(out) + words[k : len(words) - width + 1 + k]
    return np.unique(mix(out))
