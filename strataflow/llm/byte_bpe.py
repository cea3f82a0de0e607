"""Byte-level BPE encoding and decoding without merge loops over the text.

A list of tokens is what the merges make of a text if and only if every two neighbours are: merging the
bytes of the two gives the two again. So a piece is covered by the longest token that fits at each place,
and where two neighbours are incompatible, by the next shorter one; a place from which nothing fits is
never tried again, which keeps the work linear. Which neighbours are compatible is remembered.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .common import give_back, text_batches

KEPT = 250_000  # pieces, and pairs of tokens, remembered by a worker before it forgets them all
LONG = 1 << 20  # characters from which a text is split piece by piece
ROWS = 500  # of a batch that are worked on at a time
NEITHER = "\uffff"  # a character that is neither letter nor number in any version of Unicode


def unknown_letters() -> str:
    """A character class of the letters and numbers that are newer than the library's version of Unicode.

    To the library they are neither, so a pattern of ours has to treat them so too. Empty if there are none.
    """
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ours = regex.sub(r"[^\p{L}\p{N}]+", "", every)
    library = tiktoken.Encoding("letters", pat_str=r"\p{L}|\p{N}", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    known = set(library.decode(library.encode_ordinary(ours)))
    ranges: list[list[int]] = []
    for place in (ord(c) for c in ours if c not in known):
        if ranges and ranges[-1][1] == place - 1:
            ranges[-1][1] = place
        else:
            ranges.append([place, place])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]" if ranges else ""


class Vocabulary:
    """A file of ranks, one base64 token and its rank on a line; enough to decode."""

    def __init__(self, ranks: bytes):
        pairs = [line.split() for line in ranks.splitlines() if line]
        tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
        self.table = [tokens.get(rank, b"") for rank in range(max(tokens) + 1)]
        self.lengths = np.array([len(x) for x in self.table], dtype=np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))


class Codec(Vocabulary):
    """Encodes, too; ``unknown`` is what :func:`unknown_letters` gives."""

    def __init__(self, ranks: bytes, pattern: str, unknown: str = ""):
        super().__init__(ranks)
        self.token = [token.decode("latin-1") for token in self.table]
        self.rank = {token: rank for rank, token in enumerate(self.token) if token}
        self.split = regex.compile(pattern)
        self.unknown = re.compile(unknown) if unknown else None
        self.longest_token = max(map(len, self.rank))
        self.trie = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.trie.add_word(token, rank)
        self.shorter = {rank: self._longest(token, len(token) - 1) for token, rank in self.rank.items()}
        self.pairs: dict[int, bool] = {}
        self.pieces = _Pieces(self)

    def _longest(self, part: str, most: int) -> int:
        """The longest token that is a prefix of ``part`` with at most ``most`` bytes; -1 if there is none."""
        for n in range(min(most, self.trie.longest_prefix(part)), 0, -1):
            if part[:n] in self.rank:
                return self.rank[part[:n]]
        return -1

    def merge(self, text: str) -> list[int]:
        """Plain merging, lowest rank first; for the few bytes of two tokens."""
        parts = list(text)
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get(parts[i] + parts[i + 1], 1 << 60))
            if parts[best] + parts[best + 1] not in self.rank:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [self.rank[part] for part in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave two neighbours as they are."""
        if len(self.pairs) >= KEPT:
            self.pairs.clear()
        known = self.merge(self.token[left] + self.token[right]) == [left, right]
        self.pairs[left << 32 | right] = known
        return known

    def encode_piece(self, piece: str) -> list[int]:
        """Token ids of one match of the pattern."""
        text = piece.encode("utf-8").decode("latin-1")
        rank, token, shorter, known = self.rank, self.token, self.shorter, self.pairs.get
        if text in rank:
            return [rank[text]]
        found: list[int] = []
        last, at, size, most = -1, 0, len(text), self.longest_token
        dead = bytearray(size + 1)
        prefix = self.trie.longest_prefix
        while at < size:
            rest = text[at : at + most]
            n = prefix(rest)
            while (part := rest[:n]) not in rank:
                n -= 1
            following = rank[part]
            while True:
                end = at + n
                if not dead[end]:
                    if last < 0 or (fits := known(last << 32 | following)):
                        break
                    if fits is None and self.compatible(last, following):
                        break
                following = shorter[following]
                while following < 0:
                    dead[at] = 1
                    at -= len(token[last])
                    following = shorter[found.pop()]
                    last = found[-1] if found else -1
                n = len(token[following])
            found.append(following)
            last, at = following, end
        return found

    def forget(self) -> None:
        self.pieces.clear()
        self.pairs.clear()
        give_back()

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        if self.unknown and not _latin(text) and self.unknown.search(text):
            masked = self.unknown.sub(NEITHER, text)
            return b"".join(self.pieces[text[slice(*found.span())]] for found in self.split.finditer(masked))
        if len(text) < LONG:
            return b"".join(map(self.pieces.__getitem__, self.split.findall(text)))
        return b"".join(self.pieces[found.group()] for found in self.split.finditer(text))


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class _Pieces(dict):
    """Encoded pieces, each made when it is first asked for."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= KEPT:
            self.clear()
        ids = array("i", self.codec.encode_piece(piece)).tobytes()
        if len(piece) < 64:
            self[piece] = ids
        return ids


_made: dict[tuple[int, str, str], Vocabulary] = {}


def _once(ranks: Broadcast, pattern: str = "", unknown: str = "") -> Vocabulary:
    """What a worker makes of the file and keeps from task to task; a codec where there is a pattern."""
    key = (hash(ranks.value), pattern, unknown)
    if key not in _made:
        _made[key] = Codec(ranks.value, pattern, unknown) if pattern else Vocabulary(ranks.value)
    return _made[key]


def _slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Batches in parts, which bounds the lists and ids that are in memory at once."""
    for batch in batches:
        yield from (batch.slice(at, ROWS) for at in range(0, max(len(batch), 1), ROWS))


class BytePairEncoder:
    """``encode`` and ``decode`` columns by the rank file at ``path``, which the driver reads and broadcasts.

    The file is a vocabulary of some 10^5 tokens, a few MB; it does not grow with the data.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        text_batches(spark)
        with open(path, "rb") as file:
            self.ranks, self.pattern = spark.sparkContext.broadcast(file.read()), pattern
        self.unknown = unknown_letters()

    def encode(self, text: Column) -> Column:
        """Ids of a whole text as ``array<int>``; null and empty texts have none. Special tokens are plain text."""
        ranks, pattern, unknown = self.ranks, self.pattern, self.unknown

        @F.arrow_udf("array<int>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _once(ranks, pattern, unknown)
            for texts in _slices(batches):
                parts = [codec.encode(text) if text else b"" for text in texts.to_pylist()]
                ends = np.cumsum([0] + [len(part) // 4 for part in parts])
                flat = np.frombuffer(b"".join(parts), dtype=np.int32)
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            codec.forget()  # the worker may wait for other work, with others beside it

        return encode(text)

    def decode(self, ids: Column) -> Column:
        """Bytes of an ``array<int>`` of ids; null stays null. An id that no token has is an error."""
        ranks = self.ranks

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _once(ranks)
            for lists in _slices(batches):
                flat = lists.flatten().to_numpy()
                if (codec.lengths[flat] == 0).any():
                    raise ValueError("an id has no token")
                ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy())
                rows = zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), lists.is_valid().to_pylist(), strict=True)
                yield pa.array([codec.decode(flat[a:b]) if valid else None for a, b, valid in rows], pa.binary())
            give_back()

        return decode(ids)
