"""Exact deduplication by counting quotient filters.

The fingerprint of a text (64 bits) is cut into a quotient, whose leading bits name a block, and a
remainder. Each task builds the filter of its rows and sends it block by block; the filters of a block
merge without loss, as two sorted lists of remainders do, and the counts of equal remainders add up.
Fingerprints with a count above one are only suspects: their rows are compared by all bytes of the text.
A fingerprint moves once per task and filter, so copies of one text never meet in one task before they
are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .common import SPACES, unused

BLOCK_ROWS = 200_000  # distinct fingerprints aimed at in a block
FILTER_ROWS = 2_000_000  # rows after which a task sends its filter and starts a new one


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 128:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _read_varint(raw: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while raw[at] >= 128:
        n |= (raw[at] & 127) << shift
        at, shift = at + 1, shift + 7
    return n | raw[at] << shift, at + 1


@dataclass
class QuotientFilter:
    """Fingerprints of ``bits`` bits with counts, packed: no slot is empty, so none has to shift.

    ``occupied`` has a bit for each quotient, ``run_end`` one for each slot, set on the last remainder of a
    quotient; remainders are sorted within their run. There are about as many quotients as fingerprints, so the
    filter is as large as what it holds: as bytes, two to three bits of flags for each, the remainder in whole
    bytes, and a byte for the count, of which those from 255 on stand in full behind the others.
    """

    bits: int
    quotient_bits: int
    occupied: np.ndarray
    run_end: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> QuotientFilter:
        """From sorted distinct fingerprints."""
        quotient_bits = max(1, min(bits - 1, len(fingerprints).bit_length()))
        rest = bits - quotient_bits
        quotients = fingerprints >> np.uint64(rest)
        occupied = np.zeros(1 << quotient_bits, dtype=bool)
        occupied[quotients] = True
        run_end = np.ones(len(quotients), dtype=bool)
        np.not_equal(quotients[1:], quotients[:-1], out=run_end[:-1])
        remainders = fingerprints & np.uint64((1 << rest) - 1)
        return cls(bits, quotient_bits, occupied, run_end, remainders, counts)

    def fingerprints(self) -> np.ndarray:
        run = np.cumsum(self.run_end) - self.run_end  # runs that ended before
        quotients = np.flatnonzero(self.occupied)[run].astype(np.uint64)
        return (quotients << np.uint64(self.bits - self.quotient_bits)) | self.remainders

    @property
    def width(self) -> int:
        """Bytes of a remainder."""
        return -(-(self.bits - self.quotient_bits) // 8)

    def to_bytes(self) -> bytes:
        head = _varint(len(self.remainders)) + bytes([self.quotient_bits])
        flags = np.packbits(self.occupied).tobytes() + np.packbits(self.run_end).tobytes()
        low = np.ascontiguousarray(self.remainders.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, : self.width]
        small = np.minimum(self.counts, 255).astype(np.uint8)
        return head + flags + low.tobytes() + small.tobytes() + self.counts[small == 255].astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes, bits: int) -> QuotientFilter:
        n, at = _read_varint(raw, 0)
        quotient_bits, at = raw[at], at + 1

        def flags(count: int, at: int) -> np.ndarray:
            return np.unpackbits(np.frombuffer(raw, np.uint8, -(-count // 8), at), count=count).astype(bool)

        occupied = flags(1 << quotient_bits, at)
        at += -(-(1 << quotient_bits) // 8)
        run_end = flags(n, at)
        at += -(-n // 8)
        width = -(-(bits - quotient_bits) // 8)
        remainders = np.zeros((n, 8), dtype=np.uint8)
        remainders[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(n, width)
        at += n * width
        counts = np.frombuffer(raw, np.uint8, n, at).astype(np.uint64)
        large = counts == 255
        counts[large] = np.frombuffer(raw, "<u8", int(large.sum()), at + n)
        return cls(bits, quotient_bits, occupied, run_end, remainders.reshape(-1).view("<u8"), counts)


def merged(filters: list[QuotientFilter]) -> QuotientFilter:
    """One filter that counts what all of them counted.

    Each comes out of its filter sorted, and numpy's stable sort merges what is sorted already.
    """
    every = np.concatenate([f.fingerprints() for f in filters])
    order = np.argsort(every, kind="stable")
    every, counts = every[order], np.concatenate([f.counts for f in filters])[order]
    first = np.ones(len(every), dtype=bool)
    np.not_equal(every[1:], every[:-1], out=first[1:])
    starts = np.flatnonzero(first)
    return QuotientFilter.of(every[starts], np.add.reduceat(counts, starts) if len(starts) else counts, filters[0].bits)


def block_bits_for(rows: int, bits: int) -> int:
    """Leading bits that name a block, so that a block has at most BLOCK_ROWS of ``rows`` fingerprints."""
    return min(max(4, int(np.ceil(np.log2(max(rows, 1) / BLOCK_ROWS + 1))) + 3), bits - 1)


def packed(found: np.ndarray, counts: np.ndarray, bits: int, block_bits: int) -> tuple[np.ndarray, list[bytes]]:
    """Numbers of the blocks that sorted distinct fingerprints fall into, and the filter of each as bytes."""
    inner = bits - block_bits
    blocks = (found >> np.uint64(inner)).astype(np.int64)
    names, starts = np.unique(blocks, return_index=True)
    ends = np.append(starts[1:], len(found))
    local = found & np.uint64((1 << inner) - 1)
    return names, [QuotientFilter.of(local[a:b], counts[a:b], inner).to_bytes() for a, b in zip(starts, ends, strict=True)]


def repeated(fingerprints: DataFrame, column: str, rows: int, bits: int = 64) -> DataFrame:
    """The values of a column of non-negative ``bits``-bit numbers that occur more than once.

    ``rows`` is about the number of rows; it sets the number of blocks.
    """
    block_bits = block_bits_for(rows, bits)
    inner = bits - block_bits  # bits of a fingerprint within its block

    def pack(found: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
        names, filters = packed(found, counts.astype(np.uint64), bits, block_bits)
        return pd.DataFrame({"block": names, "filter": filters})

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[np.ndarray] = []
        for batch in batches:
            kept.append(batch.iloc[:, 0].to_numpy().astype(np.uint64))
            if sum(map(len, kept)) >= FILTER_ROWS:
                yield pack(*np.unique(np.concatenate(kept), return_counts=True))
                kept = []
        if sum(map(len, kept)):
            yield pack(*np.unique(np.concatenate(kept), return_counts=True))

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = merged([QuotientFilter.from_bytes(raw, inner) for raw in group["filter"]])
        more = whole.counts > 1
        found = whole.fingerprints()[more] | (np.uint64(key[0]) << np.uint64(inner))
        return pd.DataFrame({column: found.astype(np.int64), "copies": whole.counts[more].astype(np.int64)})

    filters = fingerprints.select(column).where(F.col(column).isNotNull()).mapInPandas(build, "block long, filter binary")
    return filters.groupBy("block").applyInPandas(merge, f"`{column}` long, copies long")


def normalised(text: Column) -> Column:
    """``text`` without the characters [\\x20\\x09-\\x0D]; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), SPACES, "")


def fingerprint(sha256: Column, bits: int) -> Column:
    """The leading ``bits`` (at most 60) bits of a hexadecimal digest as a number."""
    return F.shiftright(F.conv(F.substring(sha256, 1, 15), 16, 10).cast("long"), 60 - bits)


def keep_order(n_chars: Column, row_id: Column) -> Column:
    """The least stays: of equal texts the one with most code points, then the smallest id; a row without id comes last."""
    return F.struct(-n_chars, row_id.isNull(), row_id.alias("id"))


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 60) -> DataFrame:
    """For each row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are identical without white space [\\x20\\x09-\\x0D]. Null and empty texts
    and texts of white space alone are equal. Rows that repeat an id are rows of the group each, and
    ``kept`` holds for all rows that bear the id that stays. Where no row of a group has an id, ``keep_id``
    is null and its rows are kept. An empty table gives no rows. Other columns are not read.
    """
    base = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).withColumn("norm", normalised(F.col("text")))
    base = base.withColumn("text_sha256", F.sha2("norm", 256))
    base = base.withColumn("fingerprint", fingerprint(F.col("text_sha256"), bits))
    base = base.withColumn("n_chars", F.char_length("text").cast("long")).drop("text")

    digests = staged(base.select("doc_id", "fingerprint", "text_sha256"), "digests")
    suspects = staged(repeated(digests, "fingerprint", digests.count(), bits).select("fingerprint"), "suspects")
    groups = (
        base.join(suspects, "fingerprint")
        .groupBy("fingerprint", "norm")
        .agg(F.min(keep_order(F.col("n_chars"), F.col("doc_id"))).alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("fingerprint", F.sha2("norm", 256).alias("text_sha256"), F.col("best.id").alias("best_id"), "group_size")
    )
    verdict = digests.join(groups, ["fingerprint", "text_sha256"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("best_id"))
    return verdict.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 60) -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one that :func:`copies` keeps.

    Columns are those of ``docs``. Unlike a verdict by id this also drops rows that repeat an id and a
    text; among rows equal in length and id any one stays.
    """
    mark, norm = unused(docs.columns, "fingerprint"), unused(docs.columns, "norm")
    order = keep_order(F.char_length(F.coalesce(F.col(text_col), F.lit(""))), F.col(id_col))
    marked = docs.withColumn(norm, normalised(F.col(text_col)))
    marked = marked.withColumn(mark, fingerprint(F.sha2(norm, 256), bits))
    prints = staged(marked.select(mark), "prints")
    suspects = staged(repeated(prints, mark, prints.count(), bits).select(mark), "suspects")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    several = marked.join(suspects, mark).groupBy(mark, norm).agg(F.min_by(row, order).alias("row"))
    return marked.join(suspects, mark, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(
        several.select("row.*")
    )
