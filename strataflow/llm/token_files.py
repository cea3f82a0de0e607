"""Token ids in ORC files, and reading them back.

ORC keeps integers run-length encoded in stripes; each stripe has statistics for its rows and a Bloom
filter on the document id, so a reader of some documents skips stripes, and stripes are read in parallel.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized, normalize

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staged
from .common import running, text_batches, unused

KEPT = 1_000_000  # words a worker remembers before it forgets them all
STRIPE = 64 << 20  # bytes
INDEX_STRIDE = 5_000  # rows between entries of the row index


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class _Words(dict):
    """Ids of words by a tokenizer that treats every stretch between white space by itself.

    A word is parted from the punctuation behind its last letter, as the tokenizer does. Words of plain
    Latin letters go to the merges directly, in lower case; all others pass through the whole tokenizer, and
    so do words that hold a special token, as they stand.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.cores = tokenizer, tokenizer.model, {}
        added = [] if tokenizer.encode_special_tokens else tokenizer.get_added_tokens_decoder().values()
        names = b"|".join(re.escape(token.content.encode("utf-8")) for token in added)
        self.special = re.compile(names or rb"(?!)", re.IGNORECASE).search
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(_byte_letters())})

    def ids(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode("utf-8").split()))

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= KEPT:
            self.clear()
            self.cores.clear()
        core = word.rstrip(b".,;:!?")
        if self.special(word):
            found = array("i", self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids).tobytes()
        elif core and core != word and normalize("NFC", core.decode("utf-8"))[-1].lower().isalpha():
            found = self.core(core) + self.core(word[len(core) :])
        else:
            found = self.core(word)
        self[word] = found
        return found

    def core(self, word: bytes) -> bytes:
        plain = word.lower() if word.isascii() else word
        found = self.cores.get(plain)
        if found is None:
            if plain.isalpha():  # of ASCII letters
                ids = [token.id for token in self.model.tokenize(plain.decode("ascii"))]
            elif (low := self._latin(text := plain.decode("utf-8"))) is not None:
                raw = low.encode("utf-8").decode("latin-1")
                ids = [token.id for token in self.model.tokenize(raw.translate(self.letters))]
            else:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            found = self.cores[plain] = array("i", ids).tobytes()
        return found

    @staticmethod
    def _latin(text: str) -> str | None:
        """``text`` in lower case if it is and stays plain Latin letters."""
        if text.isalpha() and max(text) < "\u0250" and is_normalized("NFC", text):
            low = "".join(map(str.lower, text))
            return low if low.isalpha() else None
        return None


_loaded: dict[tuple[int, bool], _Words] = {}


def _words(file: Broadcast, special_as_text: bool) -> _Words:
    key = hash(file.value), special_as_text
    if key not in _loaded:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(file.value)
        tokenizer.encode_special_tokens = special_as_text
        _loaded[key] = _Words(tokenizer)
    return _loaded[key]


def word_ids(spark: SparkSession, text: Column, path: str, end_id: int, special_as_text: bool = False) -> Column:
    """Ids of a whole text by the tokenizer file at ``path``, and ``end_id``. A null text is empty.

    For tokenizers that drop white space and never join what it parts, so that words [^\\x20\\x09-\\x0D]+
    can be encoded once and remembered. The name of a special token within a text gives that token, as the
    library has it, or its letters with ``special_as_text``. The file is a vocabulary of a few MB and is broadcast.
    """
    text_batches(spark)
    with open(path, encoding="utf-8") as opened:
        file = spark.sparkContext.broadcast(opened.read())
    end = np.array([end_id], dtype="<i4").tobytes()

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _words(file, special_as_text)
        for texts in batches:
            parts = [words.ids(text or "") + end for text in texts.to_pylist()]
            ends = np.cumsum([0] + [len(part) // 4 for part in parts])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))

    return encode(text)


def write_tokens(
    docs: DataFrame, path: str, files: int, ids: Column, id_col: str = "doc_id", text_col: str = "text", stride: int = INDEX_STRIDE
) -> None:
    """Write ``doc_id, tie, ids`` as ORC in ascending order of the id: by range from file to file, sorted within.

    ``ids`` is computed on ordered rows, so that the sampling of ranges doesn't compute it too. Null ids of
    documents come first. Rows that repeat an id, or have none, follow each other by ``tie``, a hash of the text,
    and are cut into ranges by it and by the input partition they come from, so they may fill many files.
    """
    tie, read_by = unused(docs.columns, "tie"), unused(docs.columns, "read_by")
    (
        docs.withColumns({tie: F.xxhash64(F.col(f"`{text_col}`")), read_by: F.spark_partition_id()})
        .repartitionByRange(files, id_col, tie, read_by)
        .sortWithinPartitions(id_col, tie)
        .select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(tie).alias("tie"), ids.alias("ids"))
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(stride))
        .option("orc.stripe.size", str(STRIPE))
        .option("orc.compress", "ZSTD")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """``doc_id, tie, ids`` from the files; ``only`` some documents, for which row indexes and Bloom filters skip rows."""
    rows = spark.read.schema("doc_id long, tie long, ids array<int>").orc(path)
    return rows if only is None else rows.where(F.col("doc_id").isin(only))


def _crc32_of(lists: pa.Array) -> pa.Array:
    flat = lists.flatten().to_numpy().astype("<u4")
    ends = np.append(0, np.cumsum(lists.value_lengths().to_numpy())).tolist()
    return pa.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64())


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """From the files, for each document: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all rows before it in the files; those of one id are in the order of ``tie``, and where
    that is equal so are the texts. An empty table gives no rows.
    """
    crc32 = F.arrow_udf(_crc32_of, "bigint")
    rows = read_tokens(spark, path).select(
        "doc_id", "tie", F.size("ids").cast("long").alias("n_tokens"), crc32("ids").alias("ids_crc32"), F.spark_partition_id().alias("read_by")
    )
    rows = staged(rows, "catalogue")  # so that ranging doesn't read the ids again
    return running(rows, ["doc_id", "tie", "read_by"], {"start": "n_tokens"}).select("doc_id", "start", "n_tokens", "ids_crc32")
