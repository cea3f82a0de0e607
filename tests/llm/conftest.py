from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        # names that the operators use themselves
        StructField("kept", StringType()),
        StructField("fingerprint", StringType()),
        StructField("measures", StringType()),
        StructField("host", StringType()),
    ]
)

LONG = " ".join(f"w{i * i % 977}x" for i in range(60_000)) + " " + "z" * 700_000
BASE = [f"Word{i}" for i in range(90)]


def _near(i: int) -> str:
    """The base text with one word of its own."""
    return " ".join(BASE[: 8 * i] + [f"own{i}"] + BASE[8 * i + 1 :])


TEXTS = [
    (1, "the same\ttext here", "en", "a"),
    (2, "the same text  here", "en", "a"),
    (3, "The same text here", None, "a"),
    (4, None, "en", None),
    (5, "", "de", ""),
    (6, " \n\x0b\x0c\r\t ", "de", "b"),
    (7, "one", "fr", "b"),
    (7, "one", "fr", "b"),
    (None, "the same text here", "en", "a"),
    (None, None, None, None),
    (8, LONG, "en", "c"),
    (9, "one two one two one two one two", "es", "c"),
    (10, "naïve café 漢字 🙂 \x1c\x85\xa0 ##$%&|<>", "es", "c"),
    *[(20 + i, _near(i), "en", "d") for i in range(10)],
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows, columns with clashing names."""
    return spark.createDataFrame([(*row, "x", "y", "z", "h") for row in TEXTS], DOCUMENTS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
