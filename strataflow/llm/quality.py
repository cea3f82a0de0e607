"""Quality rules on documents, and the verdict on their hosts.

Every document is measured and held against rules. The failures of each rule are counted by host, and the
host's rate is shrunk towards the rate of all hosts by a beta prior whose strength is estimated from the
spread of the rates (method of moments), so a host with few documents stays near the rate of all.

The verdict on a host is joined back to its documents in two grades. A host whose shrunk rate under any rule is
surely above a limit is rejected with all it has. A host whose shrunk rate under a rule stands out from the
corpus is strict for that rule: its documents that fail the rule go, while on other hosts the rule alone rejects
nothing. So clean documents of a doubtful host stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import staged
from .common import give_back, text_batches, unused

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

# What a document fails by, in SQL over the measures.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "word_length": "n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words)",
}
BASE = ["few_words", "repeated_words"]  # rules that reject the document itself
STRICT = [rule for rule in RULES if rule not in BASE]  # rules that reject documents of hosts that stand out by them
LIMIT = 0.8  # of a host's failure rate
DEVIATIONS = 2.0  # by which the shrunk rate has to be above the limit
OUTSTANDING = 0.25  # deviations by which it has to be above the rate of the corpus for the host to be strict

_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three that occurs at least twice."""
    n = len(words)
    if n < 4:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(word, len(names)) for word in words), np.int64, n)
    pairs = ids[:-2] * len(names) + ids[1:-1]
    if len(names) >= 1 << 20:  # else the product below fits 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * len(names) + ids[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    found = np.isin(windows, again)
    covered = np.zeros(n, dtype=bool)
    for k in range(3):
        covered[k : n - 2 + k] |= found
    return int(covered.sum())


def measured(text: str | None) -> tuple[int, ...]:
    """The measures of a text; white space is [\\x20\\x09-\\x0D], a null text has no words."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    chars = len(text or "") - (len(raw) - len(raw.translate(None, _SPACES)))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words), len(lines)


@F.arrow_udf(StructType([StructField(name, LongType()) for name in MEASURES]))
def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = [measured(text.as_py()) for text in texts]
        table = np.array(rows, dtype=np.int64).reshape(len(rows), len(MEASURES))
        yield pa.StructArray.from_arrays([pa.array(table[:, k]) for k in range(len(MEASURES))], MEASURES)
    give_back()


measure = measure.asNondeterministic()  # else a filter on it is pushed below and measures again, in a second worker


def fails(rules: list[str]) -> Column:
    return F.expr(" OR ".join(f"({RULES[rule]})" for rule in rules))


def host_verdicts(measures: DataFrame) -> DataFrame:
    """``host, rejected, strict_<rule>`` of hosts that any verdict falls on, from rows of ``host`` and the measures.

    Rows without a host count for none.
    """
    counts = staged(
        measures.where("host IS NOT NULL")
        .groupBy("host")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(fails([r]).cast("long")).alias(f"k_{r}") for r in RULES]),
        "hosts",
    )
    totals = counts.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count(F.lit(1)).alias("hosts"),
        *[F.sum(f"k_{r}").alias(f"k_{r}") for r in RULES],
        *[F.sum(F.col(f"k_{r}").cast("double") * F.col(f"k_{r}") / F.col("n")).alias(f"q_{r}") for r in RULES],
    ).first()
    rejected, strict = F.lit(False), dict.fromkeys(STRICT, F.lit(False))
    for rule in RULES if totals["n"] else ():
        a, strength = prior(totals["n"], totals["nn"], totals["hosts"], totals[f"k_{rule}"], totals[f"q_{rule}"])
        weight = F.col("n") + F.lit(strength)
        rate = (F.col(f"k_{rule}") + F.lit(a)) / weight
        spread = F.sqrt(rate * (1 - rate) / (weight + 1))
        rejected = rejected | (rate - DEVIATIONS * spread > LIMIT)
        if rule in STRICT:
            strict[rule] = rate - OUTSTANDING * spread > F.lit(a / strength)
    flags = {"rejected": rejected, **{f"strict_{rule}": flag for rule, flag in strict.items()}}
    return counts.select("host", *[flag.alias(name) for name, flag in flags.items()]).where(" OR ".join(flags))


def host_failed() -> Column:
    """Whether the verdict on its host rejects a document, from the measures and the verdict (null: none)."""
    failed = [F.col("rejected")] + [F.col(f"strict_{rule}") & fails([rule]) for rule in STRICT]
    return F.coalesce(reduce(Column.__or__, failed), F.lit(False))


def prior(n: int, nn: int, hosts: int, k: int, squares: float) -> tuple[float, float]:
    """``a`` and ``a + b`` of the beta distribution of the hosts' rates, by the spread between hosts.

    ``k`` of ``n`` rows fail; ``nn`` is the sum of n_h² over hosts and ``squares`` that of k_h² / n_h. The
    strength lies between 1 and 10,000 rows, also where all hosts are alike or there is one.
    """
    mean = (k + 0.5) / (n + 1)
    between = squares - k * k / n
    freedom = n - nn / n - (hosts - 1)
    shared = (between / (mean * (1 - mean)) - (hosts - 1)) / freedom if freedom > 0 else 0.0
    strength = min(max(1 / max(shared, 1e-9) - 1, 1.0), 10_000.0)
    return mean * strength, strength


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """For each row: ``doc_id``, the measures, ``base_failed``, ``host_failed``, ``kept``.

    A null text has no words and fails. A null host is no host and is not judged; an empty one is.
    Repeated rows count each. An empty table gives no rows. Other columns are not read.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).cast("string").alias("host"), measure(F.col(text_col)).alias("m")
    )
    rows = staged(rows.select("doc_id", "host", "m.*"), "measures")
    rows = rows.join(host_verdicts(rows), "host", "left").withColumns({"base_failed": fails(BASE), "host_failed": host_failed()})
    kept = ~(F.col("base_failed") | F.col("host_failed"))
    return rows.select("doc_id", *MEASURES, "base_failed", "host_failed", kept.alias("kept"))


def quality_filter(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that :func:`judged` keeps, row by row, with the columns of ``docs``.

    Texts are measured twice, once for the hosts and once for the rows, rather than moved.
    """
    text_batches(docs.sparkSession)
    m, host = unused(docs.columns, "measures"), unused(docs.columns, "host")
    of_hosts = docs.select(F.col(host_col).cast("string").alias("host"), measure(F.col(text_col)).alias("m")).select("host", "m.*")
    verdicts = staged(host_verdicts(of_hosts), "verdicts")
    flags = {name: unused([*docs.columns, m, host], name) for name in verdicts.columns[1:]}
    fine = docs.withColumn(m, measure(F.col(text_col))).where(~F.expr(" OR ".join(f"({_of(RULES[rule], m)})" for rule in BASE)))
    fine = fine.join(verdicts.withColumnsRenamed({"host": host, **flags}), F.col(f"`{host_col}`").cast("string") == F.col(host), "left")
    gone = [F.col(flags["rejected"])] + [F.col(flags[f"strict_{rule}"]) & F.expr(_of(RULES[rule], m)) for rule in STRICT]
    fine = fine.where(~F.coalesce(reduce(Column.__or__, gone), F.lit(False)))
    return fine.select(*[F.col(f"`{c}`") for c in docs.columns])


def _of(rule: str, struct: str) -> str:
    for name in MEASURES:
        rule = rule.replace(name, f"{struct}.{name}")
    return rule
