"""Mixing sources to target weights, by budgets on a tree.

A budget of tokens goes down a tree of domains, languages and sources. A parent deals its budget out to
its children in proportion to their weights; what a child can't supply goes to its siblings, again by
weight, and since no parent takes more than its children can supply, only a shortage of all siblings
reaches the level above. Each leaf then takes its documents in a seeded order, epoch after epoch, until
the budget is used up: whole epochs, and of the last one a prefix.

Everything is DataFrame code. The order within a leaf is by md5, whose leading hexadecimal digits cut a
large leaf into slices that tasks add up by themselves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged
from .common import WORD, unused

SLICE_ROWS = 5_000


@dataclass(frozen=True)
class Mix:
    """``tree`` names the levels from the root, each a column in SQL; ``weights`` has whole numbers of 1 or
    more by level and value, 1 where there is none. ``percent`` is the budget in percent of all tokens."""

    tree: dict[str, str]
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    percent: int = 100
    epochs: int = 2
    seed: int = 1

    def __post_init__(self):
        if any(weight < 1 for level in self.weights.values() for weight in level.values()):
            raise ValueError("weights are 1 or more")


#: By domain, language and source. Documents name no domain, so sources are dealt to two by their md5.
DOCUMENTS = Mix(
    {"domain": "CASE WHEN md5(coalesce(source, '')) < '8' THEN 'a' ELSE 'b' END", "lang": "lang", "source": "source"},
    {"domain": {"a": 3, "b": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}},
)


def _weight(mix: Mix, level: str) -> Column:
    out = F.lit(1).cast("long")
    for value, weight in mix.weights.get(level, {}).items():
        out = F.when(F.col(level) == value, F.lit(weight).cast("long")).otherwise(out)
    return out


def _dealt(nodes: DataFrame, parent: list[str], weight: Column) -> DataFrame:
    """``nodes`` (``cap``, and ``budget`` of the parent) with ``share``: water-filling in whole numbers."""
    whole = Window.partitionBy(*parent)
    ordered = whole.orderBy(F.col("cap") / F.col("w"), *[c for c in nodes.columns if c not in ("cap", "budget")])
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumn("w", weight).withColumns(
        {
            "all_w": F.sum("w").over(whole),
            "w_before": F.coalesce(F.sum("w").over(before), F.lit(0)),
            "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0)),
        }
    )
    # Children by rising supply per weight: one is exhausted if its share of what the earlier ones leave exceeds its supply.
    nodes = nodes.withColumn("out", F.expr("cap * (all_w - w_before) <= w * (budget - cap_before)"))
    nodes = nodes.withColumns(
        {
            "out_cap": F.sum(F.when(F.col("out"), F.col("cap")).otherwise(0)).over(whole),
            "out_w": F.sum(F.when(F.col("out"), F.col("w")).otherwise(0)).over(whole),
        }
    )
    share = F.when(F.col("out"), F.col("cap")).otherwise(F.expr("((budget - out_cap) * w) div greatest(all_w - out_w, 1)"))
    return nodes.withColumn("share", share).drop("w", "all_w", "w_before", "cap_before", "out", "out_cap", "out_w", "budget")


def _same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null; the keys of ``left`` stay."""
    named = right.withColumnsRenamed({key: f"_{key}" for key in keys})
    on = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
    return left.join(named, on, how).drop(*[f"_{key}" for key in keys])


def budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """For each leaf of ``rows`` (the levels, ``n_tokens``): its ``docs``, ``tokens`` and ``budget``."""
    levels = list(mix.tree)
    leaves = rows.groupBy(*levels).agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    leaves = staged(leaves, "leaves")
    caps = leaves.withColumn("cap", F.col("tokens") * mix.epochs)
    total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0L) * {mix.percent} div 100").alias("budget"))
    above = total.withColumn("root", F.lit(0))
    known = ["root"]
    for i, level in enumerate(levels):
        keys = levels[: i + 1]
        nodes = caps.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("root", F.lit(0))
        nodes = _same(nodes, above, known)
        above = _dealt(nodes, known, _weight(mix, level)).drop("cap").withColumnRenamed("share", "budget")
        known = ["root", *keys]
    return _same(leaves, above.drop("root"), levels)


def counted(docs: DataFrame, mix: Mix, id_col: str = "doc_id", text_col: str = "text", mark: str | None = None) -> DataFrame:
    """``doc_id``, the levels of the tree, ``n_tokens``, the words of the text, and ``_name``, the id or else a hash of the text.

    Where ``mark`` names a column of row marks, also ``_row``, the mark.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    levels = [F.expr(column).cast("string").alias(level) for level, column in mix.tree.items()]
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.xxhash64(text).cast("string")))
    marks = [F.col(mark).alias("_row")] if mark else []
    return staged(docs.select(F.col(id_col).alias("doc_id"), *levels, words.alias("n_tokens"), name.alias("_name"), *marks), "counted")


def drawn(
    docs: DataFrame, mix: Mix = DOCUMENTS, id_col: str = "doc_id", text_col: str = "text", mark: str | None = None
) -> DataFrame:
    """One row for each document and epoch in which it is drawn: ``doc_id``, the levels, ``n_tokens, epoch``.

    Tokens are words [^\\x20\\x09-\\x0D]+. A leaf's prefix ends before the first document that goes beyond
    its budget, so what is drawn falls short of it by less than one document. Null levels are leaves like
    others. Texts without words, null ones too, cost nothing; a leaf with none but these gives all of
    them once. Rows that repeat an id take part each, next to each other; rows without an id have places of
    their own, by a hash of the text. An empty table gives no rows. With ``mark``, a column of row marks, ``_row``
    has the mark; it decides last in the order.
    """
    levels = list(mix.tree)
    rows = counted(docs, mix, id_col, text_col, mark)
    marks = ["_row"] if mark else []
    leaves = budgets(rows, mix).withColumns(
        {
            "full": F.expr("CASE WHEN tokens = 0 THEN 1L ELSE budget div tokens END"),
            "rest": F.expr("CASE WHEN tokens = 0 THEN 0L ELSE budget % tokens END"),
            "digits": F.ceil(F.log2(F.greatest(F.col("docs") / SLICE_ROWS, F.lit(1))) / 4).cast("int"),
        }
    )
    leaves = leaves.select(*levels, "full", "rest", "digits")
    placed = _same(rows, leaves, levels).withColumn(
        "place", F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("full").cast("string"), F.col("_name")).cast("binary"))
    )
    placed = placed.withColumn("slice", F.expr("substring(place, 1, digits)"))
    sliced = [*levels, "slice"]
    slices = placed.groupBy(*sliced).agg(F.sum("n_tokens").alias("sum"))
    earlier = Window.partitionBy(*levels).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).drop("sum")
    inner = Window.partitionBy(*sliced).orderBy("place", "n_tokens", *marks).rowsBetween(Window.unboundedPreceding, 0)
    ends = placed.withColumn("end", F.sum("n_tokens").over(inner))
    ends = _same(ends, slices, sliced)
    copies = F.col("full") + F.when((F.col("rest") > 0) & (F.col("before") + F.col("end") <= F.col("rest")), 1).otherwise(0)
    epochs = F.when(copies > 0, F.sequence(F.lit(0), (copies - 1).cast("int")))
    return ends.select("doc_id", *levels, "n_tokens", F.explode(epochs).alias("epoch"), *marks)


def mixed(docs: DataFrame, mix: Mix = DOCUMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents drawn, as often as they are drawn, with the columns of ``docs``.

    Rows are drawn by a mark of their own, so those that repeat an id are drawn each by itself, and rows without
    an id like others.
    """
    mark, epoch = unused(docs.columns, "row"), unused(docs.columns, "epoch")
    marked = staged(docs.withColumn(mark, F.monotonically_increasing_id()), "marked")
    often = drawn(marked, mix, id_col, text_col, mark)
    # What is drawn grows with the corpus: it is never a side to broadcast.
    chosen = staged(often.select(F.col("_row").alias(mark), F.col("epoch").alias(epoch)), "drawn").hint("merge")
    return marked.join(chosen, mark).select(*[F.col(f"`{c}`") for c in docs.columns])
