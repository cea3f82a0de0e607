from __future__ import annotations

from collections import Counter

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from llm.test_llm_operators import brute_copies, brute_groups, library  # noqa: F401
from strataflow.llm import mixing, registry
from strataflow.session import fresh_path, staged


def test_stages_against_brute_force(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        steps.append(staged(stage(spark, steps[-1], TESTDATA), "test"))
    for step in steps[1:-1]:
        assert step.columns == docs.columns
    texts = [{r.doc_id: r.text for r in step.select("doc_id", "text").collect()} for step in steps[:-1]]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TESTDATA}/documents.parquet'")
    verdicts = con.execute(f"SELECT doc_id FROM ({registry.ORACLES['op2_quality_rules']}) WHERE kept").fetchall()
    assert set(texts[1]) == {row[0] for row in verdicts}
    assert set(texts[2]) == {keep for _, keep, *_ in brute_copies(texts[1].items())}
    assert set(texts[3]) == {i for i, (_, root, kept) in brute_groups(texts[2].items(), width=5).items() if kept}
    drawn = sorted(r.doc_id for r in mixing.drawn(steps[3]).collect())
    assert sorted(r.doc_id for r in steps[4].collect()) == drawn
    coded = steps[5].collect()
    assert sorted(r.doc_id for r in coded) == drawn
    assert all(r.ids == library.encode_ordinary(texts[3][r.doc_id]) and r.n_tokens == len(r.ids) for r in coded)


def test_run_gives_the_ids(spark):
    assert corpus_pipeline.ORACLE_SQL is None and public_tokenizers
    df = corpus_pipeline.run(spark, TESTDATA)
    assert df.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and df.count() > 0


def test_run_on_odd_rows_and_on_an_empty_table(spark, odd, empty):
    for docs in (odd, empty):
        folder = fresh_path(spark, "tables")
        docs.write.parquet(f"{folder}/documents.parquet")
        ids = corpus_pipeline.run(spark, folder)
        assert ids.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
        assert {r.doc_id for r in ids.collect()} == ({20} if docs is odd else set())


def test_mixing_gives_every_row_as_often_as_it_is_drawn(spark):
    texts = [(None if i % 3 == 0 else i if i % 3 == 1 else i // 30, f"w{i} " * (1 + i % 7)) for i in range(600)]
    docs = [(i, t.strip(), "en", f"s{k % 2}", "x") for k, (i, t) in enumerate(texts)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, _row string").repartition(7)
    got = corpus_pipeline.mix_sources(spark, docs, TESTDATA)
    assert got.columns == docs.columns
    got, plan = got.collect(), mixing.DOCUMENTS
    leaves = mixing.budgets(mixing.counted(docs, plan), plan).collect()
    spent, often = Counter(), Counter(r.text for r in got)
    for r in got:
        spent[r.source] += len(r.text.split())
    assert all(r.budget - 7 < spent[r.source] <= r.budget for r in leaves)  # short by less than a document
    for source in ("s0", "s1"):  # texts are unique, so these are counts of rows
        counts = {often[r.text] for r in docs.where(f"source = '{source}'").collect()}
        assert max(counts) - min(counts) <= 1
    assert sum(r.doc_id is None for r in got) > 100


def test_near_copies_are_told_by_row(spark, odd):
    base = [f"word{i}" for i in range(60)]
    near, other = " ".join([*base[:-1], "own"]), " ".join(f"other{i}" for i in range(60))
    rows = [(2, " ".join(base)), (5, near), (5, other), (None, other + " end"), (None, "no " + other), (None, "a b c d e"), (None, "A b c d e"), (6, None), (6, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, row string")
    got = corpus_pipeline.near_copies(spark, docs, TESTDATA)
    assert got.columns == docs.columns
    got = Counter((r.doc_id, r.text and r.text.lower()) for r in got.collect())
    assert got == Counter([(2, rows[0][1]), (5, other), (None, "a b c d e"), (6, None), (6, "")])
    left = corpus_pipeline.near_copies(spark, odd, TESTDATA)
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(map(str, [1, 4, 5, 6, 7, 8, 9, 10, 20, None]))


def test_ids_are_decoded_to_the_text(spark, odd, library, monkeypatch):  # noqa: F811
    got = corpus_pipeline.token_ids(spark, odd, TESTDATA).collect()
    assert sorted(r.ids for r in got) == sorted(library.encode_ordinary(r.text or "") for r in odd.collect())
    monkeypatch.setattr(corpus_pipeline.BytePairEncoder, "decode", lambda self, ids: F.lit("the same").cast("binary"))
    with pytest.raises(Exception, match="ids do not decode to the text of document"):
        corpus_pipeline.token_ids(spark, odd, TESTDATA).collect()
