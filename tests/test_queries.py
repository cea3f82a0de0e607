"""Every registered query against its SQL counterpart."""

from __future__ import annotations

import re
from pathlib import Path

import duckdb
import pytest

from conftest import TESTDATA
from strataflow.queries import ORACLES, QUERIES

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "date": "DATE",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}

# Number of operators in each section of the blueprint.
SECTIONS = {"a": 17, "b": 14, "c": 15, "d": 17, "e": 7, "f": 11, "g": 8, "h": 5, "i": 2, "j": 24, "k": 2, "m": 8}


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for path in Path(TESTDATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_operator_has_a_query():
    have = {re.match(r"[a-z]\d+", name).group() for name in QUERIES}
    want = {f"{section}{i}" for section, n in SECTIONS.items() for i in range(1, n + 1)} - {"b14"}  # the plan preview reads no rows
    assert want - have == set()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    df = QUERIES[name](spark, TESTDATA)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(row)) for row in df.select(*columns).collect())
    assert rows
    if name not in ORACLES:
        return
    result = database.execute(ORACLES[name])
    names = [column[0] for column in result.description]
    assert sorted(names) == columns
    order = [names.index(column) for column in columns]
    assert rows == sorted(repr(tuple(row[i] for i in order)) for row in result.fetchall())
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    expected = [str(result.description[i][1]).replace(" ", "").upper() for i in order]
    assert [TYPES.get(kinds[c], kinds[c].upper()) for c in columns] == expected
