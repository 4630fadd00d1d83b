"""Every registered query against its DuckDB oracle on the smallest tables:
same row count, same column names, same values (order-insensitive)."""

import sys

import pytest

import __spark_entry__ as E
from daypulse.plans.catalog import ORACLE, QUERIES
from scripts.check_oracle import digest
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 24
    assert df.columns == ["hr", "yesterday", "today"]
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


def test_registry_without_the_training_data_subpackage(monkeypatch):
    monkeypatch.setitem(sys.modules, "daypulse.llm.queries", None)
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) == set(ORACLE)


def test_highlight_rows(spark):
    df = QUERIES["search_highlight"](spark, SF_SMALL)
    hits = {r.doc_id: r.hits for r in QUERIES["search_hits"](spark, SF_SMALL).collect()}
    for r in df.collect():
        assert r.marked.count("<em>") == r.hits == hits[r.doc_id]
