"""Every registered query against its SQL on the smallest tables."""

import sys
import warnings

import pytest
from check_oracles import canonical, connect

import __spark_entry__ as entry
from isochron.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def connection(small_dir):
    return connect(small_dir)


def test_oracles_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, small_dir, connection, name):
    df = QUERIES[name](spark, small_dir)
    rows = [tuple(r) for r in df.collect()]
    cursor = connection.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(rows, df.columns) == canonical(cursor.fetchall(), names)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"fc_forest", "fc_gbt"}))
def test_query_without_sql_has_rows(spark, small_dir, name):
    rows = QUERIES[name](spark, small_dir).collect()
    assert rows and all(r["forecast_mw"] is not None and abs(r["forecast_mw"]) < 1e6 for r in rows)


def test_queries_stand_without_a_library_of_the_optional_modules(monkeypatch):
    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("isochron.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "ahocorasick", None)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
